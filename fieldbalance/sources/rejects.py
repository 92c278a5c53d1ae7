"""Readers that keep what they cannot use, with the file and the reason.

Each reads its files once: every line is sorted into accepted or rejected while it
is written to the shared folder, the counts of that write are observed, and a
share of rejected lines above the limit raises before anybody reads the rows.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldbalance.functions.dates import parsed_date
from fieldbalance.functions.nulls import to_number
from fieldbalance.session import new_shared_path
from fieldbalance.sources.climate import DATE_LAYOUT, PET_FIELDS, RAIN_FIELDS
from fieldbalance.sources.sheets import typed_cell


class StationText(NamedTuple):
    pet: DataFrame
    rain: DataFrame
    rejects: DataFrame    # file, line, reason
    counts: dict[str, int]


class Sheet(NamedTuple):
    rows: DataFrame
    rejects: DataFrame    # file, line, reason
    counts: dict[str, int]


def _stored(df: DataFrame, name: str, observed: dict[str, Column],
            max_rejected: float) -> tuple[DataFrame, dict[str, int]]:
    """The rows, written once as they come; raises if too many of them are rejects.

    A folder per kind would have every task sort its rows, with their files' names, in memory.
    """
    spark = df.sparkSession
    counter = Observation()
    path = new_shared_path(spark, name)
    none = F.lit(0).cast("long")
    df.observe(counter, *[F.coalesce(F.count_if(c), none).alias(k) for k, c in observed.items()]) \
        .write.parquet(path)
    counts = dict(counter.get)
    seen = sum(counts.values())
    if counts["rejects"] > max_rejected * seen:
        raise ValueError(f"{counts['rejects']} of {seen} lines cannot be used, "
                         f"more than a share of {max_rejected}")
    return spark.read.schema(df.schema).parquet(path), counts


def read_station_text_checked(spark: SparkSession, path: str,
                              max_rejected: float = 0.01) -> StationText:
    """PET and rain of all station exports below a path, and the lines that give neither.

    A data line has a station number or a date in its place. It is rejected when its
    number of fields is neither section's, or its station, date or amount cannot be
    read; an empty amount or ``-`` is a missing value and no reject. Titles, headers
    and footers are not data lines and are not counted.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"),
        F.split("value", "\t").alias("field"))
    field, width = F.col("field"), F.size("field")
    station, date = F.get(field, F.lit(0)), F.get(field, F.lit(1))
    amount = F.trim(F.coalesce(F.get(field, F.lit(2)), F.lit("")))
    data = lines.filter(station.rlike(r"^\d+$") & (width > 1)
                        | F.coalesce(date.rlike(r"^\s*\d{4},"), F.lit(False)))
    value = to_number(amount)
    reason = (F.when(~width.isin(PET_FIELDS, RAIN_FIELDS), "fields")
              .when(station.try_cast("int").isNull(), "station")
              .when(parsed_date(date, DATE_LAYOUT).isNull(), "date")
              .when(value.isNull() & ~amount.isin("", "-"), "amount"))
    kind = (F.when(reason.isNotNull(), "reject").when(width == PET_FIELDS, "pet").otherwise("rain"))
    sorted_ = data.select(
        station.try_cast("int").alias("station"), parsed_date(date, DATE_LAYOUT).alias("date"),
        value.alias("amount"), "file", F.when(reason.isNotNull(), F.col("line")).alias("line"),
        reason.alias("reason"), kind.alias("kind"))
    is_kind = {k: F.col("kind") == v for k, v in
               (("pet", "pet"), ("rain", "rain"), ("rejects", "reject"))}
    rows, counts = _stored(sorted_, "station-lines", is_kind, max_rejected)

    def section(name: str) -> DataFrame:
        return rows.filter(F.col("kind") == name).select(
            "station", "date", F.col("amount").alias(name))

    return StationText(section("pet"), section("rain"),
                       rows.filter("kind = 'reject'").select("file", "line", "reason"), counts)


def read_sheet_checked(spark: SparkSession, path: str, schema: T.StructType, key: str,
                       sep: str = ",", max_rejected: float = 0.01) -> Sheet:
    """Typed rows of exported sheets, and the data lines whose key or cells cannot be read.

    A line without a readable key is a data line, and so a reject, if another number or
    date of it can be read; preamble and header lines hold none. A row with a readable
    key whose cell cannot be read is kept with that cell missing and is also reported,
    with the column as the reason.
    """
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    cells = [f.name for f in schema.fields]
    raw = (spark.read.schema(as_text).option("sep", sep).option("mode", "PERMISSIVE").csv(path)
           .select(F.col("_metadata.file_path").alias("_file"), *[F.col(f"`{c}`") for c in cells]))
    typed = {f.name: typed_cell(f) for f in schema.fields}
    strict = [f.name for f in schema.fields
              if f.name != key and not isinstance(f.dataType, T.StringType)]
    readable = [typed[c].isNotNull() for c in strict] or [F.lit(False)]
    some = readable[0]
    for c in readable[1:]:
        some = some | c
    has_key = typed[key].isNotNull()
    broken = F.array_compact(F.array(*[
        F.when(F.col(f"`{c}`").isNotNull() & (F.trim(F.col(f"`{c}`")) != "") & typed[c].isNull(),
               F.lit(c)) for c in strict]))
    rows = raw.filter(has_key | some).select(
        F.struct(*[typed[c].alias(c) for c in cells]).alias("row"), F.col("_file").alias("file"),
        F.when(~has_key | (F.size(broken) > 0), F.concat_ws(sep, *[
            F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in cells])).alias("line"),
        F.when(~has_key, F.array(F.lit(key))).otherwise(broken).alias("reasons"),
        F.when(has_key, "row").otherwise("reject").alias("kind"))
    kept, counts = _stored(rows, "sheet-rows", {"rows": F.col("kind") == "row",
                                                "rejects": F.col("kind") == "reject"}, max_rejected)
    return Sheet(kept.filter("kind = 'row'").select("row.*"),
                 kept.filter(F.size("reasons") > 0).select(
                     "file", "line", F.explode("reasons").alias("reason")), counts)
