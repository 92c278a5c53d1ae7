"""Text exports of climate stations, and the period of a station that is wanted.

One file holds free text, a potential-evapotranspiration (PET) section, a daily
rain section and a footer. A data line is a run of tab-separated fields that
starts with the station number; its field count tells the section.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbalance.functions.dates import parsed_date
from fieldbalance.functions.nulls import to_number

# Fixed values of the export layout.
PET_FIELDS = 5
RAIN_FIELDS = 8
DATE_LAYOUT = "yyyy,MM,dd,HH"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.text(path)
            .filter(F.col("value").rlike(r"^\d+\t"))
            .select(F.split("value", "\t").alias("field")))


def _section(lines: DataFrame, width: int, amount: str) -> DataFrame:
    field = F.col("field")
    return lines.filter(F.size(field) == width).select(
        field[0].cast("int").alias("station"),
        parsed_date(field[1], DATE_LAYOUT).alias("date"),
        to_number(field[2]).alias(amount),
    )


def read_station_text(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """PET and rain tables of all station exports below a path."""
    lines = _lines(spark, path)
    return _section(lines, PET_FIELDS, "pet"), _section(lines, RAIN_FIELDS, "rain")


def station_period(weather: DataFrame, start: DataFrame | str,
                   station: Column | None = None, until: Column | None = None) -> DataFrame:
    """Rows of the wanted stations from their start date up to today.

    ``start`` is one date for all, or a table (site_id, start_date).
    """
    until = F.current_date() if until is None else until
    if station is not None:
        weather = weather.filter(station)
    weather = weather.filter(F.col("date") <= until)
    if isinstance(start, str):
        return weather.filter(F.col("date") >= F.lit(start).cast("date"))
    return (weather.join(start, "site_id")
            .filter(F.col("date") >= F.col("start_date")).drop("start_date"))


def store_by_station(weather: DataFrame, path: str) -> None:
    """Keep weather in one folder per site, so that a reader opens only the sites it needs."""
    weather.hint("rebalance", "site_id").write.partitionBy("site_id").mode("overwrite").parquet(path)


def stored_period(spark: SparkSession, path: str, schema: str, start: DataFrame,
                  until: Column | None = None) -> DataFrame:
    """The wanted period of stored weather; only the folders of the sites in ``start`` are read.

    Which sites those are is known when the query runs: the folders are pruned by the
    start table itself.
    """
    return station_period(spark.read.schema(schema).parquet(path), start, until=until)


def first_dates(df: DataFrame) -> DataFrame:
    """First date of every site, the start of its weather period."""
    return df.groupBy("site_id").agg(F.min("date").alias("start_date"))
