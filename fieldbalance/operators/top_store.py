"""The top store of the daily balance as a scan over blocks of days.

A day takes the deficit ``w`` of the top store to

    min(0, max(w + P - PET, P - AWHCs)),

a shift by ``P - PET`` that is clamped from below and above. Two such maps in a
row are one map of the same kind:

    shift = s1 + s2,  low = max(l2, l1 + s2),  high = min(h2, max(l2, h1 + s2)).

So a block of days shrinks to three numbers, the blocks of a series combine in
order, and every block is replayed from the deficit it starts with. Days are only
ever gathered by site, level and block, which many tasks share however long a series
is, and all of it stays inside the JVM. The array functions are interpreted, so they
keep to the deficit; what follows from it is compiled.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbalance.functions.nulls import strict_least

_TREATMENT = ["site_id", "irrigation", "n_rate"]
_SERIES = [*_TREATMENT, "ws0", "awhcs"]
_DOUBLE_MAX = 1.7976931348623157e308


def _day_blocks(daily: DataFrame, levels: dict[int, str], pet_col: str, block: Column) -> DataFrame:
    """(site_id, irrigation, block, days): the days of a block in order, with the rain of one level."""
    pet = F.col(pet_col).cast("double")
    rains = F.inline(F.array(*[F.struct(F.lit(k).alias("irrigation"), F.col(c).cast("double").alias("p"))
                               for k, c in levels.items()]))
    rows = daily.select("site_id", block.alias("block"), "date", pet.alias("pet"), rains)
    day = F.struct("date", "pet", "p", (F.col("p") - F.col("pet")).alias("change"))
    blocks = rows.groupBy("site_id", "irrigation", "block").agg(
        F.sort_array(F.collect_list(day)).alias("days"))
    twice = F.size(F.array_distinct(F.transform("days", lambda d: d["date"]))) < F.size("days")
    return blocks.filter(F.assert_true(~twice, F.concat(
        F.lit("two daily rows for one date at site "), "site_id")).isNull())


def _walked(first_date: Column) -> Column:
    """The days of a block that change the deficit: the first day of a site holds the start."""
    days = F.col("days")
    return F.when(days[0]["date"] == first_date, F.slice(days, 2, F.size(days))).otherwise(days)


def _block_map(days: Column, awhcs: Column) -> Column:
    """What the days of a block do together; its shift is missing if a day is not known."""
    def then(done: Column, day: Column) -> Column:
        low = day["p"] - awhcs
        return F.struct((done["shift"] + day["change"]).alias("shift"),
                        F.greatest(low, done["low"] + day["change"]).alias("low"),
                        F.least(F.lit(0.0), F.greatest(low, done["high"] + day["change"])).alias("high"))

    nothing = F.struct(F.when(awhcs.isNotNull(), 0.0).alias("shift"), F.lit(-_DOUBLE_MAX).alias("low"),
                       F.lit(_DOUBLE_MAX).alias("high"))
    # The result has the type of its start, whose numbers may then be missing.
    return F.aggregate(days, nothing.cast("struct<shift:double,low:double,high:double>"), then)


def _applied(change: Column, w: Column) -> Column:
    moved = w + change["shift"]
    return F.when(moved.isNotNull(), F.least(change["high"], F.greatest(change["low"], moved)))


def _deficits(days: Column, start: Column, awhcs: Column) -> Column:
    """The deficit before the days, then after each of them. A missing one stays missing."""
    def step(done: Column, day: Column) -> Column:
        w = F.element_at(done, -1)
        after = F.least(F.lit(0.0), w + day["p"] - F.least(day["pet"], awhcs + w))
        return F.concat(done, F.array(F.when((w + day["change"] + awhcs).isNotNull(), after)))

    return F.aggregate(days, F.array(start).cast("array<double>"), step)


def top_store_scan(daily: DataFrame, treatments: DataFrame, pet_col: str = "pet",
                   block: Column | None = None) -> DataFrame:
    """``ws`` and ``es`` of every day of every treatment, as ``water_balance`` gives them.

    ``block`` cuts the days of a site, in date order, into pieces of bounded size
    (default: the month). A missing evaporation or rain makes the deficit missing from
    that day on; two rows of a site for one date raise. A site without days has no
    rows, and neither has one without treatments.
    """
    levels = {int(m.group(1)): c for c in daily.columns
              if (m := re.fullmatch(r"precipitation_(\d+)", c))}
    if not levels:
        raise ValueError("daily rows need a precipitation_<level> column")
    block = F.trunc("date", "month") if block is None else block
    starts = treatments.select(
        "site_id", F.col("irrigation").cast("int").alias("irrigation"), "n_rate",
        F.col("ws0").cast("double").alias("ws0"), F.col("awhcs").cast("double").alias("awhcs"))
    unknown = ~F.col("irrigation").isin(*levels)
    starts = starts.filter(F.assert_true(~F.coalesce(unknown, F.lit(True)), F.concat(
        F.lit("no precipitation column for irrigation "),
        F.coalesce(F.col("irrigation").cast("string"), F.lit("null")))).isNull())
    # Treatments that come twice are series of their own.
    starts = (starts.filter("n_rate IS NOT NULL").groupBy(*_SERIES)
              .agg(F.count("*").cast("int").alias("times")))
    blocks = _day_blocks(daily, levels, pet_col, block)
    firsts = blocks.groupBy("site_id").agg(F.min(F.col("days")[0]["date"]).alias("first_date"))
    of_site = starts.join(firsts, "site_id")
    first_date, awhcs = F.col("first_date"), F.col("awhcs")
    # Only numbers of treatments are copied in a shuffle; days travel once per level.
    maps = blocks.join(of_site, ["site_id", "irrigation"]).select(
        *_SERIES, "first_date", "times", "block", _block_map(_walked(first_date), awhcs).alias("change"))

    def before(done: Column, piece: Column) -> Column:
        kept = F.struct(piece["block"].alias("block"), done["w"].alias("start"))
        return F.struct(_applied(piece["change"], done["w"]).alias("w"),
                        F.concat(done["starts"], F.array(kept)).alias("starts"))

    kind = maps.schema["block"].dataType.simpleString()
    none = F.struct(F.col("ws0").alias("w"), F.array().alias("starts")).cast(
        f"struct<w:double,starts:array<struct<block:{kind},start:double>>>")
    began = (maps.groupBy(*_SERIES, "first_date", "times")
             .agg(F.sort_array(F.collect_list(F.struct("block", "change"))).alias("pieces"))
             .select("site_id", "irrigation", "n_rate", "awhcs", "first_date", "times", F.inline(F.aggregate(
                 "pieces", none, before, lambda done: done["starts"])))
             .withColumn("again", F.explode(F.sequence(F.lit(1), "times"))).drop("again", "times"))
    # A first day changes nothing: its deficit is the start, before and after.
    days, start = F.col("days"), F.col("start")
    held = _deficits(_walked(first_date), start, awhcs)
    held = F.when(days[0]["date"] == first_date, F.concat(F.array(start), held)).otherwise(held)
    walked = blocks.join(began, ["site_id", "irrigation", "block"]).select(
        *_TREATMENT, "awhcs", "first_date", "days", held.alias("held"))
    rows = (walked.select(*_TREATMENT, "awhcs", "first_date", "days",
                          F.slice("held", 1, F.size("days")).alias("before"),
                          F.slice("held", 2, F.size("days")).alias("ws"))
            .select(*_TREATMENT, "awhcs", "first_date", F.inline(F.arrays_zip("days", "before", "ws"))))
    es = strict_least(F.col("days.pet"), awhcs + F.col("before"))
    return rows.select(*_TREATMENT, F.col("days.date").alias("date"), "ws",
                       F.when(F.col("days.date") == first_date, 0.0).otherwise(es).alias("es"))
