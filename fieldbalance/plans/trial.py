"""Trial-shaped views over the general test tables.

Every view is built from all rows of its table. Suppliers stand for plots (four
to a site), customers and users are spread over the same sites, so sites, plots
and days all grow with the data. The same views in SQL are in ``trial_sql``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbalance.plans.season import SeasonTables
from fieldbalance.schemas import (CANOPY_SHEET, FLAG_SHEET, GROWTH_EVENT, IRRIGATION_DIARY,
                                  LAYER_COLUMNS, PET, RAIN, SOIL_SHEET, validate)
from fieldbalance.session import spread

# Critical dates of the crops and what happened on them.
GROWTH_EVENTS = [
    ("2019-10-22", "Potato planted"),
    ("2019-11-12", "Potato emerged"),
    ("2020-04-29", "Potato final-harvest"),
    ("2020-05-19", "Wheat sown"),
    ("2020-06-03", "Wheat emerged"),
    ("2021-01-21", "Wheat final-harvest"),
    ("2021-03-03", "Broccoli planted"),
    ("2021-06-28", "Broccoli final-harvest"),
    ("2021-09-07", "Onion sown"),
]
# The test tables end in 2001, so the events move back by whole years.
MONTHS_BACK = 264

# First observation day, days between observations and crop of each event type.
CANOPY_OF_EVENT = {
    "view": ("Potato", "1997-11-12", 5),
    "click": ("Wheat", "1998-06-03", 5),
    "purchase": ("Broccoli", "1999-03-03", 3),
    "signup": ("Onion", "1999-09-07", 5),
    "error": ("Potato", "1997-11-12", 5),
}
CROPS = ["Onion", "Onions", "Wheat", "Broccoli", "Potato"]
SENSORS = ["Sunscan", "Greenseeker"]
# Ten layers of uneven thickness; nobody measures between 100 and 110 cm.
UNEVEN_LAYERS = [f"VWC_{top}_{bottom}" for top, bottom in
                 [(0, 10), (10, 25), (25, 40), (40, 60), (60, 90), (90, 100), (110, 130),
                  (130, 150), (150, 180), (180, 200)]]


# Declared, so that opening a table starts no job to look into its files.
TABLES = {
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
              "props string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet"))


def _site(key: str, per_site: int) -> Column:
    return F.concat(F.lit("S"), F.expr(f"{key} div {per_site}").cast("string"))


def _crop(date: str) -> Column:
    """Rotation by half-year: wheat, broccoli, then a year of potato."""
    half = (F.year(date) * 2 + (F.month(date) > 6).cast("int")) % 4
    return F.when(half == 1, "Wheat").when(half == 2, "Broccoli").otherwise("Potato")


def _month_instant(column: str) -> Column:
    """First instant (UTC) of a date's month, the same in every session zone."""
    return F.timestamp_seconds(F.unix_date(F.trunc(F.to_date(column), "month")).cast("long") * 86_400)


def soil_sheet(spark: SparkSession, sf_dir: str, rates: int = 4,
               names: Sequence[str] = LAYER_COLUMNS) -> DataFrame:
    def cell(k: int) -> Column:
        return F.expr(f"""
            CASE WHEN (l_orderkey + {k}) % 97 = 0 THEN 'n/a'
                 WHEN (l_partkey + {k}) % 53 = 0 THEN NULL
                 ELSE concat(8 + (cast(l_quantity AS long) * {k + 3} + l_partkey) % 30, '.5') END""")

    rows = table(spark, sf_dir, "lineitem").select(
        _site("l_suppkey", 4).alias("site_id"), _crop("l_shipdate").alias("crop"),
        _month_instant("l_shipdate").alias("date"),
        F.col("l_suppkey").cast("string").alias("plot"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(2).alias("irrigation"),
        ((F.col("l_linenumber") - 1) % rates + 1).cast("int").alias("n_rate"),
        *[cell(k).alias(name) for k, name in enumerate(names)])
    return validate(rows, SOIL_SHEET) if list(names) == LAYER_COLUMNS else rows


def flag_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(
        _site("o_custkey", 60).alias("site_id"),
        _month_instant("o_orderdate").alias("date"),
        F.expr("o_custkey div 15").cast("string").alias("plot"),
        *[F.expr(f"CASE WHEN o_orderstatus = 'P' AND o_orderkey % 8 = {k} THEN 1 END").alias(name)
          for k, name in enumerate(LAYER_COLUMNS)],
        F.col("o_orderpriority").alias("comments"))
    return validate(rows, FLAG_SHEET)


def _site_days(spark: SparkSession, sf_dir: str):
    return table(spark, sf_dir, "lineitem").groupBy(
        _site("l_suppkey", 4).alias("site_id"), F.to_date("l_shipdate").alias("date"))


def pet(spark: SparkSession, sf_dir: str) -> DataFrame:
    tenths = F.expr("sum(cast(round(l_tax * 100) as long)) * 10 div count(*)")
    rows = _site_days(spark, sf_dir).agg((tenths / F.lit(10.0)).alias("pet"))
    return validate(rows, PET)


def rain(spark: SparkSession, sf_dir: str) -> DataFrame:
    wet = F.greatest(F.max("l_quantity") - 40, F.lit(0.0)) * 2
    return validate(_site_days(spark, sf_dir).agg(wet.alias("rain")), RAIN)


def gauge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second rain record with many days missing."""
    rows = (table(spark, sf_dir, "orders")
            .groupBy(_site("o_custkey", 60).alias("site_id"),
                     F.to_date("o_orderdate").alias("date"))
            .agg(F.count("*").cast("double").alias("rain")))
    return validate(rows, RAIN)


def three_level_diary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A diary of a trial with a third irrigation level."""
    rows = table(spark, sf_dir, "orders").groupBy(
        _site("o_custkey", 60).alias("site_id"), F.to_date("o_orderdate").alias("date"))
    return rows.agg(*[F.when(F.count_if(hit) > 0, F.count_if(hit) * 5.0).alias(f"irrigation_{k}")
                      for k, s in enumerate("FOP", start=1)
                      for hit in [F.col("o_orderstatus") == s]]).withColumn("crop", _crop("date"))


def irrigation_diary(spark: SparkSession, sf_dir: str) -> DataFrame:
    def water(status: str) -> Column:
        times = F.count_if(F.col("o_orderstatus") == status)
        return F.when(times > 0, times * 5.0)

    rows = (table(spark, sf_dir, "orders")
            .groupBy(_site("o_custkey", 60).alias("site_id"),
                     F.to_date("o_orderdate").alias("date"))
            .agg(water("F").alias("irrigation_1"), water("O").alias("irrigation_2"))
            .withColumn("crop", _crop("date")))
    return validate(rows, IRRIGATION_DIARY)


def canopy_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    def by_event(values: dict) -> Column:
        pairs = [F.lit(x) for pair in values.items() for x in pair]
        return F.create_map(*pairs)[F.col("event_type")]

    day = F.day("ts")
    start = by_event({e: dt.date.fromisoformat(d) for e, (_, d, _) in CANOPY_OF_EVENT.items()})
    step = by_event({e: s for e, (_, _, s) in CANOPY_OF_EVENT.items()})
    rows = table(spark, sf_dir, "events").select(
        _site("user_id", 6).alias("site_id"),
        by_event({e: c for e, (c, _, _) in CANOPY_OF_EVENT.items()}).alias("crop"),
        F.when(F.col("event_type") == "error", "Sunscan").otherwise("Greenseeker").alias("sensor"),
        F.date_add(start, day * step).alias("date"),
        F.when(F.col("event_id") % 50 != 0, F.col("event_id") % 2 + 1).cast("int")
        .alias("irrigation"),
        F.expr("event_id div 2 % 4 + 1").cast("int").alias("nitrogen"),
        (F.least("value", F.lit(100.0)) / 199 + day / F.lit(61.0)).alias("ndvi"))
    return validate(rows, CANOPY_SHEET)


def scanned_canopy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canopy rows of the sensor the trial uses."""
    return canopy_sheet(spark, sf_dir).filter(F.col("sensor") == "Greenseeker")


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (table(spark, sf_dir, "supplier")
            .select(F.expr("s_suppkey div 4").alias("site_no")).distinct()
            .withColumn("site_id", F.concat(F.lit("S"), F.col("site_no").cast("string"))))


def growth_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event list unfolded at every site, shifted by a few days per site."""
    listed = F.inline(F.array(*[
        F.struct(F.lit(dt.date.fromisoformat(d)).alias("on"), F.lit(e).alias("events"))
        for d, e in GROWTH_EVENTS]))
    moved = F.date_add(F.add_months("on", -MONTHS_BACK), (F.col("site_no") % 5).cast("int"))
    rows = (sites(spark, sf_dir).select("site_id", "site_no", listed)
            .select("site_id", moved.alias("date"), "events"))
    return validate(rows, GROWTH_EVENT)


def season_tables(spark: SparkSession, sf_dir: str) -> SeasonTables:
    return SeasonTables(
        soil=soil_sheet(spark, sf_dir), flags=flag_sheet(spark, sf_dir),
        pet=pet(spark, sf_dir), rain=rain(spark, sf_dir),
        diary=irrigation_diary(spark, sf_dir), canopy=scanned_canopy(spark, sf_dir),
        growth_events=growth_events(spark, sf_dir))
