"""The scan over composed maps against the walk over days."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fieldbalance.operators.balance import nested_resets, water_balance
from fieldbalance.operators.top_store import top_store_scan
from tests.test_balance import make

KEYS = ["site_id", "irrigation", "n_rate", "date"]


def apart(left, right):
    both = left.select(*KEYS, "ws", "es").join(
        right.select(*KEYS, F.col("ws").alias("ws2"), F.col("es").alias("es2")), KEYS, "full")
    off = " OR ".join(f"({c} IS NULL) <> ({c}2 IS NULL) OR abs({c} - {c}2) > 1e-9" for c in ("ws", "es"))
    assert both.count() == left.count() == right.count()
    return both.filter(off).count()


@pytest.mark.parametrize("block", ["month", "week", "year", None])
def test_equals_the_walk(spark, block):
    daily, starts, _, _ = make(spark)
    pieces = F.trunc("date", block) if block else F.lit(0)
    assert apart(top_store_scan(daily, starts, block=pieces), water_balance(daily, starts)) == 0


def test_missing_weather_is_missing_from_then_on(spark):
    daily, starts, _, _ = make(spark, sites=2)
    gap = daily.withColumn("pet", F.when(F.dayofyear("date") != 40, F.col("pet")))
    got, want = top_store_scan(gap, starts), water_balance(gap, starts)
    assert apart(got, want) == 0 and want.filter("ws IS NULL").count() > 0
    no_capacity = starts.withColumn("awhcs", F.lit(None).cast("double"))
    assert apart(top_store_scan(daily, no_capacity), water_balance(daily, no_capacity)) == 0


def test_plan_stays_in_the_jvm(spark):
    daily, starts, _, _ = make(spark)
    plan = top_store_scan(daily, starts)._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in plan and "Python" not in plan and "Pandas" not in plan


def test_errors_and_empty_tables(spark):
    daily, starts, _, _ = make(spark, sites=1)
    with pytest.raises(Exception, match="two daily rows"):
        top_store_scan(daily.union(daily.limit(1)), starts).collect()
    with pytest.raises(Exception, match="no precipitation column for irrigation 9"):
        top_store_scan(daily, starts.withColumn("irrigation", F.lit(9))).collect()
    with pytest.raises(ValueError):
        top_store_scan(daily.select("site_id", "date", "pet"), starts)
    assert top_store_scan(daily.limit(0), starts).count() == 0
    assert top_store_scan(daily, starts.limit(0)).count() == 0


def test_two_measurements_of_one_day(spark):
    days = [("S1", 1, "N", dt.date(2020, 1, d), v) for d, v in ((2, -3.0), (1, -1.0), (2, -9.0), (3, None))]
    reset = spark.createDataFrame(days, "site_id string, irrigation int, n_rate string, date date, swd double")
    assert [len(r.measured) for r in nested_resets(reset).collect()] == [4]  # the walk raises on these
    for rule, value in (("driest", -9.0), ("mean", -6.0)):
        row, = nested_resets(reset, rule).collect()
        assert [(m.date.day, m.swd) for m in row.measured] == [(1, -1.0), (2, value), (3, None)]
    with pytest.raises(ValueError):
        nested_resets(reset, "first")


def test_treatments_that_come_twice(spark):
    daily, starts, _, _ = make(spark, sites=2)
    once = top_store_scan(daily, starts)
    both = top_store_scan(daily, starts.union(starts)).groupBy(*KEYS, "ws", "es").count()
    assert both.where("count <> 2").count() == 0 and both.count() == once.count()


def test_days_travel_once_per_level(spark):
    daily, starts, _, _ = make(spark)
    plan = top_store_scan(daily, starts)._jdf.queryExecution().optimizedPlan().toString()
    # A shuffle that groups or joins by rate would carry the days of every treatment.
    joins = [line for line in plan.splitlines() if " Join " in line or line.startswith("Join")]
    assert joins and not any("n_rate" in line for line in joins)
