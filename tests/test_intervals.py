"""Layers of any thickness, found names, unlisted names, tagged names."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fieldbalance.functions import dates
from fieldbalance.operators import intervals, reshape, soil_sheet, weather
from fieldbalance.plans import catalogue
from fieldbalance.session import new_shared_path
from fieldbalance.sources import tagged

DAY = dt.date(2020, 1, 1)
READING = "site_id string, crop string, date date, irrigation int, n_rate int, variable string, value double"


def readings(spark, *cells):
    return spark.createDataFrame([("S1", "Wheat", day, 1, 2, name, value) for day, name, value in cells], READING)


def test_names():
    assert intervals.layer_intervals(["VWC_20_50", "VWC_0_20", "d 60-65cm"]) == {
        "VWC_20_50": (20, 50), "VWC_0_20": (0, 20), "d 60-65cm": (60, 65)}
    for bad in (["VWC"], ["VWC_20_10"], ["VWC_0_20", "VWC_10_30"]):
        with pytest.raises(ValueError):
            intervals.layer_intervals(bad)


def test_shares_gaps_and_capacity(spark):
    later = dt.date(2020, 2, 1)
    names = ["VWC_0_20", "VWC_20_50", "VWC_60_70"]
    rows = readings(spark, (DAY, "VWC_0_20", 10.0), (DAY, "VWC_0_20", 20.0), (DAY, "VWC_20_50", 30.0),
                    (DAY, "VWC_60_70", 40.0), (later, "VWC_0_20", 5.0), (later, "VWC_20_50", None))
    layers = intervals.interval_layers(rows, names)
    got = {(r.date, r.profile): r for r in intervals.swd_to_depths(
        layers, {"10 cm": 10, "40 cm": 40, "65 cm": 65}, deepest_cm=70).collect()}
    assert got[DAY, "10 cm"].profile_water == pytest.approx(15.0)
    assert got[DAY, "40 cm"].profile_water == pytest.approx(30 + 60)
    assert got[DAY, "65 cm"].profile_water == pytest.approx(30 + 90 + 20)
    assert [got[DAY, f"{d} cm"].covered_cm for d in (10, 40, 65)] == [10, 40, 55]
    assert got[later, "40 cm"].swd == pytest.approx(10 - 90) and got[later, "65 cm"].covered_cm == 50
    with pytest.raises(Exception, match="layers end at 70 cm"):
        intervals.swd_to_depths(layers, {"1 m": 100}, deepest_cm=70).collect()
    with pytest.raises(Exception, match="unlisted layer"):
        intervals.interval_layers(rows, names[:2]).collect()


def test_depths_may_differ_by_site(spark):
    layers = intervals.interval_layers(readings(spark, (DAY, "VWC_0_20", 10.0), (DAY, "VWC_20_50", 30.0)),
                                       ["VWC_0_20", "VWC_20_50"])
    depths = spark.createDataFrame([("S1", "rooted", 35), ("S2", "rooted", 50)],
                                   "site_id string, profile string, depth_cm int")
    assert [r.profile_water for r in intervals.water_to_depths(layers, depths).collect()] == [pytest.approx(20 + 45)]
    assert intervals.water_to_depths(layers.limit(0), depths).count() == 0


def test_equal_layers_agree_with_the_sheet(spark, sf_dir):
    sheet = catalogue._soil(spark, sf_dir)
    wide = soil_sheet.multi_depth_from_means(soil_sheet.sheet_means(sheet))
    long = intervals.swd_to_depths(
        intervals.interval_layers(catalogue._long(spark, sf_dir), catalogue.LAYER_COLUMNS),
        {"20 cm": 20, "40 cm": 40, "60 cm": 60})
    keys = ["site_id", "crop", "date", "irrigation", "n_rate", "profile"]
    both = wide.join(long.select(*keys, F.col("swd").alias("other")), keys, "full")
    assert both.filter("swd IS NULL OR other IS NULL OR abs(swd - other) > 1e-9").count() == 0


def test_more_layers_than_eight_and_thirty(spark):
    names = [f"VWC_{10 * k}_{10 * k + 10}" for k in range(40)]
    row = ("S1", "Wheat", DAY, "p", 1, 1, *[str(k) for k in range(40)])
    soil = spark.createDataFrame([row], "site_id string, crop string, date date, plot string, irrigation int, "
                                 "n_rate int, " + ", ".join(f"{n} string" for n in names))
    flag = ("S1", DAY, "p", *[1 if k in (3, 35) else None for k in range(40)])
    flags = spark.createDataFrame([flag], "site_id string, date date, plot string, "
                                  + ", ".join(f"{n} int" for n in names))
    means = soil_sheet.sheet_means(soil, flags, names)
    assert sorted(r.layer for r in soil_sheet.layers_from_means(means).collect()) == [
        k + 1 for k in range(40) if k not in (3, 35)]
    with pytest.raises(ValueError, match="a profile of 41 layers"):
        soil_sheet.swd_from_means(means, 41)


def test_no_rate_or_level_is_lost(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "c", 3.0), (2, None, 4.0)], "k int, n string, v double")
    assert reshape.found_names(df, "n") == ["a", "b", "c"]
    wide = reshape.cast_wide(df, ["k"], "n", reshape.found_names(df, "n"), {"v": "v_"})
    assert sorted(map(tuple, wide.collect())) == [(1, 1.0, 2.0, None), (2, None, None, 3.0)]
    with pytest.raises(Exception, match="not among the columns: c"):
        reshape.cast_wide(df, ["k"], "n", ["a", "b"], {"v": "v_"}, others="raise").collect()
    with pytest.raises(ValueError, match="more than 2"):
        reshape.found_names(df, "n", most=2)
    diary = spark.createDataFrame([("S1",)], "site_id string").selectExpr(
        "site_id", "1 AS irrigation_10", "1 AS irrigation_2", "1 AS irrigation_x")
    assert weather.diary_levels(diary) == ["irrigation_2", "irrigation_10"]


def test_tags_with_underscores(spark):
    path = new_shared_path(spark, "tagged-test")
    rows = spark.createDataFrame([("far_away_1", "Wheat", 1.0), ("S2", "Wheat", 2.0)], "site string, crop string, v double")
    (rows.selectExpr("concat_ws('_', site, crop, 'Sunscan') AS file", "v")
     .write.partitionBy("file").parquet(path))
    got = tagged.read_tagged(spark, path, spark.createDataFrame([], "v double").schema, ["Wheat"], ["Sunscan"],
                             one_folder_each=True)
    assert sorted(map(tuple, got.collect())) == [("S2", "Wheat", "Sunscan", 2.0), ("far_away_1", "Wheat", "Sunscan", 1.0)]
    listing = tagged.file_listing(spark, path, ["Wheat", "Onion"], ["Sunscan"], one_folder_each=True)
    grid = tagged.file_grid(spark, rows.selectExpr("site AS site_id"), ["Wheat", "Onion"], ["Sunscan"])
    assert sorted((r.site_id, r.crop) for r in tagged.absent_files(grid, listing).collect()) == [
        ("S2", "Onion"), ("far_away_1", "Onion")]
    covered = {(r.site_id, r.crop): (r.present, r.files) for r in tagged.grid_coverage(grid, listing).collect()}
    assert covered["far_away_1", "Wheat"] == (True, 1) and covered["S2", "Onion"] == (False, 0)
    assert tagged.file_listing(spark, path + "-none", ["Wheat"], ["Sunscan"]).count() == 0


@pytest.mark.parametrize("zone", ["UTC", "Pacific/Auckland", "America/Los_Angeles"])
def test_results_do_not_depend_on_the_session_zone(spark, sf_dir, zone):
    def results():
        return [sorted(map(str, catalogue.QUERIES[name](spark, sf_dir).collect()))
                for name in ("local_date", "swd_profile", "canopy_time_bucket", "drop_flagged")]
    want = results()
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        assert results() == want
        instants = spark.sql("SELECT timestamp_seconds(1704139200) AS date, timestamp_ntz'2024-01-01 20:00:00' AS wall")
        assert dates.with_local_date(instants).collect()[0].date == dt.date(2024, 1, 2)
        assert dates.with_local_date(instants, "wall").collect()[0].wall == dt.date(2024, 1, 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_layers_are_averaged_side_by_side(spark):
    """One row per treatment and day goes into the shuffle, not one per layer."""
    readings = spark.createDataFrame(
        [("S", "Wheat", dt.date(2020, 1, 1), 1, 1, name, value)
         for name, value in (("VWC_0_10", 10.0), ("VWC_0_10", 20.0), ("VWC_10_30", None))],
        "site_id string, crop string, date date, irrigation int, n_rate int, variable string, value double")
    layers = intervals.interval_layers(readings, ["VWC_0_10", "VWC_10_30", "VWC_30_40"])
    assert sorted((r.top, r.bottom, r.sw) for r in layers.collect()) == [(0, 10, 15.0), (10, 30, None)]
    plan = layers._jdf.queryExecution().sparkPlan().toString()
    assert "keys=[" in plan and not any(
        "variable" in line.split("keys=[")[1].split("]")[0] for line in plan.split("\n") if "keys=[" in line)
