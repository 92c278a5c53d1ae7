"""Growth stages and the daily coefficient."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fieldbalance.operators import canopy, weather
from fieldbalance.plans import trial


def day(text):
    return dt.date.fromisoformat(text)


@pytest.fixture(scope="module")
def stages(spark):
    events = spark.createDataFrame([("S", day(d), e) for d, e in trial.GROWTH_EVENTS],
                                   "site_id string, date date, events string")
    cover = spark.createDataFrame(
        [("S", c, day(d), "1", "1", m, 0.1) for c, d, m in (
            ("Potato", "2020-01-05", 0.8), ("Wheat", "2020-10-01", 0.77),
            ("Broccoli", "2021-05-01", 0.9))],
        "site_id string, crop string, date date, irrigation string, nitrogen string, "
        "mean double, sd double")
    return canopy.growth_stage_merge(canopy.growth_event_parse(events), cover)


def test_sown_events_drop_out(stages):
    assert stages.count() == 10
    assert stages.filter("events = 'sown'").count() == 0


def test_stage_ends(stages):
    got = canopy.stage_spans(stages).orderBy("start_date").collect()
    assert [r.end_value for r in got] == [.15, 1, 1, .15, 1, 1, .15, 1, 1, .15]
    assert [r.start_value for r in got] == [.15, .15, 1, .15, .15, 1, .15, .15, 1, .15]
    assert all(a.end_date + dt.timedelta(1) == b.start_date for a, b in zip(got, got[1:]))
    assert got[-1].end_date == got[-1].start_date


def test_coefficient_is_daily_and_bounded(stages):
    rows = canopy.crop_coefficient(stages).orderBy("date").collect()
    assert len(rows) == (day("2021-06-28") - day("2019-10-22")).days + 1
    assert all(0.15 <= r.pet_correction <= 1 for r in rows)
    by = {r.date: r.pet_correction for r in rows}
    assert by[day("2019-11-12")] == 0.15 and by[day("2020-01-05")] == 1
    assert by[day("2020-01-04")] == 1  # the last day before closure
    span = (day("2020-01-04") - day("2019-11-12")).days
    assert by[day("2019-12-01")] == pytest.approx(0.15 + 0.85 * 19 / span)


def test_calendar_and_stages_give_the_same_coefficients(stages, spark):
    from fieldbalance.operators import series
    days = series.calendar_days(series.date_range(stages, ["site_id"]), ["site_id"])
    joined = canopy.calendar_join(days, stages)
    a = canopy.crop_coefficient(joined).exceptAll(canopy.crop_coefficient(stages))
    assert a.count() == 0 and joined.count() == days.count()


def test_index_exactly_at_the_limit_has_no_start(spark):
    rows = spark.createDataFrame(
        [("S", day("2020-01-01"), "Potato", "emerged", 0.1),
         ("S", day("2020-01-05"), "Potato", "canopy-closure", 0.75),
         ("S", day("2020-01-09"), "Potato", "final-harvest", 0.0)],
        "site_id string, date date, crop string, events string, mean double")
    by = {r.date.day: r.pet_correction for r in canopy.crop_coefficient(rows).collect()}
    assert by[4] == 1                                  # still rises to closure
    assert by[5] is None and by[6] is None and by[7] is None
    assert by[8] == 1                                  # the last closed day
    assert by[9] == 0.15


def test_two_stages_on_one_day(spark):
    rows = spark.createDataFrame(
        [("S", day("2020-01-01"), "Potato", "canopy-closure", 0.9),
         ("S", day("2020-01-01"), "Wheat", "emerged", 0.1),
         ("S", day("2020-01-03"), "Wheat", "final-harvest", 0.0)],
        "site_id string, date date, crop string, events string, mean double")
    got = sorted((r.date.day, r.crop, r.pet_correction)
                 for r in canopy.crop_coefficient(rows).collect())
    assert got == [(1, "Potato", 1.0), (1, "Wheat", 0.15), (2, "Wheat", 0.15), (3, "Wheat", 0.15)]


def test_event_on_a_cover_day_takes_the_measured_index(spark):
    events = spark.createDataFrame([("S", day("2020-01-01"), "Potato emerged")],
                                   "site_id string, date date, events string")
    cover = spark.createDataFrame([("S", day("2020-01-01"), "Wheat", 0.8)],
                                  "site_id string, date date, crop string, mean double")
    r = canopy.growth_stage_merge(canopy.growth_event_parse(events), cover).collect()
    assert [(x.crop, x.events, x.mean) for x in r] == [("Potato", "emerged", 0.8)]


def test_first_cover_breaks_ties_by_treatment(spark):
    rows = spark.createDataFrame(
        [("S", "Potato", "g", day("2020-01-02"), i, n, m, 0.0) for i, n, m in
         (("2", "1", 0.9), ("1", "2", 0.8), ("1", "1", 0.7))]
        + [("S", "Potato", "g", day("2020-01-03"), "1", "1", 0.95, 0.0)],
        "site_id string, crop string, sensor string, date date, irrigation string, "
        "nitrogen string, mean double, sd double")
    r = canopy.full_cover_date(rows).collect()
    assert [(x.date, x.irrigation, x.nitrogen, x.mean) for x in r] == [
        (day("2020-01-02"), "1", "2", 0.8)]


def test_summary_spread_of_one_value_is_missing(spark):
    rows = spark.createDataFrame(
        [("S", "Potato", "g", day("2020-01-02"), 1, 1, 0.5), ("S", "Potato", "g",
         day("2020-01-02"), None, 1, 0.9)],
        "site_id string, crop string, sensor string, date date, irrigation int, nitrogen int, "
        "ndvi double")
    r = canopy.canopy_summary(rows).collect()
    assert len(r) == 1 and r[0].mean == 0.5 and r[0].sd is None


def test_pet_correction_defaults_to_bare_soil(spark):
    daily = spark.createDataFrame([("S", day("2020-01-01"), "Potato", 4.0),
                                   ("S", day("2020-01-02"), "Potato", 4.0)],
                                  "site_id string, date date, crop string, pet double")
    coefficient = spark.createDataFrame([("S", day("2020-01-01"), "Potato", 0.5)],
                                        "site_id string, date date, crop string, "
                                        "pet_correction double")
    got = canopy.pet_correction(daily, coefficient).orderBy("date").collect()
    assert [r.pet_correction for r in got] == [2.0, pytest.approx(0.6)]


@pytest.fixture(scope="module")
def weather_tables(spark):
    pet = spark.createDataFrame([("S", day(f"2020-01-0{d}"), float(d)) for d in range(1, 6)],
                                "site_id string, date date, pet double")
    rain = spark.createDataFrame([("S", day(f"2020-01-0{d}"), 1.0) for d in (1, 2, 4, 5)],
                                 "site_id string, date date, rain double")
    diary = spark.createDataFrame(
        [("S", "Wheat", day("2020-01-01"), 5.0, None), ("S", "Onion", day("2020-01-04"), None, 7.0)],
        "site_id string, crop string, date date, irrigation_1 double, irrigation_2 double")
    return weather.weather_join(pet, rain), diary


def test_daily_inputs(weather_tables):
    got = weather.daily_inputs(*weather_tables).orderBy("date").collect()
    assert [r.crop for r in got] == ["Potato"] * 3 + ["Onion"] * 2
    assert [r.precipitation_1 for r in got] == [6.0, 1.0, None, 1.0, 1.0]
    assert [r.precipitation_2 for r in got] == [1.0, 1.0, None, 8.0, 1.0]
    dry = weather.daily_inputs(*weather_tables, missing_rain="zero").orderBy("date").collect()
    assert [r.precipitation_1 for r in dry] == [6.0, 1.0, 0.0, 1.0, 1.0]
    with pytest.raises(ValueError):
        weather.daily_inputs(*weather_tables, missing_rain="guess")


def test_daily_inputs_equal_the_long_way_round(weather_tables):
    joined, diary = weather_tables
    long = weather.weather_irrigation_join(joined, weather.melt_irrigation(diary))
    wide = weather.fill_zero(weather.pivot_irrigation(long))
    short = weather.daily_inputs(joined, diary)
    cols = ["site_id", "date", "pet", "rain", "irrigation_1", "irrigation_2"]
    assert wide.select(cols).exceptAll(short.select(cols)).count() == 0
    assert wide.count() == short.count() == 5
    assert wide.filter(F.col("crop").isNotNull()).count() == 2


def test_pet_correction_keeps_the_days_off_the_driver(spark, stages):
    """Ten stages look small, their days are not: the join may not broadcast them."""
    daily = spark.createDataFrame([("S", day("2020-01-01"), "Potato", 4.0)],
                                  "site_id string, date date, crop string, pet double")
    joined = canopy.pet_correction(daily, canopy.crop_coefficient(stages))
    assert len(joined.collect()) == 1
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
