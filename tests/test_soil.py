"""Soil readings: small worked tables, and the sheet path against the long path."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fieldbalance.operators import reshape, soil, soil_sheet
from fieldbalance.schemas import LAYER_COLUMNS

D1, D2 = dt.date(2020, 1, 1), dt.date(2020, 2, 1)
SOIL_DDL = ("site_id string, crop string, date date, plot string, irrigation int, n_rate int, "
            + ", ".join(f"{c} string" for c in LAYER_COLUMNS))
FLAG_DDL = ("site_id string, date date, plot string, "
            + ", ".join(f"{c} int" for c in LAYER_COLUMNS) + ", comments string")


def soil_row(date, plot, cells, site="S", crop="Potato", irrigation=1, n_rate=1):
    return (site, crop, date, plot, irrigation, n_rate, *cells, *[None] * (8 - len(cells)))


def flag_row(date, plot, *layers, site="S"):
    return (site, date, plot, *[1 if k in layers else None for k in range(1, 9)], "looks wrong")


@pytest.fixture(scope="module")
def small(spark):
    rows = [soil_row(D1, "p1", ["10", "20", "bad"]), soil_row(D1, "p2", ["30", "20", "5"]),
            soil_row(D2, "p1", ["10", "10", "10"]), soil_row(D1, None, ["50", "1", "1"])]
    flags = [flag_row(D1, "p2", 1), flag_row(D1, "p2", 1), flag_row(D1, None, 1, 2),
             flag_row(D2, "p9", 1)]
    return (spark.createDataFrame(rows, SOIL_DDL), spark.createDataFrame(flags, FLAG_DDL))


def layers_of(tables):
    sheet, flags = tables
    kept = soil.drop_flagged(soil.melt_layers(sheet), soil.flagged_cells(flags))
    return soil.order_layers(soil.layer_mean(kept), LAYER_COLUMNS)


def test_flagged_cells_go_and_a_missing_plot_matches(small):
    got = {(r.date, r.layer): r.sw for r in layers_of(small).collect()}
    assert got[D1, 1] == 20.0            # p1 only: p2 and the plotless row are flagged
    assert got[D1, 2] == 40.0            # p1 and p2
    assert got[D1, 3] == 6.0             # p2 and the plotless row; the text is skipped
    assert got[D1, 4] is None            # layer present, nothing measured
    assert got[D2, 1] == 20.0


def test_join_flags_keeps_every_reading(small):
    sheet, flags = small
    joined = soil.join_flags(soil.melt_layers(sheet), soil.flagged_cells(flags.dropDuplicates()))
    assert joined.count() == 32
    assert joined.filter("flag = 1").count() == 3


def test_profile_capacity_and_deficit(small):
    layers = layers_of(small)
    full = {r.date: r for r in soil.swd_profile(layers, 2).collect()}
    assert full[D1].profile_water == 60.0 and full[D2].profile_water == 40.0
    assert full[D1].pawc == full[D2].pawc == 60.0
    assert full[D1].swd == 0.0 and full[D2].swd == -20.0
    assert full[D1].n_rate == "Nitrogen 1"
    fixed = {r.date: r.swd for r in soil.swd_profile(layers, 2, pawc=100).collect()}
    assert fixed == {D1: -40.0, D2: -60.0}


def test_profile_of_missing_layers_is_zero_not_missing(small):
    got = soil.profile_depth(layers_of(small).filter("layer = 4"), 8).collect()
    assert {r.profile_water for r in got} == {0.0}


def test_balance_inputs(small):
    r = soil.balance_inputs(layers_of(small), top_depth=1).collect()[0]
    assert (r.awhc, r.awhcs) == (66.0, 20.0)
    assert (r.wt0, r.ws0) == (0.0, 0.0)


def test_layer_numbers_follow_depth_not_text_order():
    names = ["VWC_0_20", "VWC_100_120", "VWC_120_140", "VWC_140_160", "VWC_20_40",
             "VWC_40_60", "VWC_60_80", "VWC_80_100"]
    assert [soil.layer_numbers(names)[n] for n in names] == [1, 6, 7, 8, 2, 3, 4, 5]


@pytest.fixture(scope="module")
def large(spark):
    """Random readings; one plot of one site holds a third of them."""
    rnd = random.Random(11)
    rows, flags = [], []
    for i in range(900):
        hot = i % 3 == 0
        site = "hot" if hot else f"s{rnd.randint(0, 3)}"
        plot = "p0" if hot else rnd.choice(["p1", "p2", None])
        cells = [rnd.choice(["n/a", None, f"{rnd.randint(5, 40)}.5"]) for _ in range(8)]
        date = D1 + dt.timedelta(30 * rnd.randint(0, 5))
        rows.append(soil_row(date, plot, cells, site, rnd.choice(["Potato", "Wheat"]),
                             rnd.randint(1, 2), rnd.randint(1, 4)))
        if rnd.random() < 0.2:
            flags.append(flag_row(date, plot, *rnd.sample(range(1, 9), 4), site=site))
    return spark.createDataFrame(rows, SOIL_DDL), spark.createDataFrame(flags, FLAG_DDL)


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    def rows(df):
        doubles = [c for c, t in df.dtypes if t == "double"]
        df = df.withColumns({c: F.round(c, 9) for c in doubles}).select(*sorted(df.columns))
        return sorted(map(str, df.collect()))
    assert rows(a) == rows(b)


def test_sheet_path_equals_long_path(large):
    layers = layers_of(large).cache()
    means = soil_sheet.sheet_means(*large).cache()
    same(soil_sheet.layers_from_means(means), layers)
    same(soil_sheet.swd_from_means(means), soil.swd_profile(layers))
    same(soil_sheet.swd_from_means(means, 3, pawc=300), soil.swd_profile(layers, 3, 300))
    same(soil_sheet.multi_depth_from_means(means), soil.swd_multi_depth(layers))
    same(soil_sheet.inputs_from_means(means), soil.balance_inputs(layers))


def test_multi_depth_equals_one_depth_at_a_time(large):
    layers = layers_of(large).cache()
    many = soil.swd_multi_depth(layers)
    for name, depth in soil.REPORTED_DEPTHS.items():
        same(many.filter(F.col("profile") == name).drop("profile"), soil.swd_profile(layers, depth))


def test_start_and_capacity_equal_the_profile_table(large):
    layers = layers_of(large).cache()
    profile = soil.swd_profile(layers)
    peak = profile.groupBy(*soil.TREATMENT).agg(F.max("pawc").alias("awhc"))
    same(soil.pawc_by_treatment(layers), peak)
    first = profile.groupBy(*soil.TREATMENT).agg(
        F.min("date").alias("date"), F.min_by("swd", F.struct("date", "crop")).alias("swd"))
    same(soil.start_deficit(layers), first)
    assert profile.filter("swd > 0").count() == 0


def test_deeper_profiles_hold_at_least_as_much(large):
    wide = reshape.cast_wide(soil.swd_multi_depth(layers_of(large)),
                             [*soil.PROFILE_KEYS], "profile", ["20 cm", "60 cm"],
                             {"profile_water": ""})
    assert wide.filter(F.col("`60 cm`") < F.col("`20 cm`")).count() == 0


def test_layer_count_check(small):
    r = soil.layer_count_check(layers_of(small), 9).collect()[0]
    assert (r.layers, r.covers_depth) == (8, False)


def test_melt_and_cast_are_inverse(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("b", 2.0, 3.0)], "k string, x double, y double")
    back = reshape.cast_wide(reshape.melt(df, ["k"]), ["k"], "variable", ["x", "y"], {"value": ""})
    same(back, df)


def test_cast_raises_on_two_rows_for_one_cell(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "x", 2.0)], "k string, n string, v double")
    wide = reshape.cast_wide(df, ["k"], "n", ["x", "y"], {"v": ""})
    with pytest.raises(Exception, match="more than one row"):
        wide.collect()
    with pytest.raises(Exception, match="more than one row"):
        wide.select("k").collect()


def test_cast_drops_the_column_of_a_missing_name(spark):
    df = spark.createDataFrame([("a", None, None), ("b", "x", 1.0)], "k string, n string, v double")
    got = reshape.cast_wide(df, ["k"], "n", ["x"], {"v": ""}).orderBy("k").collect()
    assert [tuple(r) for r in got] == [("a", None), ("b", 1.0)]


def test_nested_chunks_come_back_whole(large):
    swd = soil.swd_profile(layers_of(large))
    nested = reshape.nest(swd, soil.TREATMENT, ["date", "crop", "swd"], F.month("date"))
    same(reshape.unnest(nested, soil.TREATMENT), swd.select(*soil.TREATMENT, "date", "crop", "swd"))


def test_only_readings_that_may_be_flagged_are_joined(spark):
    """The others go past the join; missing plots still match missing plots."""
    day = dt.date(2020, 1, 1)
    readings = spark.createDataFrame(
        [("S", day, p, f"VWC_{k}_{k + 20}", float(k)) for p in ("1", "2", None) for k in range(0, 160, 20)],
        "site_id string, date date, plot string, variable string, value double")
    flags = spark.createDataFrame([("S", day, "1", "VWC_0_20", 1), ("S", day, None, "VWC_20_40", 1),
                                   ("S", day, "9", "VWC_0_20", 1), ("S", None, "2", "VWC_0_20", 1)],
                                  "site_id string, date date, plot string, variable string, value int")
    joined = soil.join_flags(readings, flags)
    assert joined.columns == [*readings.columns, "flag"]
    rows = joined.collect()
    assert len(rows) == 24
    hit = [(None, "VWC_20_40"), ("1", "VWC_0_20")]
    assert sorted([(r.plot, r.variable) for r in rows if r.flag == 1], key=str) == sorted(hit, key=str)
    kept = soil.drop_flagged(readings, flags)
    assert sorted(kept.collect(), key=str) == sorted(
        [r for r in readings.collect() if (r.plot, r.variable) not in hit], key=str)
    for df in (joined, kept):
        assert "Union" in df._jdf.queryExecution().executedPlan().toString()
