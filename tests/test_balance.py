"""The daily balance: worked case, missing values, resets, and an independent loop."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from fieldbalance.operators.balance import STATES, two_store_series, water_balance

DAY = dt.date(2020, 1, 1)
NAN = math.nan


def series(pet, rain, measured=None, wt0=-10.0, ws0=-5.0, awhc=100.0, awhcs=20.0):
    out = two_store_series(np.array(pet, float), np.array(rain, float), wt0, ws0, awhc, awhcs,
                           None if measured is None else np.array(measured, float))
    return {name: out[i] for i, name in enumerate(STATES)}


def test_worked_case():
    got = series([NAN, 4, 5, 6, 8, 2], [NAN, 0, 0, 0, 0, 50])
    assert np.allclose(got["ws"], [-5, -9, -14, -20, -20, 0])
    assert np.allclose(got["es"], [0, 4, 5, 6, 0, 0])
    assert np.allclose(got["wt"], [-10, -14, -19, -25, -31.274838, 0])
    assert np.allclose(got["raw"], [0, 2.628, 3.139, 3.5478, 4.38, 1.003387], atol=1e-6)
    assert np.allclose(got["ex"], [0, 4, 5, 6, 6.274838, 1.388435])
    assert np.allclose(got["aet"], [0, 4, 5, 6, 6.274838, 1.388435])
    assert np.allclose(got["drainage"], [0, 0, 0, 0, 0, 17.336727])


def test_one_day_and_no_day():
    one = series([4], [1])
    assert [one[s][0] for s in STATES] == [-5, 0, -10, 0, 0, 0, 0]
    assert two_store_series(np.array([]), np.array([]), -1, -1, 9, 9).shape == (7, 0)


def test_missing_rain_makes_later_deficits_missing():
    got = series([4, 4, 4, 4], [0, NAN, 0, 0])
    assert got["es"][1] == 4 and got["aet"][1] == 4
    for name in ("ws", "wt", "drainage"):
        assert np.isnan(got[name][1:]).all()
    assert np.isnan(got["es"][2:]).all() and np.isnan(got["aet"][2:]).all()


def test_missing_pet():
    got = series([4, NAN, 4], [0, 0, 0])
    for name in STATES:
        assert np.isnan(got[name][1:]).all()


def test_reset_replaces_the_modelled_deficit():
    got = series([4, 4, 4, 4], [0, 0, 0, 0], measured=[NAN, NAN, -50, 3])
    assert got["wt"][1] == -14 and got["wt"][2] == -50
    assert got["wt"][3] == 0  # a measured surplus counts as no deficit
    free = series([4, 4, 4], [0, 0, 0])
    assert got["drainage"][2] == max(0, -50 + free["wt"][1] + 0 - free["aet"][2])


def test_reset_does_not_restore_the_top_store():
    got = series([4, 4, 4], [0, NAN, 0], measured=[NAN, NAN, -20])
    assert got["wt"][2] == -20 and np.isnan(got["ws"][2]) and np.isnan(got["drainage"][2])


def test_no_capacity_is_missing_not_an_error():
    got = series([4, 4], [0, 0], wt0=0.0, ws0=0.0, awhc=0.0, awhcs=0.0)
    assert np.isnan(got["wt"][1])


def plain_loop(pet, rain, swd, wt0, ws0, awhc, awhcs):
    """The equations as they are written down, a value at a time."""
    rows = [(ws0, 0.0, wt0, 0.0, 0.0, 0.0, 0.0)]
    for t in range(1, len(pet)):
        ws, wt = rows[-1][0], rows[-1][2]
        es = min(pet[t], awhcs + ws)
        raw = 0.0073 * (pet[t] * (awhc + wt))
        ex = max(es, pet[t] * ((awhc + wt) / (awhc - raw)))
        aet = min(pet[t], ex)
        now = min(0.0, wt + rain[t] - aet if swd[t] is None else swd[t])
        rows.append((min(0.0, ws + rain[t] - es), es, now, raw, ex, aet,
                     max(0.0, now + wt + rain[t] - aet)))
    return rows


def make(spark, sites=5, days=120, partitions=4, seed=7):
    """Random sites with two levels and two rates; rows in random order."""
    rnd = random.Random(seed)
    daily, starts, resets, want = [], [], [], {}
    for s in range(sites):
        site = f"site-{s}"
        pet = [rnd.randint(0, 80) / 10 for _ in range(days)]
        rain = {k: [rnd.choice([0, 0, 0, 5, 30]) * 1.0 for _ in range(days)] for k in (1, 2)}
        daily += [(site, DAY + dt.timedelta(t), pet[t], rain[1][t], rain[2][t])
                  for t in range(days)]
        for k in (1, 2):
            for n in ("Nitrogen 1", "Nitrogen 2"):
                p = (-rnd.randint(0, 50) * 1.0, -rnd.randint(0, 20) * 1.0, 150.0 + s, 40.0 + k)
                swd = [float(-rnd.randint(0, 90)) if rnd.random() < 0.05 else None
                       for _ in range(days)]
                starts.append((site, k, n, *p))
                resets += [(site, k, n, DAY + dt.timedelta(t), v)
                           for t, v in enumerate(swd) if v is not None and t > 0]
                want[site, k, n] = (plain_loop(pet, rain[k], [None] * days, *p),
                                    plain_loop(pet, rain[k], [None, *swd[1:]], *p))
    rnd.shuffle(daily)
    frame = lambda rows, ddl: spark.createDataFrame(rows, ddl).repartition(partitions)
    return (frame(daily, "site_id string, date date, pet double, precipitation_1 double, "
                         "precipitation_2 double"),
            frame(starts, "site_id string, irrigation int, n_rate string, wt0 double, "
                          "ws0 double, awhc double, awhcs double"),
            frame(resets, "site_id string, irrigation int, n_rate string, date date, swd double"),
            want)


@pytest.mark.parametrize("partitions", [1, 8])
@pytest.mark.parametrize("reset", [False, True])
def test_equals_independent_loop(spark, partitions, reset):
    daily, starts, resets, want = make(spark, partitions=partitions)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        rows = water_balance(daily, starts, resets if reset else None).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(rows) == 5 * 4 * 120
    for r in rows:
        expected = want[r.site_id, r.irrigation, r.n_rate][reset][(r.date - DAY).days]
        assert [r[s] for s in STATES] == pytest.approx(expected)


@pytest.mark.parametrize("block_states", [1, 700, 10 ** 6])
def test_sites_of_different_lengths_side_by_side(spark, block_states):
    daily, starts, resets, want = make(spark, sites=6, days=60, partitions=2, seed=11)
    # Site k ends k weeks early.
    number = F.substring("site_id", 6, 2).cast("int")
    short = daily.filter(F.col("date") < F.date_add(F.lit(DAY), 60 - 7 * number))
    rows = water_balance(short, starts, resets, block_states=block_states).collect()
    assert len(rows) == 4 * sum(60 - 7 * k for k in range(6))
    for r in rows:
        expected = want[r.site_id, r.irrigation, r.n_rate][True][(r.date - DAY).days]
        assert [r[s] for s in STATES] == pytest.approx(expected)


def test_a_day_is_shuffled_once_and_sites_need_no_group_of_their_own(spark):
    daily, starts, _, _ = make(spark, sites=2)
    plan = water_balance(daily, starts)._jdf.queryExecution().executedPlan().toString()
    assert "CoGroup" not in plan and plan.count("MapInArrow") == 1
    assert plan.count("REPARTITION_BY_COL") == 1


def test_properties(spark):
    daily, starts, _, _ = make(spark, seed=3)
    rows = water_balance(daily, starts)
    assert rows.filter("ws > 0 or wt > 0 or drainage < 0").count() == 0
    moved = rows.filter(F.col("date") > F.lit(DAY))
    assert moved.filter("aet > pet + 1e-9").count() == 0


def test_treatment_or_site_without_partner_gives_no_rows(spark):
    daily, starts, _, _ = make(spark, sites=2)
    only = starts.filter("site_id = 'site-0'")
    assert {r.site_id for r in water_balance(daily, only).select("site_id").distinct().collect()} \
        == {"site-0"}
    assert water_balance(daily.filter("site_id = 'site-1'"), only).count() == 0


def test_two_rows_for_one_day_raise(spark):
    daily, starts, _, _ = make(spark, sites=1)
    with pytest.raises(PythonException, match="two daily rows"):
        water_balance(daily.union(daily.limit(1)), starts).collect()


def test_two_measured_deficits_for_one_day_raise(spark):
    daily, starts, resets, _ = make(spark, sites=1)
    with pytest.raises(PythonException, match="two measured"):
        water_balance(daily, starts, resets.union(resets.limit(1))).collect()


def test_measured_day_without_weather_is_ignored(spark):
    daily, starts, resets, _ = make(spark, sites=1, days=10)
    far = resets.limit(0).union(starts.select(
        "site_id", "irrigation", "n_rate", F.lit(dt.date(1999, 1, 1)), F.lit(-1.0)))
    later = far.withColumn("date", F.lit(dt.date(2030, 1, 1)))
    plain = water_balance(daily, starts).select("irrigation", "n_rate", "date", "wt")
    with_far = water_balance(daily, starts, far.union(later)).select(plain.columns)
    assert plain.exceptAll(with_far).count() == 0


def test_bad_arguments(spark):
    daily, starts, resets, _ = make(spark, sites=1)
    with pytest.raises(ValueError, match="precipitation"):
        water_balance(daily.drop("precipitation_1", "precipitation_2"), starts)
    with pytest.raises(ValueError, match="swd"):
        water_balance(daily, starts, resets.drop("swd"))
    with pytest.raises(PythonException, match="irrigation 2"):
        water_balance(daily.drop("precipitation_2"), starts).collect()


def test_missing_states_come_back_as_null(spark):
    daily, starts, _, _ = make(spark, sites=1, days=5)
    gap = daily.withColumn("precipitation_1", F.when(F.col("date") != DAY + dt.timedelta(2),
                                                     F.col("precipitation_1")))
    rows = water_balance(gap, starts).filter("irrigation = 1")
    assert rows.filter("wt is null").count() == 2 * 3
    assert rows.filter(F.isnan("wt")).count() == 0


def test_executors_need_no_copy_of_the_package(tmp_path):
    """A driver that finds the package elsewhere than its working folder."""
    import os
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys; sys.path.insert(0, {repo!r})
import __spark_entry__ as contract
from fieldbalance.session import local_session
spark = local_session(2, 2)
print("rows", contract.queries()["water_balance"](spark, "/root/testdata/sf0.001").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, text=True,
                          capture_output=True, timeout=300)
    assert "rows" in done.stdout, done.stderr[-2000:]
