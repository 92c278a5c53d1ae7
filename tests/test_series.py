"""Ordered steps: blocks change nothing, and a plain loop agrees."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fieldbalance.operators import series

START = dt.date(2018, 11, 1)
BLOCKS = [None, "year(date)", "date_trunc('week', date)"]


@pytest.fixture(params=BLOCKS)
def block(spark, request):
    return request.param and F.expr(request.param)



@pytest.fixture(scope="module")
def rows(spark):
    """Three series with gaps; one holds most rows, one has a missing key."""
    rnd = random.Random(5)
    out = []
    for key, days in (("a", 700), ("b", 40), (None, 60), ("empty", 20)):
        out += [(key, START + dt.timedelta(t),
                 None if key == "empty" or rnd.random() < 0.9 else float(rnd.randint(0, 9)))
                for t in range(days)]
    rnd.shuffle(out)
    return spark.createDataFrame(out, "k string, date date, v double").cache()


def by_series(df, *cols):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r.date):
        out.setdefault(r.k, []).append(tuple(r[c] for c in ("date", *cols)))
    return out


def test_locf(rows, block):
    got = by_series(series.locf(rows, ["v"], ["k"], ["date"], block), "v")
    for k, values in by_series(rows, "v").items():
        last, want = None, []
        for d, v in values:
            last = v if v is not None else last
            want.append((d, last))
        assert got[k] == want


def test_lag_diff(rows, block):
    got = by_series(series.locf_lag_diff(rows, "v", ["k"], ["date"], block), "v", "diff")
    assert "empty" not in got
    for k, values in by_series(rows, "v").items():
        last, want = None, []
        for d, v in values:
            now = v if v is not None else last
            if now is not None:
                want.append((d, now, 0.0 if last is None else now - last))
            last = now
        assert got.get(k, []) == want


def test_runs(rows, block):
    got = by_series(series.runs_by_nonnull(rows, "v", ["k"], ["date"], block), "run")
    for k, values in by_series(rows, "v").items():
        n, want = 0, []
        for d, v in values:
            n += v is not None
            want.append((d, n))
        assert got[k] == want


def test_interpolation(rows, block):
    got = by_series(series.interpolate_linear(rows, "v", ["k"], block=block), "v")
    for k, values in by_series(rows, "v").items():
        known = [(d, v) for d, v in values if v is not None]
        for (d, v), (gd, gv) in zip(values, got[k], strict=True):
            assert d == gd
            left = max((p for p in known if p[0] <= d), default=None)
            right = min((p for p in known if p[0] >= d), default=None)
            if left is None or right is None:
                assert gv is None
            elif left[0] == right[0]:
                assert gv == left[1]
            else:
                share = (d - left[0]).days / (right[0] - left[0]).days
                assert gv == pytest.approx(left[1] + (right[1] - left[1]) * share)


def test_columns_and_rows_are_kept(rows, block):
    out = series.locf(rows, ["v"], ["k"], ["date"], block)
    assert out.columns == rows.columns and out.count() == rows.count()


def test_seed_first_row_overwrites_only_the_first(spark):
    df = spark.createDataFrame([("s", dt.date(2020, 1, d), c) for d, c in
                                ((2, None), (1, "Wheat"), (3, "Onion"))],
                               "site_id string, date date, crop string")
    got = series.seed_first_row(df, "crop", "Potato", ["site_id"]).orderBy("date").collect()
    assert [r.crop for r in got] == ["Potato", None, "Onion"]


def test_last_row_flag(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 5)], "g int, x int")
    got = series.last_row_flag(df, ["g"], ["x"]).filter("is_last").orderBy("g").collect()
    assert [(r.g, r.x) for r in got] == [(1, 2), (2, 5)]


def test_calendar_has_every_day(spark):
    df = spark.createDataFrame([("a", dt.date(2020, 2, 27)), ("a", dt.date(2020, 3, 1)),
                                ("b", dt.date(2020, 1, 1))], "site_id string, date date")
    days = series.calendar_days(series.date_range(df, ["site_id"]), ["site_id"])
    assert days.filter("site_id = 'a'").count() == 4 and days.count() == 5
