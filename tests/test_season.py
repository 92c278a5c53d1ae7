"""The whole dataflow, and its result when one site holds a third of the rows."""

import pytest
from pyspark.sql import functions as F

from fieldbalance.plans import season, trial
from fieldbalance.plans.season import publish_season
from fieldbalance.sources.versions import read_version
from fieldbalance.session import new_shared_path


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return trial.season_tables(spark, sf_dir)


def test_all_results_have_rows(tables):
    results = season.season(tables)
    assert set(results) >= {"profile", "daily", "balance", "published_1", "published_2"}
    for name, df in results.items():
        assert not df.isEmpty(), name


def test_options(tables):
    plain = season.season(tables)["balance"]
    reset = season.season(tables, reset_to_measured=True)["balance"]
    corrected = season.season(tables, use_corrected_pet=True)["balance"]
    assert "swd" in reset.columns and "swd" not in plain.columns
    assert plain.count() == reset.count() == corrected.count()
    hit = reset.filter("swd is not null and date > '1995-06-01'")
    assert hit.count() > 0
    assert hit.filter(F.abs(F.col("wt") - F.least("swd", F.lit(0.0))) > 1e-9).count() == 0
    total = lambda df: df.agg(F.sum("aet")).collect()[0][0]
    assert total(corrected) < total(plain)


def test_balance_closes(tables):
    """Without reset, yesterday + rain - use - drainage is today."""
    rows = season.season(tables)["balance"]
    from pyspark.sql import Window
    w = Window.partitionBy("site_id", "irrigation", "n_rate").orderBy("date")
    gap = F.lag("wt").over(w) + F.col("precipitation") - F.col("aet") - F.col("drainage")
    off = rows.withColumn("off", F.abs(gap - F.col("wt"))).filter("off > 1e-6")
    assert off.count() == 0


def test_published_season(spark, tables):
    path = new_shared_path(spark, "season")
    publish_season(tables, path)
    for level in (1, 2):
        stored = read_version(spark, path, f"published_{level}")
        fresh = season.season(tables)[f"published_{level}"]
        assert stored.columns == fresh.columns and stored.count() == fresh.count()


def test_hot_site_changes_nothing_for_others(spark, sf_dir, tables):
    """Readings of one site repeated until they are a third of all rows."""
    from dataclasses import replace
    hot = tables.soil.filter("site_id = 'S0'")
    many = tables.soil.unionByName(hot.withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(3))))
                                   .drop("_i"))
    before = season.season(tables)["profile"]
    after = season.season(replace(tables, soil=many))["profile"]
    rounded = lambda df: df.withColumns({c: F.round(c, 6) for c in ("profile_water", "pawc", "swd")})
    # Repeating every reading of a site leaves its means as they were.
    assert rounded(after).exceptAll(rounded(before)).count() == 0
    assert after.count() == before.count()
