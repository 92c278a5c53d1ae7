"""The declared table schemas are those of the files."""

import pytest

from fieldbalance.plans import trial
from fieldbalance.plans.catalogue import QUERIES


@pytest.mark.parametrize("name", trial.TABLES)
def test_declared_schema(spark, sf_dir, name):
    read = spark.read.parquet(f"{sf_dir}/{name}.parquet").dtypes
    assert trial.table(spark, sf_dir, name).dtypes == read


@pytest.mark.parametrize("name", ["publish_wide", "publish_wide_2", "publish_wide_2_parity", "balance_reset",
                                  "balance_nested_reset", "balance_missing_rain", "panel_balance", "panel_drainage",
                                  "figure_weather", "figure_long_60cm"])
def test_the_soil_sheet_is_averaged_once(spark, sf_dir, name):
    """What is read more than once is stored: no scan of the sheet is left in the plan."""
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "l_linestatus" not in plan
