"""Every registered query against its SQL, and the shape of every plan."""

import pytest

import __spark_entry__ as contract
from fieldbalance.plans import catalogue
from oracle_check import differences, duck

QUERIES = catalogue.QUERIES
ORACLE = contract.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", QUERIES)
def test_equals_sql(spark, sf_dir, con, name):
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLE[name]) == []


def test_every_query_has_sql():
    assert set(QUERIES) <= set(ORACLE)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


PLANNED = [n for n in QUERIES if n not in (
    "scan_typed", "publish_roundtrip", "multi_file_tagged_scan", "climate_text_parse")]


@pytest.mark.parametrize("name", PLANNED)
def test_plan(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "NestedLoop" not in plan
    assert "SinglePartition" not in plan
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_scan_reads_only_needed_columns(spark, sf_dir):
    plan = QUERIES["daily_inputs"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "l_tax" in plan and "l_extendedprice" not in plan
