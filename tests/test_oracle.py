"""Every registered query against its DuckDB twin on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as E  # noqa: E402
from fleetzone.plans import oracle, registry  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"
QUERIES = registry.queries()
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert sorted(QUERIES) == sorted(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], SQL[name], SF)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["VESSEL_ID", "YEAR", "n_trips", "n_sets", "n_trips_in", "n_sets_in",
                          "perc_trips_in", "perc_sets_in"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_nested_loop_or_cartesian(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
