"""Every query against DuckDB, and the shape of the plans."""

import pytest

import __spark_entry__ as entry
from tests.oracle import connect, difference

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, small, con, name):
    """Equal results, with no Python per row and no products of whole tables in the plan."""
    df = QUERIES[name](spark, small)
    assert difference(df, con, SQL[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0


def test_entry(spark, small):
    assert entry.entry(spark).count() > 0


def test_filters_reach_the_files(spark, small):
    plan = QUERIES["filter_between"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_quantity,30.0)" in plan
    plan = QUERIES["outliers_sequential"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(value," in plan
