"""Plan-shape checks over every registered query: built-in expressions only, no cross products,
filters and column pruning reach the scan."""

import pytest

import __spark_entry__ as E
from meterlake.plans.catalog import QUERIES
from tests.conftest import SF_SMALL

FORBIDDEN = ["BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas",
             "CartesianProduct", "BroadcastNestedLoopJoin"]


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_python_udf_and_no_cross_product(spark, key):
    df = E.queries()[key](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in FORBIDDEN:
        assert node not in plan, f"{key}: {node}"


def test_window_filter_is_pushed_and_columns_pruned(spark, capsys):
    df = E.queries()["job_cost_per_consumer"](spark, SF_SMALL)
    capsys.readouterr()
    df.explain("formatted")
    plan = capsys.readouterr().out
    scans = [blk for blk in plan.split("\n\n") if "lineitem.parquet" in blk]
    assert len(scans) >= 3, plan
    for s in scans:
        assert "GreaterThanOrEqual(l_shipdate,2001-10-05T00:00)" in s
        assert "LessThan(l_shipdate,2001-11-05T00:00)" in s
        assert "l_extendedprice" not in s and "l_comment" not in s


def test_price_join_is_equi_on_sku_with_residual(spark):
    df = E.queries()["price_asof_join"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan or "SortMergeJoin" in plan) and "NestedLoop" not in plan
