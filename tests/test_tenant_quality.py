"""Tenant scoping (TEN-*) and key checks (DQ-*), plus plan-shape checks."""

from hypothesis import given, settings, strategies as st

from meterlake.operators import quality, tenant
from meterlake.plans import roles as R
from meterlake.sources.tables import Tables
from tests.conftest import SF_SMALL


def test_dup_dimension_and_null_key(spark):
    dim = spark.createDataFrame([(1, "dev-a"), (1, "dev-a"), (2, "prod")], "workspace_id bigint, workspace_name string")
    fact = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (None, "n")], "workspace_id bigint, v string")
    got = sorted(r.v for r in tenant.tenant_scope(fact, dim, "workspace_id", "workspace_name RLIKE 'dev'").collect())
    assert got == ["x", "y"]


def test_skipped_tables_and_case(spark):
    dim = spark.createDataFrame([(1, "dev")], "workspace_id bigint, workspace_name string")
    facts = {"a": spark.createDataFrame([(1,)], "WORKSPACE_ID bigint"), "b": spark.createDataFrame([(1,)], "x int")}
    views, skipped = tenant.tenant_scope_all(facts, dim, "workspace_id", "true", probe=True)
    assert set(views) == {"a"} and skipped == ["b"]


@settings(max_examples=5, deadline=None)
@given(st.sampled_from(["^(BUILD|MACH).*", "AUTO", "^F", "HOLD$"]))
def test_predicate_and_complement_partition_the_fact(spark, pattern):
    t = Tables(spark, SF_SMALL)
    fact, dim = R.tenant_fact(t), R.workspaces(t)
    yes = tenant.tenant_scope(fact, dim, "workspace_id", f"workspace_name RLIKE '{pattern}'").count()
    no = tenant.tenant_scope(fact, dim, "workspace_id", f"NOT (workspace_name RLIKE '{pattern}')").count()
    assert yes + no == fact.count()


def test_semi_join_plan_and_pruned_scan(spark):
    t = Tables(spark, SF_SMALL)
    df = tenant.tenant_scope(R.tenant_fact(t), R.workspaces(t), "workspace_id", R.WORKSPACE_FILTER).select("o_orderkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
    assert "o_orderpriority" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_key_checks(spark):
    child = spark.createDataFrame([(1, 10), (1, 11), (None, 12), (3, None), (4, 99)], "k bigint, fk bigint")
    parent = spark.createDataFrame([(10,), (11,), (12,), (12,)], "pk bigint")
    assert {tuple(r) for r in quality.pk_duplicates(child, "k").collect()} == {(1, 2)}
    assert tuple(quality.pk_nulls(child, ["k"]).first()) == (5, 1)
    assert {tuple(r) for r in quality.fk_orphans(child, "fk", parent, "pk").collect()} == {(99, 1)}
    rep = quality.key_report({"c": child, "p": parent},
                             {"c": quality.KeyDecl(("k",), (("fk", "p", "pk"),)), "p": quality.KeyDecl(("pk",))})
    got = {(r.table_name, r.kind): (r.rows, r.duplicates, r.nulls, r.orphans) for r in rep.collect()}
    assert got == {("c", "pk"): (5, 1, 1, 0), ("c", "fk"): (5, 0, 1, 1), ("p", "pk"): (4, 1, 0, 0)}


def test_nested_key_path(spark):
    child = spark.sql("SELECT named_struct('job_id', CAST(id AS BIGINT)) AS usage_metadata FROM range(5)")
    parent = spark.range(3).withColumnRenamed("id", "job_id")
    got = {tuple(r) for r in quality.fk_orphans(child, "usage_metadata.job_id", parent, "job_id").collect()}
    assert got == {(3, 1), (4, 1)}
