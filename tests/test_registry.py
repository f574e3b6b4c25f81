"""Registry-driven rules: regionality, MIXED dedup keys, declared keys for the key report."""

import datetime as dt

from meterlake import registry
from meterlake.operators import align, quality


def test_registry_counts():
    regs = [d.regionality for d in registry.TABLES.values()]
    assert len(registry.TABLES) == 35
    assert (regs.count("GLOBAL"), regs.count("MIXED"), regs.count("REGIONAL")) == (3, 2, 30)
    assert registry.get("system.lakeflow.job_task_run_timeline").foreign_keys[2].target_column == "run_id"
    assert registry.rule("access.audit") == ("MIXED", ["event_id"])
    assert registry.rule("sharing.materialization_history") == ("MIXED", None)
    assert registry.rule("billing.usage") == ("GLOBAL", None)
    assert registry.rule("unknown.table") == ("REGIONAL", None)


def test_consolidate_all_with_registry(spark):
    audit = spark.createDataFrame([(1, 10), (2, 10)], "event_id bigint, workspace_id bigint")
    usage = spark.createDataFrame([(1,)], "record_id bigint")
    jobs_a = spark.createDataFrame([(1,)], "job_id bigint")
    jobs_b = spark.createDataFrame([(2,)], "job_id bigint")
    cats = {"A": {"access.audit": audit, "billing.usage": usage, "lakeflow.jobs": jobs_a},
            "B": {"access.audit": audit, "billing.usage": usage, "lakeflow.jobs": jobs_b}}
    views, modes, _ = align.consolidate_all(cats, registry.rule)
    assert {k: v.count() for k, v in views.items()} == {"access.audit": 2, "billing.usage": 1, "lakeflow.jobs": 2}
    assert modes["access.audit"] == "MIXED"


def test_history_tables_check_key_with_version(spark):
    ts = dt.datetime
    clusters = spark.createDataFrame([("c1", ts(2024, 1, 1)), ("c1", ts(2024, 2, 1)), ("c2", ts(2024, 1, 1))],
                                     "cluster_id string, change_time timestamp_ntz")
    timeline = spark.createDataFrame([("c1",), ("c9",), (None,)], "cluster_id string")
    decls = registry.key_decls(["compute.clusters", "compute.node_timeline"])
    assert decls["compute.clusters"].primary_key == ("cluster_id", "change_time")
    rep = quality.key_report({"compute.clusters": clusters, "compute.node_timeline": timeline}, decls)
    got = {(r.table_name, r.kind): (r.rows, r.duplicates, r.nulls, r.orphans) for r in rep.collect()}
    assert got[("compute.clusters", "pk")] == (3, 0, 0, 0)
    assert got[("compute.node_timeline", "fk")] == (3, 0, 1, 1)
