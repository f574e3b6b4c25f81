"""Lineage over several hops: cycles, hot nodes, chains and starts without edges."""

from collections import deque

import pytest
from pyspark.sql import functions as F

from meterlake.operators import lineage_graph as G
from tests.test_skew import cluster_like, executed  # noqa: F401


def nearest(edges, starts):
    hops = {s: 0 for s in starts}
    queue = deque(starts)
    while queue:
        x = queue.popleft()
        for a, b in edges:
            if a == x and b not in hops:
                hops[b] = hops[x] + 1
                queue.append(b)
    return hops


EDGES = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "e"), ("a", "a"), ("x", "b"), ("e", "d"), ("a", "b"), ("p", "q")]


@pytest.fixture
def edges(spark):
    return spark.createDataFrame(EDGES, "src string, dst string")


@pytest.mark.parametrize("starts", [["a"], ["e"], ["x", "d"], ["nowhere"], []])
def test_walk_is_breadth_first_and_ends_on_cycles(spark, edges, starts):
    s = spark.createDataFrame([(x,) for x in [*starts, *starts, None]], "node string")
    assert {(r.node, r.hops) for r in G.walk(edges, s).collect()} == set(nearest(EDGES, starts).items())
    back = [(b, a) for a, b in EDGES]
    got = G.walk(edges, s, upstream=True).collect()
    assert {(r.node, r.hops) for r in got} == set(nearest(back, starts).items()) and len(got) == len({r.node for r in got})


def test_each_start_by_itself_and_both_directions(spark, edges):
    s = spark.createDataFrame([("a",), ("d",)], "node string")
    got = {(r.start, r.node, r.hops) for r in G.walk(edges, s, by_start=True).collect()}
    assert got == {(x, n, h) for x in "ad" for n, h in nearest(EDGES, [x]).items()}
    both = {(r.start, r.direction, r.node, r.hops) for r in G.related(edges, s, max_hops=1).collect()}
    assert both == {("a", "upstream", "c", 1), ("a", "downstream", "b", 1), ("d", "upstream", "c", 1), ("d", "upstream", "e", 1), ("d", "downstream", "e", 1)}


def test_a_long_chain_is_followed_to_its_end(spark):
    chain = spark.range(40).select(F.col("id").cast("string").alias("src"), (F.col("id") + 1).cast("string").alias("dst"))
    end = G.walk(chain, spark.createDataFrame([("0",)], "node string")).filter("node = '40'").first()
    assert end.hops == 40


def test_jobs_that_read_are_the_jobs_that_write(spark):
    writes = spark.createDataFrame([(1, 10), (2, 20), (None, 30)], "job_id long, table_id long")
    reads = spark.createDataFrame([(10, "JOB", 2), (20, "DASHBOARD", 1), (20, None, 4), (None, "JOB", 1)], "table_id long, consumer_type string, consumer_id long")
    flow = G.data_flow(writes, reads)
    got = {r.node: r.hops for r in G.walk(flow, spark.createDataFrame([("job:1",)], "node string")).collect()}
    assert got == {"job:1": 0, "table:10": 1, "job:2": 2, "table:20": 3, "dashboard:1": 4}
    assert {(r.kind, r.hops): r.nodes for r in G.impact(G.walk(flow, flow.select(F.col("src").alias("node")))).collect()}[("job", 0)] == 2


def test_a_hot_node_is_split(cluster_like, monkeypatch):  # noqa: F811
    """A table that most of the edges leave from: the join of the frontier with the edges is a skew join."""
    spark = cluster_like
    wide = spark.range(0, 40_000, 1, 8).select(F.when(F.col("id") % 20 > 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id"))).alias("src"),
                                               F.concat(F.lit("a rather long consumer name "), F.sha2(F.col("id").cast("string"), 256)).alias("dst"))
    starts = spark.createDataFrame([("hot",)], "node string").union(wide.filter("src <> 'hot'").selectExpr("src"))
    step = starts.join(wide, F.col("node") == F.col("src")).select(F.col("dst").alias("node")).distinct()
    assert "skew=true" in executed(step)
    assert G.walk(wide, starts, max_hops=1).filter("hops = 1").count() == 40_000


def test_many_nodes_are_not_sent_through_the_driver(spark, monkeypatch):
    """Rounds of more than FEW nodes are joined by shuffles, and reach the same."""
    monkeypatch.setattr(G, "FEW", 2)
    joins, real = [], G._met
    monkeypatch.setattr(G, "_met", lambda nodes, n: joins.append((n, real(nodes, n)._jdf.queryExecution().analyzed().toString())) or real(nodes, n))
    edges = spark.createDataFrame([("a", f"b{i}") for i in range(5)] + [(f"b{i}", "c") for i in range(5)], "src string, dst string")
    got = {(r.node, r.hops) for r in G.walk(edges, spark.createDataFrame([("a",)], "node string")).collect()}
    assert got == {("a", 0), ("c", 2)} | {(f"b{i}", 1) for i in range(5)}
    assert [n for n, _ in joins] == [1, 1, 5, 6, 1, 7] and [("strategy=merge" in text) for _, text in joins] == [False, False, True, True, False, True]
    assert "BroadcastHashJoin" not in edges.join(real(edges.select("src").distinct(), 3), "src", "left_anti")._jdf.queryExecution().executedPlan().toString()
