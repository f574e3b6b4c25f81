"""JN-5 over any number of hops: what a resource depends on, and what depends on it.

The lineage graph has a node per job, table or consumer and an edge ``(src, dst)`` where data flows from
``src`` to ``dst``. ``walk`` expands a frontier breadth first and semi-naively: a round joins only the
nodes reached last with the edges and drops those that were reached before (an anti-join), so an edge
is followed once for each start, cycles end by themselves, and the round a node first turns up in is
its distance. Rounds are written to one folder and read back from it: the plan of a round does not
hold the earlier ones, a lost executor costs no more than the round at hand, and no set of
nodes ever comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.session import fresh_dir, stored


def node(kind: str | Column, ident: Column | str) -> Column:
    """``kind:id``, the name of a node (as in REP-6); NULL without an id."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.concat(kind, F.lit(":"), (F.col(ident) if isinstance(ident, str) else ident).cast("string"))


def data_flow(writes: DataFrame, reads: DataFrame, job: str = "job_id", table: str = "table_id",
              type_col: str = "consumer_type", id_col: str = "consumer_id") -> DataFrame:
    """Distinct edges ``(src, dst)``: job -> table it wrote, table -> consumer that read it.

    A consumer of type JOB is the same node as the job of that id, so paths go on through the
    tables that it writes. Rows without a job, table or consumer give no edge.
    """
    wrote = writes.select(node("job", job).alias("src"), node("table", table).alias("dst"))
    read = reads.select(node("table", table).alias("src"), node(F.lower(F.col(type_col)), id_col).alias("dst"))
    return wrote.unionByName(read).filter("src IS NOT NULL AND dst IS NOT NULL").distinct()


def _reversed(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))


#: Nodes up to which a round may be sent to every task; what is sent passes through the driver, and a walk has many rounds.
FEW = 20_000


def _met(nodes: DataFrame, n: int) -> DataFrame:
    """``nodes``, of which there are ``n``, as a side of a join: both sides are shuffled unless these are few. (Left to itself
    the optimiser sends the whole graph in every round as long as its files are small.)"""
    return nodes.hint("broadcast" if n <= FEW else "merge")


def walk(edges: DataFrame, starts: DataFrame, upstream: bool = False, max_hops: int | None = None,
         by_start: bool = False) -> DataFrame:
    """Nodes that the edges ``(src, dst)`` lead to from ``starts (node)``: ``node, hops``, the starts at 0.

    ``hops`` is the least number of edges from any start; with ``by_start`` there is a row ``start, node, hops``
    for each start and node it reaches. ``upstream`` follows the edges backwards. ``max_hops`` stops after so many hops (None: until nothing new is
    reached). Starts that no edge names reach only themselves; NULL starts reach nothing.
    """
    spark = edges.sparkSession
    # written once: every round reads them; distinct, so that a hot node has an edge per neighbour only
    graph = stored((_reversed(edges) if upstream else edges).select("src", "dst").filter("src <> dst").distinct(), "edges")
    start = F.col("node") if by_start else F.lit(None).cast("string")
    frontier = starts.filter("node IS NOT NULL").select("node").distinct().select(start.alias("start"), "node", F.lit(0).cast("bigint").alias("hops"))
    root, schema, hops, total = fresh_dir(spark, "walk"), frontier.schema, 0, 0
    key = ["start", "node"] if by_start else ["node"]
    reached = lambda: spark.read.schema(schema).parquet(f"{root}/round-*")
    while True:
        path = f"{root}/round-{hops:05d}"
        frontier.write.mode("overwrite").parquet(path)
        frontier = spark.read.schema(schema).parquet(path)
        n = frontier.count()
        if not n or hops == max_hops:
            return reached().select(*key, "hops")
        hops, total = hops + 1, total + n
        step = _met(frontier, n).join(graph, F.col("node") == F.col("src")).select("start", F.col("dst").alias("node")).distinct()
        frontier = step.join(_met(reached().select(*key), total), key, "left_anti").select("start", "node", F.lit(hops).cast("bigint").alias("hops"))


def related(edges: DataFrame, starts: DataFrame, max_hops: int | None = None) -> DataFrame:
    """Both directions for each start: ``start, direction (upstream / downstream), node, hops``, the start itself left out.

    A node on a cycle through the start is listed in both directions.
    """
    def way(upstream: bool) -> DataFrame:
        found = walk(edges, starts, upstream, max_hops, by_start=True).filter("hops > 0")
        return found.select("start", F.lit("upstream" if upstream else "downstream").alias("direction"), "node", "hops")

    return way(True).unionByName(way(False))


def impact(downstream: DataFrame) -> DataFrame:
    """Reached nodes by kind and distance: ``kind, hops, nodes`` (the summary of a ``walk``)."""
    return downstream.groupBy(F.split_part("node", F.lit(":"), F.lit(1)).alias("kind"), "hops").agg(F.count(F.lit(1)).alias("nodes"))
