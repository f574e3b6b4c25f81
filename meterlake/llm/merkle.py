"""Merkle manifest of a dataset: a tree per source, a tree over the sources, a proof per document.

A tree has runs of three: nodes in order, every three consecutive ones (the last run may hold
fewer, even one) become their hash, until one node is left. A node's rank, written in base
three, says where it hangs: the digits are grouped away one after the other, lowest first, and
each grouping nests the structs of its run's children (``nest``). A row so holds a whole block of
3 ** DIGITS leaves and no more; the blocks' own hashes are the leaves of the next tier, as
many tiers as the largest source needs. The way back (``emit``) needs no join: the path above a
block comes in as one more row of the block's group, and transforms over the nested structs, then
an explode, give each leaf its siblings, level by level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.common import written

ARITY, DIGITS = 3, 6
BLOCK = ARITY ** DIGITS
PATH = "array<struct<l:string,r:string>>"


def sha(*texts: Column) -> Column:
    return F.sha2(F.concat(*texts), 256)


def field(c: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(text: Column) -> Column:
    return sha(*[field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")], field(text))


def leaves(docs: DataFrame) -> DataFrame:
    """``doc_id, source, leaf, tampered``: ``tampered`` is the leaf after the tampering that the
    manifest has to notice (line ends deleted where 2 divides the crc32 of the decimal doc_id), null where none was done."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return docs.select("doc_id", "source", leaf_hash(F.col("text")).alias("leaf"),
                       F.when(chosen, leaf_hash(F.replace(F.col("text"), F.lit("\n"), F.lit("")))).alias("tampered"))


def ranked(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``df`` with ``idx``, the rank from 0 in its ``group`` by ``order``, and ``n``, the group's rows.

    Rows are range partitioned and sorted once and written with their place; a partition's share
    of a group then only needs the counts of the partitions before it. Equal rows are dealt over
    partitions by their place in the input, so no value, however frequent, fills one task.
    """
    keys = [group, *[c for c in order if c != group], "_row"]
    rows = df.withColumn("_row", F.monotonically_increasing_id())
    at = written(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_row")
                 .withColumn("_at", F.monotonically_increasing_id()), "ordered")
    at = at.withColumn("_part", F.shiftright("_at", 33))
    shares = at.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_c"), F.min("_at").alias("_first"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.select(F.col(group).alias("_g"), F.col("_part").alias("_p"), "_first",
                           F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_before"),
                           F.sum("_c").over(Window.partitionBy(group)).alias("n"))
    both = at.join(shares, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_part") == F.col("_p")))
    return both.withColumn("idx", F.col("_at") - F.col("_first") + F.col("_before")).drop("_g", "_p", "_part", "_at", "_first", "_before")


def _hashed(level: int) -> Column:
    """Whether several nodes were left below this level of a tree, so that runs are hashed here."""
    return F.col("n") > ARITY ** (level - 1)


def nest(nodes: DataFrame) -> DataFrame:
    """Nodes ``(grp, n, idx, h, load)`` to one row ``(grp, n, block, h, kids)`` per block of their ranks.

    ``kids`` holds the children by digit, each with its hash and its own ``kids``; the lowest
    ones carry ``load``. All groupings run on one exchange by group and block.
    """
    digit = [F.expr(f"cast((idx div {ARITY ** i}) % {ARITY} as int)").alias(f"d{i}") for i in range(DIGITS)]
    rows = nodes.select("grp", "n", F.expr(f"idx div {BLOCK}").alias("block"), *digit, "h", F.col("load").alias("kids")).repartition("grp", "block")
    for level in range(1, DIGITS + 1):
        above = [f"d{i}" for i in range(DIGITS - 1, level - 1, -1)]
        run = F.sort_array(F.collect_list(F.struct(F.col(f"d{level - 1}").alias("d"), "h", "kids")))
        rows = rows.groupBy("grp", "n", "block", *above).agg(run.alias("kids"))
        rows = rows.withColumn("h", F.when(_hashed(level), F.sha2(F.array_join("kids.h", ""), 256)).otherwise(F.col("kids")[0]["h"]))
    return rows.select("grp", "n", "block", "h", "kids")


def emit(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """``(grp, idx, h, load, path, top, root)`` for every node of the blocks.

    ``above``: ``(grp, idx, path, top, root)``, the path of each block's own hash. ``path`` has a
    struct per hashed level: the siblings' hashes to the left and to the right of the node's ancestor.
    """
    def step(level: int, run: Column, i: Column) -> Column:
        h = run["h"]
        return F.when(_hashed(level), F.struct(F.array_join(F.slice(h, F.lit(1), i), "").alias("l"),
                                               F.array_join(F.slice(h, i + 2, F.size(h)), "").alias("r")))

    def below(level: int, run: Column, steps: list[Column], idx: Column) -> Column:
        def leaf(x, i):
            path = F.array_compact(F.array(step(1, run, i), *steps))
            return F.struct((idx * ARITY + x["d"]).alias("idx"), x["h"].alias("h"), x["kids"].alias("load"), path.alias("path"))

        def inner(x, i):
            return below(level - 1, x["kids"], [step(level, run, i), *steps], idx * ARITY + x["d"])

        return F.transform(run, leaf) if level == 1 else F.flatten(F.transform(run, inner))

    tree = blocks.select("grp", "block", F.struct("n", "kids").alias("tree"), F.lit(None).cast(f"struct<path:{PATH},top:string,root:string>").alias("up"))
    path = above.select("grp", F.col("idx").alias("block"), F.lit(None).cast(tree.schema["tree"].dataType).alias("tree"), F.struct("path", "top", "root").alias("up"))
    both = tree.unionByName(path).groupBy("grp", "block").agg(F.first("tree", ignorenulls=True).alias("tree"), F.first("up", ignorenulls=True).alias("up"))
    both = both.select("grp", "block", "up", "tree.n", "tree.kids")
    found = both.select("grp", "up", F.explode(below(DIGITS, F.col("kids"), [], F.col("block"))).alias("x"))
    return found.select("grp", "x.idx", "x.h", "x.load", F.concat("x.path", "up.path").alias("path"), "up.top", "up.root")


def _tree(nodes: DataFrame, most: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Blocks of every tier, lowest first, and ``(grp, h)`` of each group's last node."""
    tiers = []
    while True:
        blocks = written(nest(nodes), name)
        tiers.append(blocks)
        most = -(-most // BLOCK)
        if most <= 1:
            return tiers, blocks.select("grp", "h")
        nodes = blocks.select("grp", F.ceil(F.col("n") / BLOCK).alias("n"), F.col("block").alias("idx"), "h", F.lit(None).cast("int").alias("load"))


def _paths(tiers: list[DataFrame], above: DataFrame) -> DataFrame:
    """Nodes of the lowest tier with their paths, down from ``above``, the paths of the groups' last nodes."""
    for blocks in reversed(tiers):
        above = emit(blocks, above.select("grp", "idx", "path", "top", "root"))
    return above


def manifest(docs: DataFrame) -> DataFrame:
    """Query ``op12_merkle``: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` per document.

    Leaves of a source ascend by doc_id (null first; rows of one doc_id by leaf, and rows alike
    in every field have the same leaf, so their order changes no hash). A null source is a source,
    and comes first. The proof of the only leaf of an only source has no siblings: its
    hash is that of an empty text. A null doc_id is not tampered with. No documents give no rows; further columns are not read.
    """
    rows = written(leaves(docs), "leaves")
    nodes = written(ranked(rows, "source", ["doc_id", "leaf"]).select(
        F.col("source").alias("grp"), "n", "idx", F.col("leaf").alias("h"), F.struct("doc_id", "tampered").alias("load")), "nodes")
    tiers, subroots = _tree(nodes, nodes.agg(F.max("n")).first()[0] or 1, "blocks")

    tops = ranked(subroots.select(F.lit(0).alias("all"), F.col("grp").alias("source"), "h"), "all", ["source"])
    tops = written(tops.select(F.lit(0).alias("grp"), "n", "idx", "h", F.struct("source").alias("load")), "subroots")
    top_tiers, roots = _tree(tops, tops.count() or 1, "source-blocks")
    start = roots.select("grp", F.lit(0).cast("long").alias("idx"), F.array().cast(PATH).alias("path"), F.lit(None).cast("string").alias("top"), F.col("h").alias("root"))
    sources = written(_paths(top_tiers, start).select(F.col("load.source").alias("grp"), F.lit(0).cast("long").alias("idx"), "path", F.col("h").alias("top"), "root"), "source-paths")

    found = _paths(tiers, sources)
    proof = F.array_join(F.transform("path", lambda p: F.concat(p["l"], p["r"])), "")
    folded = F.aggregate("path", F.coalesce("load.tampered", "h"), lambda x, p: sha(p["l"], x, p["r"]))
    return found.select("load.doc_id", F.col("h").alias("leaf"), F.col("top").alias("subroot"), "root", F.sha2(proof, 256).alias("proof_sha256"),
                        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
