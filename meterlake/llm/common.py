"""Helpers shared by the operators: written tables, connected components, column naming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterlake.session import fresh_dir

A_TO_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back.

    Cuts the lineage at a table every executor can read, so a lost executor never
    sends the job further back than here.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lower_ascii(col):
    """``col`` with A-Z lower-cased and every other character as it is.

    ``lower`` agrees with that rule on texts that are all ASCII, and is far faster than
    ``translate``, so only the other texts pay for ``translate``.
    """
    return F.when(F.octet_length(col) == F.char_length(col), F.lower(col)) \
        .otherwise(F.translate(col, A_TO_Z, A_TO_Z.lower()))


def row_key(id_col: str = "doc_id") -> list[Column]:
    """Columns k1, k2: two 64-bit hashes of a row's id and text. Rows alike in both share them."""
    return [F.xxhash64(id_col, "text").alias("k1"), F.xxhash64(F.lit(71), F.col("text"), F.col(id_col)).alias("k2")]


def keyed(docs: DataFrame) -> DataFrame:
    """``row`` (all of the row's columns, whatever their names) and its ``k1, k2``."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *row_key())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``links (a, b)``: one row ``(id, comp)`` per linked id.

    ``comp`` is the smallest id of the component. Alternates the two star operations of
    Kiveris et al. (2014): large-star links each node's larger neighbours to its smallest
    neighbour, small-star links its smaller neighbours (and itself) to the smallest one.
    The edge set never grows beyond its start by more than the node count, every step is a
    group-by and an equi-join, and the number of rounds is logarithmic in practice.
    Raises if ``max_rounds`` do not suffice rather than return a partial answer.
    """
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .filter("u <> v").distinct(), "links")
    for _ in range(max_rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written, so that the join stands alone and a node with very many links can be split
        low = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count_if(F.col("v") < F.col("u")).alias("below"),
                                            F.max(F.col("v") > F.col("u")).alias("above")), "lowest")
        # settled: every node is the lowest of its links, or has one link only, to the lowest
        if not low.filter("below > 1 or (below = 1 and above)").limit(1).count():
            return edges.select(F.col("u").alias("id"), F.col("v").alias("comp")) \
                .union(edges.select(F.col("v").alias("id"), F.col("v").alias("comp"))).distinct()
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        large = written(large, "links")
        low = written(large.groupBy("u").agg(F.min("v").alias("m")), "lowest")
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                              F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        edges = written(small.filter("u <> v").distinct(), "links")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def numbered(df: DataFrame, groups: list[str], bucket: str, order: list[str], out: str) -> DataFrame:
    """Gapless numbers from 0 within ``groups`` without bringing a whole group to one task.

    Rows are numbered inside ``(groups, bucket)``; the bucket totals, one row each, are
    summed up before it and added.
    """
    totals = df.groupBy(*groups, bucket).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*groups, bucket, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*groups, bucket).orderBy(*order)
    return df.withColumn("_row", F.row_number().over(inside)).join(starts, [*groups, bucket]) \
        .withColumn(out, (F.col("_start") + F.col("_row") - 1).cast("long")).drop("_row", "_start")
