"""Sharding by weighted rendezvous hashing.

Every (record key, shard) pair gets a pseudo-random number ``u`` in (0, 1) from a hash, and
the record goes to the shard with the highest ``-weight / ln(u)``. A record's scores for the
old shards do not depend on the shard count, so one more shard takes records only into
itself, about its share of the weight.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import numbered

SEED = 7919


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard (0 .. len(weights) - 1) that ``key`` belongs to; equal scores go to the lower shard.

    A null key is hashed as the word ``null``: all null keys share one shard.
    Weights must be positive.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    key = F.coalesce(key.cast("string"), F.lit("null"))
    scores = []
    for shard, weight in enumerate(weights):
        h = F.xxhash64(F.lit(SEED), F.lit(shard), key)
        u = (F.shiftrightunsigned(h, 11).cast("double") + 0.5) / F.lit(float(2 ** 53))
        scores.append(F.struct((-F.lit(float(weight)) / F.log(u)).alias("score"), F.lit(-shard).alias("shard")))
    best = scores[0] if len(scores) == 1 else F.greatest(*scores)
    return (-best["shard"]).cast("int")


def assign(df: DataFrame, key: str, weights: Sequence[float], slot_order: Sequence[str],
           rows_per_bucket: int = 200_000) -> DataFrame:
    """``df`` with ``shard`` (by ``key``), ``grown_shard`` (with one more shard of the last
    weight) and ``slot``, the record's gapless place in its shard.

    Slots are numbered in hash buckets whose number follows the row count, so neither a
    large shard nor a key that repeats in a third of the rows meets in one task (rows
    spread over buckets by key, ``slot_order`` columns and their place in the input).
    Repeated rows get one slot each; an empty table gives an empty table.
    """
    n = df.count()
    buckets = max(16, -(-n // (rows_per_bucket * len(weights))))
    spread = F.xxhash64(key, *slot_order, F.monotonically_increasing_id())
    out = df.withColumn("shard", rendezvous(F.col(key), weights)) \
        .withColumn("grown_shard", rendezvous(F.col(key), [*weights, weights[-1]])) \
        .withColumn("_bucket", F.pmod(spread, F.lit(buckets)))
    return numbered(out, ["shard"], "_bucket", [key, *slot_order], "slot").drop("_bucket")


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Contract of ``op9_shards``: documents by ``doc_id`` over equal shards.

    ``size`` is the text's UTF-8 bytes plus 1 (null text: 1, checksum of no bytes). Only
    ids, sizes and checksums are shuffled, never the texts.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    return assign(rows, "doc_id", [1.0] * shards, ["size", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
