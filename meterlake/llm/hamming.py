"""Exact top-k search over binary codes by incremental multi-index hashing.

A code of b bits is cut into m segments, each with its own index. Two codes at distance d
agree within ``floor(d / m)`` bits in some segment, so after all segments have been probed up
to radius s, every code at distance ``m * (s + 1) - 1`` or less has been seen. The radius
grows until the kth verified distance lies inside that bound for each query. A query whose
kth distance so far is ``m * s + i`` probes its first i + 1 segments only at radius s: a code that
is nearer and has not been met lies farther than s - 1 in every segment, and within s in one of those.
"""

from __future__ import annotations

import itertools
import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.common import written


def sign_bits(vector: Column, dims: int) -> Column:
    """Sign code of a ``dims``-dimensional vector as longs of 64 bits: bit i is 1 where value i is positive.

    Null vectors have no code; null values and missing tail values count as 0 bits.
    """
    words = []
    for lo in range(0, dims, 64):
        bits = [F.when(F.get(vector, F.lit(lo + i)) > 0, F.lit(1 << i if i < 63 else -(1 << 63)).cast("long"))
                for i in range(min(64, dims - lo))]
        words.append(reduce(Column.bitwiseOR, [F.coalesce(bit, F.lit(0).cast("long")) for bit in bits]))
    return F.when(vector.isNotNull(), F.array(*words))


def distance(a: Column, b: Column, words: int) -> Column:
    return sum((F.bit_count(F.element_at(a, i + 1).bitwiseXOR(F.element_at(b, i + 1))) for i in range(words)), F.lit(0))


def _segments(dims: int, m: int) -> list[tuple[int, int, int]]:
    """(word, shift, width) of each segment; segments do not cross words."""
    per_word, out = max(1, m // -(-dims // 64)), []
    for word in range(-(-dims // 64)):
        bits = min(64, dims - 64 * word)
        cuts = [bits * i // per_word for i in range(per_word + 1)]
        out += [(word, a, b - a) for a, b in itertools.pairwise(cuts) if b > a]
    return out


def _values(code: Column, segments) -> Column:
    return F.array(*[F.shiftrightunsigned(F.element_at(code, w + 1), shift).bitwiseAND(F.lit((1 << width) - 1 if width < 63 else -1).cast("long"))
                     for w, shift, width in segments])


def _masks(width: int, radius: int) -> Column:
    """All ``width``-bit masks of ``radius`` bits, as one literal: the plan stays small however many there are."""
    values = (sum(1 << i for i in c) for c in itertools.combinations(range(width), radius))
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def segment_count(n: int, dims: int, k: int = 10) -> int:
    """Segments for ``n`` codes: the number with the fewest probes and codes met for a query, as reckoned for codes
    that lie evenly. Wider segments need more probes, narrower ones meet more strangers."""
    words, n = -(-dims // 64), max(n, 16)
    chance, within, kth = 0.5 ** dims, 0.0, -1
    while within * n < k and kth < dims:  # distance up to which k codes of n lie
        kth += 1
        within += math.comb(dims, kth) * chance

    def cost(m: int) -> float:
        radius, rest = divmod(kth, m)
        width = dims / m
        ball = lambda r: sum(math.comb(round(width), i) for i in range(r + 1))
        probes = (rest + 1) * ball(radius) + (m - rest - 1) * ball(radius - 1)
        return probes * (1 + n / 2 ** width)

    return min(range(words, max(words, round(dims / 4)) + 1), key=cost)


def top_k(codes: DataFrame, queries: DataFrame, dims: int, k: int = 10, n_rows: int | None = None) -> DataFrame:
    """The k nearest rows of ``codes (id, code)`` for each row of ``queries (id, code)``.

    Returns ``query_id, rank, id, hamming``, ordered by distance and then id; a query that is
    itself a row finds itself. Rows without a code take no part; with fewer than k rows every
    row is returned. Equal codes are searched once: an index entry keeps the k smallest ids
    of its code (no other can be among the first k), picked in salted parts first, so a
    vector that fills a third of the table is no hot bucket. Every query code is resolved
    once, however many rows carry it.
    """
    spark = codes.sparkSession
    words = -(-dims // 64)
    small = Window.partitionBy("code", "salt").orderBy("id")
    fewest = Window.partitionBy("code").orderBy("id")
    kept = codes.filter("code is not null").select("id", "code", F.pmod(F.xxhash64("id"), F.lit(256)).alias("salt")) \
        .withColumn("r", F.row_number().over(small)).filter(F.col("r") <= k) \
        .withColumn("r", F.row_number().over(fewest)).filter(F.col("r") <= k)
    index = written(kept.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), "codes")
    n = n_rows or max(2, index.count())
    segments = _segments(dims, segment_count(n, dims, k))
    m = len(segments)
    seek = written(queries.filter("code is not null").select("code").distinct()
                   .select(F.monotonically_increasing_id().alias("q"), F.col("code").alias("qcode")), "seek")
    entry = written(index.select("code", F.size("ids").alias("copies"), F.posexplode(_values(F.col("code"), segments)).alias("seg", "value")), "segments")
    nearest = Window.partitionBy("q").orderBy("d")
    best = done = None
    open_q = seek.withColumn("bound", F.lit(None).cast("int"))
    for radius in range(max(width for _, _, width in segments) + 1):
        masks = F.lit(None).cast("array<bigint>")
        for w in sorted({w for _, _, w in segments if w >= radius}):
            masks = F.when(F.col("seg").isin([i for i, x in enumerate(segments) if x[2] == w]), _masks(w, radius)).otherwise(masks)
        # a code within m * radius + i that no smaller radius has met lies within the radius in one of the first i + 1 segments
        # dealt by number, so that few queries with many probes are still many tasks
        probe = open_q.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "q").select("q", "qcode", "bound", F.posexplode(_values(F.col("qcode"), segments)).alias("seg", "qvalue")) \
            .filter(F.col("bound").isNull() | (F.col("seg") <= F.col("bound") - m * radius)) \
            .select("q", "qcode", "bound", "seg", "qvalue", F.explode(masks).alias("mask")) \
            .select("q", "qcode", "bound", F.col("seg").alias("pseg"), F.col("qvalue").bitwiseXOR(F.col("mask")).alias("pvalue"))
        # a code met in several segments is taken in the first of its closest segments only, and
        # one farther than the k-th best so far is not taken at all
        apart = F.transform(F.arrays_zip(_values(F.col("qcode"), segments).alias("x"), _values(F.col("code"), segments).alias("y")),
                            lambda z: F.bit_count(z["x"].bitwiseXOR(z["y"])))
        d = distance(F.col("qcode"), F.col("code"), words)
        # merge: the optimiser takes the probes for as small as the queries they are made from and would broadcast them
        found = probe.hint("merge").join(entry, (F.col("pseg") == F.col("seg")) & (F.col("pvalue") == F.col("value"))
                                         & (F.col("bound").isNull() | (d <= F.col("bound")))
                                         & (F.array_min(apart) == radius) & (F.array_position(apart, F.array_min(apart)) == F.col("seg") + 1)) \
            .select("q", "code", "copies", d.alias("d"))
        if best is not None:
            found = found.unionByName(best.select("q", "code", "copies", "d"))
        # rank counts codes, so it keeps whole distances and at least every row of the first k
        kept = written(found.withColumn("r", F.rank().over(nearest)).filter(F.col("r") <= k).drop("r"), "near")
        upto = kept.groupBy("q", "d").agg(F.sum("copies").alias("n")) \
            .withColumn("upto", F.sum("n").over(nearest)).filter(F.col("upto") >= k).groupBy("q").agg(F.min("d").alias("kth"))
        best = written(kept.join(upto, "q", "left").filter("kth is null or d <= kth"), "near")
        covered = m * (radius + 1) - 1
        closed = best.filter(F.col("kth") <= covered)
        done = closed if done is None else done.unionByName(closed)
        ids = closed.select("q").distinct()
        best = best.join(ids, "q", "left_anti")
        bounds = best.groupBy("q").agg(F.max("kth").alias("bound"))
        open_q = written(seek.join(done.select("q").distinct(), "q", "left_anti")
                         .join(bounds, "q", "left").select("q", "qcode", "bound"), "open")
        if not open_q.limit(1).count():
            break
    else:  # every segment value was probed: fewer than k rows in all
        done = done.unionByName(best)
    results = done
    ranked = results.join(index.select("code", "ids"), "code").select("q", "d", F.explode("ids").alias("id")) \
        .withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy("d", "id"))).filter(F.col("rank") <= k)
    asked = queries.filter("code is not null").select(F.col("id").alias("query_id"), F.col("code").alias("qcode")).join(seek, "qcode")
    return asked.join(ranked, "q").select("query_id", F.col("rank").cast("int").alias("rank"), "id", F.col("d").cast("int").alias("hamming"))


def search_embeddings(embeddings: DataFrame, every: int = 20, k: int = 10, dims: int | None = None) -> DataFrame:
    """Query ``op10_hamming``: sign codes of all vectors; queries are the ids divisible by ``every``.

    ``dims`` is the width of the widest vector unless given; a vector that is wider than a given ``dims`` raises.
    Missing and null values count as 0 bits; NaN sorts above every number and is a 1 bit.
    """
    width = embeddings.agg(F.max(F.size("embedding"))).first()[0] or 0
    if dims is not None and width > dims:
        raise ValueError(f"vectors of {width} values do not fit {dims} dimensions")
    dims = dims or max(1, width)
    codes = embeddings.select(F.col("vec_id").alias("id"), sign_bits(F.col("embedding"), dims).alias("code"))
    codes = written(codes, "signs")
    return top_k(codes, codes.filter(F.col("id") % every == 0), dims, k)
