"""Exact ranks and quantiles without sending a whole group (or table) through one task.

``percentile`` / ``percent_rank() OVER (...)`` place every value of a group in one
task. Here the work is a sample sort:

1. count rows per distinct ``(keys, value)`` (map-side partial aggregation: a hot key
   with few distinct values collapses at once);
2. range partition the distinct values by ``(keys, value)``. Spark draws the splitters from a sample
   of the data itself (an overfull input partition is sampled again), so partitions hold about equally many values however they
   lie: a key with very many values in a narrow range is cut as finely as any other. The sorted
   partitions are written once with each row's place, and the place fixes the bucket;
3. a window per ``(keys, bucket)`` gives the count of smaller values inside the
   bucket, and a window over the bucket totals of a key (one per partition that has the key) gives
   the count of values in lower buckets.

Where the plan's statistics bound the whole input by ``ONE_TASK_BYTES``, no key can be too large for a
task, and one window per key does the same without the sort.

``below`` = rows with a strictly smaller value; ``n`` = rows of the key. Ranks and
interpolated quantiles follow exactly from these two numbers; the splitters only decide how the work
is split, never the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from meterlake.session import stored


#: Input that one task can rank by itself: far below an executor's memory, also after decompression.
ONE_TASK_BYTES = 16 * 1024 * 1024


def _fits_one_task(df: DataFrame) -> bool:
    """Whether Spark's statistics bound the size of ``df`` by ONE_TASK_BYTES (file sizes, where nothing better is known)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= ONE_TASK_BYTES


def value_ranks(df: DataFrame, value: str, keys: list[str] | tuple = (), partitions: int | None = None) -> DataFrame:
    """``keys..., value, cnt, below, n`` per distinct value (NULL and NaN values are ignored).

    ``partitions``: number of ranges of the sample sort; by default the session's shuffle width, which AQE
    coalesces by size, and no ranges for an input that one task can hold.
    """
    keys = list(keys)
    src = df.select(*keys, F.col(value).cast("double").alias(value)).filter(
        F.col(value).isNotNull() & ~F.isnan(F.col(value)))
    d = src.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("cnt"))
    if partitions is None and _fits_one_task(src):
        one = Window.partitionBy(*keys)
        below = F.coalesce(F.sum("cnt").over(one.orderBy(value).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        return d.select(*keys, value, "cnt", below.alias("below"), F.sum("cnt").over(one).alias("n"))
    width = [partitions] if partitions else []
    d = stored(d.repartitionByRange(*width, *keys, value).withColumn("__b", F.spark_partition_id()), "value-ranges")
    inner = Window.partitionBy(*keys, "__b").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("__in", F.coalesce(F.sum("cnt").over(inner), F.lit(0)))
    per_key = Window.partitionBy(*keys) if keys else Window.partitionBy()
    outer = (Window.partitionBy(*keys).orderBy("__b") if keys else Window.orderBy("__b")).rowsBetween(
        Window.unboundedPreceding, -1)
    bt = (d.groupBy(*keys, "__b").agg(F.sum("cnt").alias("__bn"))
          .withColumn("__off", F.coalesce(F.sum("__bn").over(outer), F.lit(0)))
          .withColumn("n", F.sum("__bn").over(per_key))
          .select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__b").alias("__c"), "__off", "n"))
    same = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)] + [F.col("__b") == F.col("__c")]
    return d.join(bt, same).select(*keys, value, "cnt", (F.col("__off") + F.col("__in")).alias("below"), "n")


def quantiles(df: DataFrame, value: str, keys: list[str] | tuple = (), ps=(0.5,),
              names: list[str] | None = None, partitions: int | None = None) -> DataFrame:
    """Exact continuous quantiles (linear interpolation between closest ranks) per key.

    For ``p``: ``h = p * (n - 1)``; with ``lo = floor(h)``, ``hi = ceil(h)`` and ``v(r)`` the
    value at 0-based rank ``r``: ``v(lo) + (h - lo) * (v(hi) - v(lo))``.
    """
    keys = list(keys)
    names = names or [f"p{int(round(p * 100))}" for p in ps]
    r = value_ranks(df, value, keys, partitions)
    end = F.col("below") + F.col("cnt")
    aggs = [F.max("n").alias("__n")]
    for p, nm in zip(ps, names):
        h = F.lit(float(p)) * (F.col("n") - 1)
        aggs.append(F.min(F.when(end > F.floor(h), F.col(value))).alias(f"__lo_{nm}"))
        aggs.append(F.min(F.when(end > F.ceil(h), F.col(value))).alias(f"__hi_{nm}"))
    g = r.groupBy(*keys).agg(*aggs)
    out = [*keys]
    for p, nm in zip(ps, names):
        h = F.lit(float(p)) * (F.col("__n") - 1)
        lo, hi = F.col(f"__lo_{nm}"), F.col(f"__hi_{nm}")
        out.append((lo + (h - F.floor(h)) * (hi - lo)).alias(nm))
    return g.select(*out)


def exact_quantile(df: DataFrame, value: str, p: float = 0.5) -> float | None:
    """One exact quantile of a column as a driver scalar (a one-row result)."""
    row = quantiles(df, value, (), (p,), ["q"]).first()
    return None if row is None else row["q"]


def with_percent_rank(df: DataFrame, value: str, out: str = "score", keys: list[str] | tuple = (),
                      partitions: int | None = None) -> DataFrame:
    """Add ``percent_rank`` of ``value`` (within ``keys``): ``(rank - 1) / (n - 1)``, 0 when n = 1.

    Equal values share a rank; rows with a NULL value get NULL.
    """
    keys = list(keys)
    r = value_ranks(df, value, keys, partitions).select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col(value).alias("__v"),
        F.when(F.col("n") > 1, F.col("below") / (F.col("n") - 1)).otherwise(F.lit(0.0)).alias(out))
    cond = [F.col(value).cast("double") == F.col("__v")] + [F.col(k).eqNullSafe(F.col(f"__k{i}"))
                                                            for i, k in enumerate(keys)]
    joined = df.join(r, cond, "left")
    return joined.select(*df.columns, out)
