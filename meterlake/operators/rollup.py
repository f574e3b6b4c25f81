"""AG-7 / FIL-5: daily partial aggregates, kept up batch by batch.

A rollup holds one row per day and key with decomposable sums (a sum of exact amounts, a count), so
any span of days is answered by adding up rows of the rollup, and the facts are not read again. A
batch changes only the days that it has rows of; ``refresh`` aggregates these days anew from
the facts as they are now, late rows and reloaded days included, and writes them as a new generation:

    <path>/data/gen=<n>/     (day, keys..., sums...) of the refreshed days
    <path>/days/gen=<n>/     the days that generation n stands for, rows or none; written last

A day's newest generation is the one that counts. Nothing is overwritten: a refresh that breaks off
leaves a generation without its days, which nobody reads, and running it again is harmless.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.functions.columns import date_lit


def _generations(spark: SparkSession, path: str, part: str) -> list[int]:
    """Generations of which ``part`` was written to its end, from the folder listing."""
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{part}/gen=*/_SUCCESS")
    found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted(int(f.getPath().getParent().getName().removeprefix("gen=")) for f in found or ())


def days_of(df: DataFrame, day: str) -> list[dt.date]:
    """The days that ``df`` has rows of: what a batch changes (a list of days, however many rows they hold)."""
    return sorted(r[0] for r in df.select(F.col(day).cast("date").alias("day")).filter("day IS NOT NULL").distinct().collect())


def refresh(facts: DataFrame, day: str, keys: list[str], sums: dict[str, Column], path: str, days: list[dt.date] | None = None) -> int | None:
    """Aggregate ``days`` of ``facts`` (None: every day they have) by day and ``keys`` into a new generation, and return its number.

    The days are a filter on ``day``, with their first and last one as bounds that reach the scan. Days without rows any more become
    empty. No days: nothing is written. Rows without a day are in no rollup; NULL keys are keys like others.
    """
    spark = facts.sparkSession
    rows = facts.filter(F.col(day).isNotNull())
    if days is None:
        days = days_of(rows, day)
    if not days:
        return None
    touched = spark.createDataFrame([(d,) for d in days], "day date")
    rows = rows.filter(F.col(day).between(date_lit(min(days)), date_lit(max(days)))).withColumn("__day", F.col(day).cast("date"))
    rows = rows.join(touched.withColumnRenamed("day", "__day"), "__day", "left_semi")
    gen = max(_generations(spark, path, "days"), default=0) + 1
    out = rows.groupBy(F.col("__day").alias("day"), *keys).agg(*[c.alias(name) for name, c in sums.items()])
    out.hint("rebalance", "day").write.mode("overwrite").parquet(f"{path}/data/gen={gen:010d}")
    touched.coalesce(1).write.mode("overwrite").parquet(f"{path}/days/gen={gen:010d}")
    return gen


def within(df: DataFrame, as_of: dt.date, days: int) -> DataFrame:
    """The rows of the ``days`` days that end at ``as_of``, as ``last_days`` counts them."""
    return df.filter(F.col("day").between(date_lit(as_of - dt.timedelta(days=days)), date_lit(as_of)))


def read(spark: SparkSession, path: str, as_of: dt.date, days: int) -> DataFrame:
    """The rollup's rows of the ``days`` days that end at ``as_of``, as ``last_days`` counts them, each day from its newest generation."""
    gens = _generations(spark, path, "days")
    if not gens:
        raise ValueError(f"nothing was rolled up in {path}")
    at = lambda part: [f"{path}/{part}/gen={g:010d}" for g in gens]
    newest = within(spark.read.option("basePath", f"{path}/days").parquet(*at("days")), as_of, days).groupBy("day").agg(F.max("gen").alias("gen"))
    rows = within(spark.read.option("basePath", f"{path}/data").option("mergeSchema", "true").parquet(*at("data")), as_of, days)
    return rows.join(newest, ["day", "gen"]).drop("gen")


def merge(spark: SparkSession, path: str) -> int | None:
    """Write every day's newest generation as one, so that a reader opens one folder; older ones are left to their readers.

    Returns the new generation, or None where there is one already (or none).
    """
    gens = _generations(spark, path, "days")
    if len(gens) < 2:
        return None
    rows = read(spark, path, dt.date(9999, 12, 31), (dt.date(9999, 12, 31) - dt.date(1, 1, 1)).days)
    days = spark.read.option("basePath", f"{path}/days").parquet(*[f"{path}/days/gen={g:010d}" for g in gens]).select("day").distinct()
    gen = gens[-1] + 1
    rows.hint("rebalance", "day").write.mode("overwrite").parquet(f"{path}/data/gen={gen:010d}")
    days.coalesce(1).write.mode("overwrite").parquet(f"{path}/days/gen={gen:010d}")
    return gen
