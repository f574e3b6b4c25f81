"""JN-5, JN-6, AG-2..4, AG-8, AG-13, REP-6: lineage edges held as tables.

Writes are ``(producer, table, date)`` rows, reads are ``(table, consumer_type,
consumer_id, date)`` rows. Every function first reduces each side to one row per
join key (distinct producer-table pairs, per-table consumer aggregates) and only then
joins, so a busy table never multiplies producer rows by consumer rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def produced(writes: DataFrame, job: str = "job_id", table: str = "table_id") -> DataFrame:
    """Distinct ``(job, table)`` pairs."""
    return writes.select(job, table).distinct()


def counted(reads: DataFrame, types: list[str], type_col: str = "consumer_type") -> DataFrame:
    """FIL-4: reads by a counted consumer type (``IN (list)``)."""
    return reads.filter(F.col(type_col).isin(types))


def tables_per_job(writes: DataFrame, job: str = "job_id", table: str = "table_id",
                   approx: bool = False) -> DataFrame:
    """AG-2: number of distinct tables each job wrote: ``job, tables``.

    ``approx=True`` uses a HyperLogLog++ sketch (``approx_count_distinct``, ~1% error),
    which keeps a fixed-size buffer per job instead of the distinct pairs.
    """
    n = F.approx_count_distinct(table, 0.01) if approx else F.countDistinct(table)
    return writes.groupBy(job).agg(n.alias("tables"))


def consumers_per_table(reads: DataFrame, table: str = "table_id") -> DataFrame:
    """AG-3: read count per table: ``table, consumers``."""
    return reads.groupBy(table).agg(F.count(F.lit(1)).alias("consumers"))


def counted_per_table(reads: DataFrame, table: str = "table_id") -> DataFrame:
    """``table, consumers`` of raw reads, or of reads that come counted already (``table, consumers``), in parts or whole."""
    if "consumers" in reads.columns:
        return reads.groupBy(table).agg(F.sum("consumers").alias("consumers"))
    return consumers_per_table(reads, table)


def consumer_breakdown(reads: DataFrame, types: list[str], table: str = "table_id",
                       type_col: str = "consumer_type", id_col: str = "consumer_id") -> DataFrame:
    """AG-4: distinct consumers per table plus reads per consumer type (one column per type)."""
    aggs = [F.countDistinct(F.col(type_col), F.col(id_col)).alias("distinct_consumers")]
    aggs += [F.count_if(F.col(type_col) == t).cast("bigint").alias(t.lower()) for t in types]
    return reads.groupBy(table).agg(*aggs)


def daily_consumer_sketches(reads: DataFrame, table: str = "table_id", date: str = "read_date", type_col: str = "consumer_type",
                            id_col: str = "consumer_id", lg_k: int = 12) -> DataFrame:
    """AG-4 kept per day: ``table, day, sketch``, a mergeable HLL sketch of the consumers that read the table on that day.

    A sketch takes some 40 bytes for few consumers, where it is exact, and ``2 ** lg_k`` bytes at most, with a relative standard error of about
    ``0.83 / sqrt(2 ** lg_k)`` (1.3 % at 12). Store them (``operators.rollup`` keeps such tables up), and any span of days is a union of them.
    """
    consumer = F.concat_ws(":", F.col(type_col), F.col(id_col).cast("string"))
    rows = reads.filter(F.col(date).isNotNull() & F.col(id_col).isNotNull())
    return rows.groupBy(table, F.col(date).cast("date").alias("day")).agg(F.hll_sketch_agg(consumer, F.lit(lg_k)).alias("sketch"))


def consumers_rolling(sketches: DataFrame, days: int, table: str = "table_id", chunk_days: int | None = None) -> DataFrame:
    """``table, day, consumers``: distinct consumers of the ``days`` days that end at each day with a read, from daily sketches.

    A sketch is handed to its own chunk of ``chunk_days`` days (eight times ``days`` by default) and, where it still counts there, to the
    next one, and a window per table and chunk unites the sketches of each day's span: sketches are shuffled once and
    a bit, not once a day of the span, and a task holds a chunk and the span before it, however long the history is.
    """
    width = chunk_days or 8 * days
    chunk = lambda day: F.floor(day / width).cast("long")
    own = sketches.filter(F.col("day").isNotNull()).withColumn("__d", F.unix_date("day")).withColumn("__own", chunk(F.col("__d")))
    handed = own.withColumn("__chunk", F.explode(F.sequence("__own", chunk(F.col("__d") + (days - 1)))))
    time = Window.partitionBy(table, "__chunk").orderBy("__d")
    united = handed.select(table, "day", "__d", "__own", "__chunk", F.hll_union_agg("sketch").over(time.rangeBetween(-(days - 1), 0)).alias("sketch"),
                           F.lag("__d").over(time).alias("__last"))
    # a day that comes in several sketches is one row
    united = united.filter("__own = __chunk AND (__last IS NULL OR __last < __d)")
    return united.select(table, "day", F.hll_sketch_estimate("sketch").alias("consumers"))


def lineage_path(writes: DataFrame, reads: DataFrame, job: str = "job_id", table: str = "table_id",
                 type_col: str = "consumer_type", id_col: str = "consumer_id") -> DataFrame:
    """JN-5: job -> produced table -> consumer type, with distinct consumers and reads.

    Reads are first aggregated to ``(table, consumer_type)``; the join with distinct
    ``(job, table)`` pairs then yields one row per job, table and consumer type
    instead of every producer-consumer pair.
    """
    per_type = reads.groupBy(table, type_col).agg(
        F.countDistinct(id_col).alias("consumers"), F.count(F.lit(1)).alias("reads"))
    return produced(writes, job, table).join(per_type, table)


def unused_tables(writes: DataFrame, reads: DataFrame, table: str = "table_id") -> DataFrame:
    """JN-6: tables produced in the window with no counted read in the window (LEFT ANTI)."""
    return writes.select(table).distinct().join(reads.select(table).distinct(), table, "left_anti")


def lineage_edges(writes: DataFrame, reads: DataFrame, job: str = "job_id", table: str = "table_id",
                  type_col: str = "consumer_type") -> DataFrame:
    """REP-6: weighted Sankey edges ``source, target, weight``.

    ``job:<id> -> table:<id>`` weighted by writes, and ``table:<id> -> <consumer type>``
    weighted by reads; both are plain aggregates unioned together.
    """
    w = writes.groupBy(job, table).agg(F.count(F.lit(1)).alias("weight")).select(
        F.concat(F.lit("job:"), F.col(job).cast("string")).alias("source"),
        F.concat(F.lit("table:"), F.col(table).cast("string")).alias("target"), "weight")
    r = reads.groupBy(table, type_col).agg(F.count(F.lit(1)).alias("weight")).select(
        F.concat(F.lit("table:"), F.col(table).cast("string")).alias("source"),
        F.col(type_col).alias("target"), "weight")
    return w.unionByName(r)


def table_freshness(writes: DataFrame, as_of, table: str = "table_id", date: str = "write_date") -> DataFrame:
    """AG-8: last write per table and its age in days at ``as_of``."""
    from meterlake.functions.columns import date_lit
    return writes.groupBy(table).agg(F.max(date).alias("last_write")).withColumn(
        "age_days", F.datediff(date_lit(as_of), F.col("last_write")).cast("bigint"))


def refresh_stats(writes: DataFrame, table: str = "table_id", date: str = "write_date") -> DataFrame:
    """AG-13 + WN-3: refreshes, mean gap between refreshes (days) and written rows per table.

    Writes are collapsed to distinct refresh days first; the ``lag`` window then runs
    over at most one row per table and day.
    """
    days = writes.groupBy(table, date).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(table).orderBy(date)
    gaps = days.withColumn("gap", F.datediff(F.col(date), F.lag(date).over(w)))
    return gaps.groupBy(table).agg(
        F.count(F.lit(1)).alias("refreshes"),
        F.round(F.avg("gap"), 6).alias("mean_gap_days"),
        F.sum("n").alias("rows"))
