"""REP-1..5, AG-1, AG-5..7, AG-9..12, AG-14..16, WN-2, WN-4, TK-1..3: cost against utilization.

Grain rule (D-13): cost, produced tables and consumers are each reduced to one row
per resource *before* they are joined, so no join can repeat a cost or inflate a sum.
Money stays an exact decimal until the final ``money()`` rounding to cents.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from meterlake.functions.columns import money, ratio
from meterlake.operators import lineage


def job_cost_per_consumer(priced: DataFrame, jobs: DataFrame, writes: DataFrame, reads: DataFrame,
                          resource: str = "resource_id") -> DataFrame:
    """REP-1: ``job_id, name, total_cost, tables, consumers, cost_per_consumer``.

    * cost: priced usage summed per job (the job must have cost: inner join, JN-3);
    * tables: distinct tables the job produced (its writes);
    * consumers: counted reads of those produced tables, summed over the tables;
    * ratio: cost / consumers, NULL when there are none (AG-5); ordered by it,
      descending, NULLs last (TK-1).
    """
    cost = priced.groupBy(F.col(resource).alias("job_id")).agg(F.sum("cost").alias("__cost"))
    per_table = lineage.counted_per_table(reads)
    job_use = (lineage.produced(writes).join(per_table, "table_id", "left")
               .groupBy("job_id").agg(F.count(F.lit(1)).alias("tables"),
                                      F.coalesce(F.sum("consumers"), F.lit(0)).alias("consumers")))
    return (jobs.select("job_id", "name").join(cost, "job_id").join(job_use, "job_id", "left")
            .select("job_id", "name", money("__cost").alias("total_cost"),
                    F.coalesce("tables", F.lit(0)).cast("bigint").alias("tables"),
                    F.coalesce("consumers", F.lit(0)).cast("bigint").alias("consumers"))
            .withColumn("cost_per_consumer", ratio("total_cost", "consumers"))
            .orderBy(F.desc_nulls_last("cost_per_consumer"), "job_id"))


def cost_per_resource(priced: DataFrame, resource: str = "resource_id", out_key: str = "job_id") -> DataFrame:
    """AG-1: ``<out_key>, total_cost`` (cents, DOUBLE)."""
    return priced.groupBy(F.col(resource).alias(out_key)).agg(money(F.sum("cost")).alias("total_cost"))


def cost_by_state(priced: DataFrame, resource: str = "resource_id", state: str = "state",
                  out_key: str = "job_id") -> DataFrame:
    """AG-6: cost of successful and of failed runs per resource (conditional sums, one pass)."""
    def part(s):
        return money(F.coalesce(F.sum(F.when(F.col(state) == s, F.col("cost"))), F.lit(0)))
    return priced.groupBy(F.col(resource).alias(out_key)).agg(
        part("SUCCESS").alias("cost_success"), part("FAILED").alias("cost_failed"))


def cost_trend(priced: DataFrame, resource: str = "resource_id", date: str = "usage_date",
               unit: str = "day") -> DataFrame:
    """AG-7: cost per resource and time bucket (``day`` / ``week`` / ``month``): ``resource_id, bucket, cost``."""
    bucket = F.col(date) if unit == "day" else F.date_trunc(unit, F.col(date)).cast("date")
    return priced.groupBy(F.col(resource).alias("resource_id"), bucket.alias("bucket")).agg(
        money(F.sum("cost")).alias("cost"))


def rolling_cost(priced: DataFrame, days: int = 30, resource: str = "resource_id",
                 date: str = "usage_date") -> DataFrame:
    """WN-2: per resource and day with usage: the day's cost and the cost of the ``days`` days
    ending that day (RANGE frame over the day number, so missing days are handled).

    Rows are reduced to one per resource and day before the window, so a window
    partition holds at most one row per day of the resource's history. The frame sums
    exact integers (the decimal cost in units of its last digit) instead of wide
    decimals, which keeps the sliding sum in 64-bit arithmetic; ANSI mode turns an
    overflow into an error, never a wrong value.
    """
    scale = priced.schema["cost"].dataType.scale
    daily = priced.groupBy(F.col(resource).alias("resource_id"), F.col(date).alias("usage_date")).agg(
        F.sum("cost").alias("__c"))
    w = Window.partitionBy("resource_id").orderBy(F.unix_date("usage_date")).rangeBetween(-(days - 1), 0)
    units = (F.col("__c") * F.lit(10 ** scale)).cast("bigint")
    return (daily.select("resource_id", "usage_date", money("__c").alias("daily_cost"),
                         F.sum(units).over(w).alias("__u"))
            .select("resource_id", "usage_date", "daily_cost", units_to_money("__u", scale).alias("rolling_cost")))


def units_to_money(col: str, scale: int):
    """An exact integer count of ``10^-scale`` units as cents (half away from zero), DOUBLE.

    Equal to ``CAST(ROUND(col * 10^-scale, 2) AS DOUBLE)`` without leaving 64-bit integers.
    """
    if scale <= 2:
        return (F.col(col) * F.lit(10 ** (2 - scale))).cast("double") / F.lit(100.0)
    unit, half = 10 ** (scale - 2), 10 ** (scale - 2) // 2
    cents = F.expr(f"CASE WHEN `{col}` >= 0 THEN (`{col}` + {half}) div {unit} "
                   f"ELSE -((-`{col}` + {half}) div {unit}) END")
    return cents.cast("double") / F.lit(100.0)


def efficiency_trend(priced: DataFrame, writes: DataFrame, reads: DataFrame, unit: str = "month",
                     resource: str = "resource_id") -> DataFrame:
    """AG-7: per job and time bucket: cost, counted reads of the tables it wrote in that
    bucket, and cost per read. Both sides are aggregated to ``(job, bucket)`` first,
    then full-outer joined so buckets with only cost or only reads remain.
    """
    def b(c):
        return F.date_trunc(unit, F.col(c)).cast("date")
    cost = priced.groupBy(F.col(resource).alias("job_id"), b("usage_date").alias("bucket")).agg(
        F.sum("cost").alias("__c"))
    prod = writes.select("job_id", "table_id", b("write_date").alias("bucket")).distinct()
    per_table = reads.groupBy("table_id", b("read_date").alias("bucket")).agg(F.count(F.lit(1)).alias("__r"))
    use = prod.join(per_table, ["table_id", "bucket"]).groupBy("job_id", "bucket").agg(
        F.sum("__r").alias("reads"))
    return (cost.join(use, ["job_id", "bucket"], "full")
            .select("job_id", "bucket", money("__c").alias("cost"),
                    F.coalesce("reads", F.lit(0)).cast("bigint").alias("reads"))
            .withColumn("cost_per_read", ratio("cost", "reads")))


def allocate(cost: DataFrame, outputs: DataFrame, key: str, item: str, cost_col: str = "cost",
             out: str = "cost_share") -> DataFrame:
    """WN-4: split each resource's cost equally over its distinct outputs.

    ``cost``: one row per ``key`` with ``cost_col``; ``outputs``: ``(key, item)`` pairs.
    Output count per key is an aggregate joined back (no window over a whole
    resource), and the shares of a resource sum to its cost.
    """
    pairs = outputs.select(key, item).distinct()
    n = pairs.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    return (pairs.join(n, key).join(cost.select(key, cost_col), key)
            .select(key, item, (F.col(cost_col).cast("double") / F.col("__n")).alias(out)))


def table_cost(priced: DataFrame, writes: DataFrame, resource: str = "resource_id") -> DataFrame:
    """AG-9: maintenance cost per table = sum of its writers' cost shares (equal split, WN-4)."""
    cost = priced.groupBy(F.col(resource).alias("job_id")).agg(money(F.sum("cost")).alias("cost"))
    shares = allocate(cost, writes, "job_id", "table_id")
    return shares.groupBy("table_id").agg(F.round(F.sum("cost_share"), 6).alias("cost"))


def table_cost_per_read(tcost: DataFrame, reads: DataFrame) -> DataFrame:
    """REP-3: ``table_id, cost, reads, cost_per_read`` for every produced table."""
    r = lineage.counted_per_table(reads).withColumnRenamed("consumers", "reads")
    return (tcost.join(r, "table_id", "left")
            .select("table_id", "cost", F.coalesce("reads", F.lit(0)).cast("bigint").alias("reads"))
            .withColumn("cost_per_read", F.round(ratio("cost", "reads"), 6)))


def endpoint_cost_per_query(priced: DataFrame, queries: DataFrame, resource: str = "resource_id",
                            endpoint: str = "endpoint_id") -> DataFrame:
    """REP-2: ``endpoint_id, total_cost, query_count, cost_per_query``.

    Query counts are grouped by an explicit endpoint id (D-16); endpoints with cost
    but no queries keep a 0 count and a NULL ratio.
    """
    cost = priced.groupBy(F.col(resource).alias("endpoint_id")).agg(F.sum("cost").alias("__c"))
    qc = queries.groupBy(F.col(endpoint).alias("endpoint_id")).agg(F.count(F.lit(1)).alias("__q"))
    return (cost.join(qc, "endpoint_id", "left")
            .select("endpoint_id", money("__c").alias("total_cost"),
                    F.coalesce("__q", F.lit(0)).cast("bigint").alias("query_count"))
            .withColumn("cost_per_query", ratio("total_cost", "query_count")))


def pipeline_roi(priced: DataFrame, outputs: DataFrame, reads: DataFrame, resource: str = "resource_id") -> DataFrame:
    """REP-5: ``pipeline_id, cost, consumers, cost_per_consumer``; consumers = counted reads
    of the pipeline's output tables (``outputs``: ``pipeline_id, table_id``)."""
    cost = priced.groupBy(F.col(resource).alias("pipeline_id")).agg(F.sum("cost").alias("__c"))
    per_table = lineage.counted_per_table(reads)
    use = (outputs.select("pipeline_id", "table_id").distinct().join(per_table, "table_id", "left")
           .groupBy("pipeline_id").agg(F.coalesce(F.sum("consumers"), F.lit(0)).alias("consumers")))
    return (cost.join(use, "pipeline_id", "left")
            .select("pipeline_id", money("__c").alias("cost"),
                    F.coalesce("consumers", F.lit(0)).cast("bigint").alias("consumers"))
            .withColumn("cost_per_consumer", ratio("cost", "consumers")))


def cost_per_run(priced: DataFrame, usage: DataFrame, resource: str = "resource_id",
                 run: str = "update_id") -> DataFrame:
    """AG-12: ``pipeline_id, runs, cost, cost_per_run`` (runs = distinct update ids)."""
    cost = priced.groupBy(F.col(resource).alias("pipeline_id")).agg(F.sum("cost").alias("__c"))
    runs = usage.groupBy(F.col(resource).alias("pipeline_id")).agg(F.countDistinct(run).alias("runs"))
    return (cost.join(runs, "pipeline_id", "left")
            .select("pipeline_id", F.coalesce("runs", F.lit(0)).cast("bigint").alias("runs"),
                    money("__c").alias("cost"))
            .withColumn("cost_per_run", ratio("cost", "runs")))


def by_hour(log: DataFrame, ts: str = "start_time") -> DataFrame:
    """AG-10: query count by hour of day and weekday (0 = Sunday): ``hour, weekday, n``."""
    return log.groupBy(F.hour(ts).cast("bigint").alias("hour"),
                       (F.dayofweek(ts) - 1).cast("bigint").alias("weekday")).agg(
        F.count(F.lit(1)).alias("n"))


def peak_hour(log: DataFrame, key: str = "endpoint_id", ts: str = "start_time") -> DataFrame:
    """AG-10: busiest hour per key (ties: lowest hour): ``key, hour, n``.

    ``max(struct(n, -hour))`` is a plain aggregate (partial aggregation, no window),
    and it fixes the tie rule.
    """
    per = log.groupBy(key, F.hour(ts).cast("bigint").alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    best = per.groupBy(key).agg(F.max(F.struct("n", (-F.col("hour")).alias("neg"))).alias("__m"))
    return best.select(key, (-F.col("__m.neg")).alias("hour"), F.col("__m.n").alias("n"))


def rolling_sum(df: DataFrame, key: str, ts: str, value: str, width: dt.timedelta, out: str = "rolling",
                chunk: dt.timedelta | None = None) -> DataFrame:
    """WN-2 for dense histories: per row the sum of ``value`` over the ``width`` that ends at its ``ts`` (the start of that span left out), within ``key``.

    A window per key puts a resource's whole history into one task. Here time is cut into chunks (eight
    times the width by default); a row goes to its own chunk and, as halo, to the later ones that its value still counts for, and the
    window runs per key and chunk. A task holds a chunk and the width before it, however long the history is, at the price of
    ``width / chunk`` more rows. Rows with a NULL ``ts`` are dropped; NULL values add nothing.
    """
    micros = lambda d: d // dt.timedelta(microseconds=1)
    w, c = micros(width), micros(chunk or 8 * width)
    zone_free = F.col(ts).cast("timestamp_ntz").cast("timestamp") if df.schema[ts].dataType.typeName() != "timestamp" else F.col(ts)
    rows = df.filter(F.col(ts).isNotNull()).withColumn("__t", F.unix_micros(zone_free))
    own = F.expr(f"CAST(floor(__t / {c}BD) AS BIGINT)")
    rows = rows.withColumn("__own", own).withColumn("__chunk", F.explode(F.sequence(F.col("__own"), F.expr(f"CAST(floor((__t + {w - 1}) / {c}BD) AS BIGINT)"))))
    frame = Window.partitionBy(key, "__chunk").orderBy("__t").rangeBetween(-(w - 1), Window.currentRow)
    return rows.withColumn(out, F.sum(value).over(frame)).filter("__chunk = __own").drop("__t", "__own", "__chunk")


def node_utilization(samples: DataFrame, key: str = "cluster_id", ts: str = "ts", value: str = "cpu",
                     every: str = "1 hour") -> DataFrame:
    """AG-14: per key and hour: ``hour_start, avg_cpu, max_cpu, p95_cpu, samples``.

    Average, maximum and count are algebraic aggregates (partial aggregation before
    the shuffle). The exact 95th percentile uses the distributed rank computation
    of ``functions.quantiles``, so even a (key, hour) group that holds a large share
    of all samples is split across tasks rather than buffered in one.
    """
    from meterlake.functions import quantiles
    s = samples.select(key, F.window(ts, every).start.alias("hour_start"), value)
    base = s.groupBy(key, "hour_start").agg(
        F.round(F.avg(value), 6).alias("avg_cpu"), F.max(value).alias("max_cpu"),
        F.count(F.lit(1)).alias("samples"))
    p95 = quantiles.quantiles(s, value, [key, "hour_start"], (0.95,), ["p95_cpu"])
    return (base.join(p95, [key, "hour_start"], "left")
            .select(key, "hour_start", "avg_cpu", "max_cpu", F.round("p95_cpu", 6).alias("p95_cpu"), "samples"))


def top_by(df: DataFrame, col: str, n: int, tiebreak: str) -> DataFrame:
    """TK-1/TK-2: the ``n`` rows with the largest ``col`` (NULLs last), unique tiebreak ascending."""
    return df.orderBy(F.desc_nulls_last(col), F.asc(tiebreak)).limit(n)


def quadrant(df: DataFrame, cost: str, utilization: str, med_cost: float | None,
             med_util: float | None) -> DataFrame:
    """TK-3: ``<cost level>_<utilization level>`` where high means strictly above the median."""
    def lvl(c, m):
        return F.when(F.col(c) > F.lit(m), F.lit("high")).otherwise(F.lit("low"))
    return df.withColumn("quadrant", F.concat(lvl(cost, med_cost), F.lit("_"), lvl(utilization, med_util)))


def explorer(parts: dict[str, DataFrame]) -> DataFrame:
    """AG-16: one table of ``resource_type, id, name, cost, utilization, cost_per_utilization``.

    Each part must already have ``id, name, cost, utilization``.
    """
    out = None
    for typ, df in parts.items():
        p = df.select(F.lit(typ).alias("resource_type"), F.col("id").cast("bigint").alias("id"),
                      F.col("name").cast("string").alias("name"), F.col("cost").cast("double").alias("cost"),
                      F.col("utilization").cast("bigint").alias("utilization"))
        out = p if out is None else out.unionByName(p)
    return out.withColumn("cost_per_utilization", F.round(ratio("cost", "utilization"), 6))


def search(explorer_df: DataFrame, text: str | None = None, resource_type: str | None = None) -> DataFrame:
    """FIL-5: case-insensitive name substring and resource type filter over the explorer."""
    cond = F.lit(True)
    if text:
        cond = cond & F.lower(F.col("name")).contains(text.lower())
    if resource_type:
        cond = cond & (F.col("resource_type") == resource_type)
    return explorer_df.filter(cond)


def latency(log: DataFrame, value: str = "latency", key: str = "endpoint_id", ps=(0.5, 0.95, 0.99),
            exact: bool = True, accuracy: int = 10000) -> DataFrame:
    """AG-11: latency percentiles per key: ``key, p50, p95, p99`` (rounded to 6 decimals).

    ``exact=True`` uses the distributed exact quantiles (``functions.quantiles``);
    ``exact=False`` uses ``percentile_approx``, a fixed-size sketch per key (relative
    rank error about ``1 / accuracy``), for very large logs where an estimate is enough.
    """
    names = [f"p{int(round(p * 100))}" for p in ps]
    if exact:
        from meterlake.functions import quantiles
        q = quantiles.quantiles(log, value, [key], tuple(ps), names)
    else:
        arr = F.percentile_approx(F.col(value).cast("double"), list(ps), accuracy).alias("__q")
        q = log.groupBy(key).agg(arr).select(key, *[F.col("__q")[i].alias(n) for i, n in enumerate(names)])
    return q.select(key, *[F.round(n, 6).alias(n) for n in names])
