"""The query catalogue: one callable ``(spark, sf_dir) -> DataFrame`` per operator key.

Each entry wires the fixture roles (``plans.roles``) into the library operators; the
matching DuckDB SQL lives in ``plans.oracle`` under the same key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property, reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterlake import registry
from meterlake.functions import quantiles
from meterlake.functions.columns import last_days, money, ntz_lit, ratio
from meterlake.operators import align, attribution, lineage, lineage_graph, pricing, quality, rollup, search_index, tenant
from meterlake.plans import roles as R
from meterlake.session import fresh_dir, shared_dir
from meterlake.session import stored as write_once
from meterlake.sources import sync, views
from meterlake.sources.tables import Tables
from meterlake.sources.schemas import SchemaConflict
from meterlake.streaming import stream_copy
from meterlake.streaming import stream_into_sync as stream_to_log

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def tenant_scope(spark, d):
    t = Tables(spark, d)
    return tenant.tenant_scope(R.tenant_fact(t), R.workspaces(t), "workspace_id", R.WORKSPACE_FILTER)


@query
def job_cost_per_consumer(spark, d):
    t = Tables(spark, d)
    return attribution.job_cost_per_consumer(
        R.priced_daily(t), R.jobs_latest(t), R.writes(t),
        lineage.counted(R.reads(t), R.COUNTED_CONSUMERS))


# ---- consolidation (UN-*, PRJ-*) --------------------------------------------------------
@query
def union_all_catalogs(spark, d):
    return align.aligned_union(R.catalogs_orders(Tables(spark, d)))


@query
def union_missing_columns(spark, d):
    return align.aligned_union(R.catalogs_orders(Tables(spark, d), ("A", "B")))


@query
def union_type_mismatch_scalar(spark, d):
    return align.aligned_union(R.catalogs_orders(Tables(spark, d), ("A", "C")))


@query
def union_type_mismatch_struct(spark, d):
    return align.aligned_union(R.catalogs_struct(Tables(spark, d)))


@query
def union_global_primary_only(spark, d):
    t = Tables(spark, d)
    return align.consolidate({"A": t.nation, "B": t.nation, "C": t.nation}, align.GLOBAL)


@query
def union_mixed_dedup(spark, d):
    return align.consolidate(R.catalogs_mixed_events(Tables(spark, d)), align.MIXED, ["event_id"])


@query
def consolidate_all_counts(spark, d):
    merged, modes, _ = align.consolidate_all(R.catalogs_all(Tables(spark, d)), R.fixture_rule)
    counts = align.row_counts(merged)
    reg = spark.createDataFrame(list(modes.items()), "view string, regionality string")
    return counts.join(reg, "view").select("view", "regionality", "rows")


@query
def consolidate_by_registry(spark, d):
    """The registry's own rules: audit events are MIXED, workspaces GLOBAL, jobs REGIONAL."""
    merged, modes, _ = align.consolidate_all(R.catalogs_platform(Tables(spark, d)), registry.rule)
    reg = spark.createDataFrame(list(modes.items()), "view string, regionality string")
    return align.row_counts(merged).join(reg, "view").select("view", "regionality", "rows")


@query
def drift_report(spark, d):
    return align.drift_report(R.catalogs_orders(Tables(spark, d)), "tpch.orders")


# ---- pricing and cost (JN-1, WN-1, AG-1, AG-6, AG-7, WN-2, PRJ-5) -------------------------
def _counted_reads(t, window=True, days=R.WINDOW_DAYS):
    return lineage.counted(R.reads(t, window, days), R.COUNTED_CONSUMERS)


@query
def price_asof_join(spark, d):
    t = Tables(spark, d)
    p = R.priced_rows(t)
    return p.select("resource_id", "update_id", "sku", "usage_date", F.col("quantity").cast("double").alias("quantity"),
                    F.col("price").cast("double").alias("price"), money("cost").alias("cost"))


@query
def price_asof_long_history(spark, d):
    """Usage priced from a list whose SKUs have a version a month (some close early and leave a gap)."""
    t = Tables(spark, d)
    p = pricing.price_usage_asof(R.usage_rows(t), R.monthly_prices(t))
    return p.select("resource_id", "update_id", "sku", "usage_date", F.col("quantity").cast("double").alias("quantity"),
                    F.col("price").cast("double").alias("price"), money("cost").alias("cost"))


@query
def unpriced_usage(spark, d):
    """Usage that no price version covers, with a price list that ends on 2001-01-01."""
    t = Tables(spark, d)
    closed = [v for v in R.PRICE_VERSIONS if v[1] is not None]
    return pricing.unpriced(R.usage_rows(t), R.prices(t, closed)).select(
        "resource_id", "update_id", "sku", "usage_date", F.col("quantity").cast("double").alias("quantity"), "state")


@query
def price_overlaps(spark, d):
    """Price versions that run into the next one: a special price starts before the list price ends."""
    special = [*R.PRICE_VERSIONS, ("1997-06-01", "1997-09-01", "0.90")]
    return pricing.price_overlaps(R.prices(Tables(spark, d), special)).select(
        "sku", "price_start_time", "price_end_time", "next_start")


@query
def latest_dimension(spark, d):
    return R.jobs_latest(Tables(spark, d))


@query
def cost_by_job(spark, d):
    return attribution.cost_per_resource(R.priced_daily(Tables(spark, d)))


@query
def nested_field_cost(spark, d):
    t = Tables(spark, d)
    p = pricing.price_usage(R.nested_usage(t), R.prices(t))
    m = F.col("usage_metadata")
    return p.groupBy(m.getField("job_id").alias("job_id")).agg(
        money(F.sum("cost")).alias("total_cost"),
        money(F.sum(F.when(m.getField("serving_endpoint_id").isNotNull(), F.col("cost")))).alias("endpoint_cost"),
        money(F.sum(F.when(m.getField("pipeline_id").isNotNull(), F.col("cost")))).alias("pipeline_cost"))


@query
def cost_success_vs_failed(spark, d):
    return attribution.cost_by_state(R.priced_daily(Tables(spark, d)))


@query
def cost_trend_daily(spark, d):
    return attribution.cost_trend(R.priced_daily(Tables(spark, d), window=False), unit="day")


@query
def rolling_30d_cost(spark, d):
    return attribution.rolling_cost(R.priced_daily(Tables(spark, d), window=False), R.WINDOW_DAYS)


@query
def cost_efficiency_trend(spark, d):
    t = Tables(spark, d)
    return attribution.efficiency_trend(R.priced_daily(t, window=False), R.writes(t, window=False),
                                        _counted_reads(t, window=False), unit="month")


# ---- lineage (JN-5, JN-6, AG-2..4, AG-8, AG-13, REP-6) ---------------------------------------
@query
def tables_per_job(spark, d):
    return lineage.tables_per_job(R.writes(Tables(spark, d)))


@query
def consumers_per_table(spark, d):
    return lineage.consumers_per_table(_counted_reads(Tables(spark, d)))


@query
def consumer_breakdown(spark, d):
    return lineage.consumer_breakdown(_counted_reads(Tables(spark, d)), ["JOB", "NOTEBOOK", "DASHBOARD"])


@query
def consumers_rolling_30d(spark, d):
    """Distinct consumers of every table over the 30 days up to each day it was read on, from stored daily sketches."""
    sketches = write_once(lineage.daily_consumer_sketches(_counted_reads(Tables(spark, d), window=False)), "sketches")
    return lineage.consumers_rolling(sketches, R.WINDOW_DAYS)


@query
def lineage_job_table_consumer(spark, d):
    t = Tables(spark, d)
    return lineage.lineage_path(R.writes(t), _counted_reads(t))


@query
def lineage_edges(spark, d):
    t = Tables(spark, d)
    return lineage.lineage_edges(R.writes(t), _counted_reads(t))


@query
def unused_tables(spark, d):
    t = Tables(spark, d)
    return lineage.unused_tables(R.writes(t), _counted_reads(t))


@query
def table_freshness(spark, d):
    return lineage.table_freshness(R.writes(Tables(spark, d), window=False), R.LINE_AS_OF)


@query
def table_refresh_stats(spark, d):
    return lineage.refresh_stats(R.writes(Tables(spark, d), window=False))


@query
def lineage_downstream(spark, d):
    """Everything that data of the jobs with failed runs in the window has gone to, over a year's lineage."""
    t = Tables(spark, d)
    failed = R.usage_rows(t, True).filter(F.col("state") == "FAILED").select(lineage_graph.node("job", "resource_id").alias("node"))
    return lineage_graph.walk(R.data_flow(t), failed)


@query
def lineage_upstream(spark, d):
    """What each of the ten tables dearest per read was made from, over a year's lineage."""
    t = Tables(spark, d)
    return lineage_graph.walk(R.data_flow(t), _dearest_tables(t), upstream=True, by_start=True)


@query
def lineage_related(spark, d):
    """Resources up to three hops from the ten tables dearest per read, in both directions."""
    t = Tables(spark, d)
    return lineage_graph.related(R.data_flow(t), _dearest_tables(t), max_hops=3)


@query
def lineage_impact(spark, d):
    """How many jobs, tables and consumers lie how many hops below the jobs with failed runs."""
    return lineage_graph.impact(lineage_downstream(spark, d))


def _dearest_tables(t):
    top = attribution.top_by(Facts(t).table_cost_per_read, "cost_per_read", 10, "table_id")
    return write_once(top.select(lineage_graph.node("table", "table_id").alias("node")), "starts")


# ---- table, endpoint and pipeline attribution (AG-9, REP-2..5, WN-4, AG-12) -----------------
class Facts:
    """The windowed inputs shared by the attribution reports, each built once.

    Reports composed from several parts (the explorer) reuse the same DataFrame
    objects, so the driver builds each sub-plan once and identical shuffles are
    planned once and reused.
    """

    def __init__(self, t: Tables, days: int = R.WINDOW_DAYS, stored: bool = False):
        self.t, self.days = t, days
        if stored:
            # the reports read these three to seven times: each is reduced to the grain that the reports
            # share and written once to the shared folder, all at the same time
            with ThreadPoolExecutor(3) as pool:
                reads = pool.submit(write_once, lineage.consumers_per_table(self.reads), "reads")
                writes = pool.submit(write_once, lineage.produced(self.writes), "writes")
                self.priced = write_once(self.priced.groupBy("resource_id", "family").agg(F.sum("cost").alias("cost")), "priced")
                self.reads, self.writes = reads.result(), writes.result()
            # usage and writes are the same lines here: a pipeline's outputs are its pairs
            pairs = R.with_family(self.t, self.writes.select(F.col("job_id").alias("resource_id"), F.col("table_id").alias("sku")))
            self.pipeline_outputs = R.pipeline_outputs(pairs)

    @cached_property
    def priced(self):
        return R.priced_daily(self.t, True, self.days)

    @cached_property
    def writes(self):
        return R.writes(self.t, True, self.days)

    @cached_property
    def reads(self):
        return _counted_reads(self.t, True, self.days)

    @cached_property
    def table_cost(self):
        return attribution.table_cost(self.priced, self.writes)

    @cached_property
    def table_cost_per_read(self):
        return attribution.table_cost_per_read(self.table_cost, self.reads)

    @cached_property
    def endpoint_report(self):
        log = last_days(R.query_log(self.t), "start_time", R.EVENT_AS_OF, self.days)
        return attribution.endpoint_cost_per_query(R.endpoint_usage(self.priced), log)

    @cached_property
    def pipeline_outputs(self):
        # listed from usage without prices, so the price join does not run for it again
        return R.pipeline_outputs(R.with_family(self.t, R.usage_rows(self.t, True, self.days)))

    @cached_property
    def pipeline_roi(self):
        return attribution.pipeline_roi(R.pipeline_usage(self.priced), self.pipeline_outputs, self.reads)

    @cached_property
    def job_report(self):
        return attribution.job_cost_per_consumer(self.priced, R.jobs_latest(self.t), self.writes, self.reads)


class Rollups:
    """Daily partials of what the explorer adds up: cost per resource and SKU family, reads per table, lines per job and table."""

    def __init__(self, root: str):
        self.root = root

    def refresh(self, t: Tables, days) -> None:
        """Bring the rollups up to date for ``days`` of the usage lines in ``t``; the three are written at the same time."""
        priced = pricing.price_usage(R.usage_rows(t), R.prices(t), keep=("family",))
        one = F.count(F.lit(1))
        parts = [(priced, "usage_date", ["resource_id", "family"], {"cost": F.sum("cost")}, "cost"),
                 (_counted_reads(t, window=False), "read_date", ["table_id"], {"consumers": one}, "reads"),
                 (R.writes(t, window=False), "write_date", ["job_id", "table_id"], {"lines": one}, "writes")]
        with ThreadPoolExecutor(3) as pool:
            list(pool.map(lambda p: rollup.refresh(*p[:4], f"{self.root}/{p[4]}", days), parts))

    def window(self, t: Tables, days: int) -> list[DataFrame]:
        """The rollups' rows of the last ``days`` days, each of the three read once and written, all at the same time."""
        with ThreadPoolExecutor(3) as pool:
            return list(pool.map(lambda part: write_once(rollup.read(t.spark, f"{self.root}/{part}", R.LINE_AS_OF, days), part), ("cost", "reads", "writes")))

    def facts(self, t: Tables, days: int, window: list[DataFrame]) -> Facts:
        """Facts over the last ``days`` days of ``window``, which holds as many days at least."""
        f = Facts(t, days)
        f.priced, f.reads, f.writes = (rollup.within(rows, R.LINE_AS_OF, days) for rows in window)
        f.pipeline_outputs = R.pipeline_outputs(R.with_family(t, f.writes.select(F.col("job_id").alias("resource_id"), F.col("table_id").alias("sku"))))
        return f


def _facts(spark, d, days=R.WINDOW_DAYS) -> Facts:
    return Facts(Tables(spark, d), days)


@query
def table_cost(spark, d):
    return _facts(spark, d).table_cost


@query
def table_cost_per_read(spark, d):
    return _facts(spark, d).table_cost_per_read


@query
def unused_tables_with_cost(spark, d):
    f = _facts(spark, d)
    return lineage.unused_tables(f.writes, f.reads).join(f.table_cost, "table_id")


@query
def endpoint_cost_per_query(spark, d):
    return _facts(spark, d).endpoint_report


@query
def pipeline_roi(spark, d):
    return _facts(spark, d).pipeline_roi


@query
def pipeline_cost_by_table(spark, d):
    f = _facts(spark, d)
    cost = R.pipeline_usage(f.priced).groupBy(F.col("resource_id").alias("pipeline_id")).agg(
        money(F.sum("cost")).alias("cost"))
    shares = attribution.allocate(cost, f.pipeline_outputs, "pipeline_id", "table_id")
    return shares.withColumn("cost_share", F.round("cost_share", 6))


@query
def cost_per_run(spark, d):
    t = Tables(spark, d)
    return attribution.cost_per_run(R.pipeline_usage(R.priced_daily(t)), R.pipeline_usage(R.with_family(t, R.usage_rows(t, True))))


# ---- query patterns, percentiles, utilization (AG-10, AG-11, AG-14, AG-15) ------------------
@query
def query_pattern_by_hour(spark, d):
    return attribution.by_hour(R.query_log(Tables(spark, d)))


@query
def peak_hour(spark, d):
    return attribution.peak_hour(R.query_log(Tables(spark, d)))


@query
def latency_percentiles(spark, d):
    return attribution.latency(R.query_log(Tables(spark, d)))


@query
def latency_ranks(spark, d):
    """Rank of every latency within its endpoint by the sample sort, whatever the size of the log."""
    log = R.query_log(Tables(spark, d))
    r = quantiles.value_ranks(log, "latency", ["endpoint_id"], partitions=16)
    return r.select("endpoint_id", "latency", "cnt", "below", "n")


@query
def node_utilization_hourly(spark, d):
    return attribution.node_utilization(R.node_timeline(Tables(spark, d)))


@query
def rolling_24h_load(spark, d):
    """Load of every cluster over the 24 hours up to each hour it was sampled in, in chunks of a week."""
    samples = R.node_timeline(Tables(spark, d))
    hours = samples.groupBy("cluster_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")).agg(F.sum(F.col("cpu").cast("decimal(18,6)")).alias("load"))
    rolled = attribution.rolling_sum(hours, "cluster_id", "hour", "load", dt.timedelta(hours=24), "load_24h", dt.timedelta(days=7))
    return rolled.select("cluster_id", "hour", F.col("load").cast("double").alias("load"), F.col("load_24h").cast("double").alias("load_24h"))


@query
def efficiency_score(spark, d):
    # ranking reads the report several times: it is computed once
    e = write_once(_facts(spark, d).endpoint_report.select(
        "endpoint_id", ratio("query_count", "total_cost").alias("per_cost_unit")), "endpoints")
    s = quantiles.with_percent_rank(e, "per_cost_unit", "score")
    return s.select("endpoint_id", F.round("per_cost_unit", 6).alias("per_cost_unit"), F.round("score", 6).alias("score"))


# ---- ranking, quadrants, explorer (TK-2, TK-3, AG-16, FIL-5) ---------------------------------
@query
def top10_cost_per_read(spark, d):
    return attribution.top_by(_facts(spark, d).table_cost_per_read, "cost_per_read", 10, "table_id")


@query
def cost_utilization_quadrant(spark, d):
    shared_dir(spark)  # checkpoint() writes to the cluster's shared folder
    # three passes (two medians, then the labelling) read one materialized result
    tc = _facts(spark, d).table_cost_per_read.select("table_id", "cost", "reads").checkpoint()
    mc = quantiles.exact_quantile(tc, "cost", 0.5)
    mr = quantiles.exact_quantile(tc, "reads", 0.5)
    return attribution.quadrant(tc, "cost", "reads", mc, mr)


def explorer_for(t, days=R.WINDOW_DAYS, only=None, f=None):
    """AG-16 over the last ``days`` days (the explorer's 7 / 30 / 90 day selector).

    ``only``: the one resource type asked for; the other reports are not built. ``f``: the facts, where
    they are not to be read from the tables (``Rollups``).
    """
    f = f or Facts(t, days, stored=True)

    def named(prefix, col):
        return F.concat(F.lit(prefix), F.col(col).cast("string")).alias("name")
    parts = {
        "JOB": lambda: f.job_report.select(F.col("job_id").alias("id"), "name", F.col("total_cost").alias("cost"),
                                   F.col("consumers").alias("utilization")),
        "TABLE": lambda: f.table_cost_per_read.select(F.col("table_id").alias("id"), named("table_", "table_id"),
                                              "cost", F.col("reads").alias("utilization")),
        "ENDPOINT": lambda: f.endpoint_report.select(F.col("endpoint_id").alias("id"), named("endpoint_", "endpoint_id"),
                                             F.col("total_cost").alias("cost"),
                                             F.col("query_count").alias("utilization")),
        "PIPELINE": lambda: f.pipeline_roi.select(F.col("pipeline_id").alias("id"), named("pipeline_", "pipeline_id"),
                                          "cost", F.col("consumers").alias("utilization")),
    }
    return attribution.explorer({typ: make() for typ, make in parts.items() if only in (None, typ)})


@query
def resource_explorer(spark, d):
    return explorer_for(Tables(spark, d))


@query
def explorer_search(spark, d):
    return attribution.search(explorer_for(Tables(spark, d)), text="7")


@query
def explorer_search_by_type(spark, d):
    return attribution.search(explorer_for(Tables(spark, d), only="TABLE"), text="1", resource_type="TABLE")


@query
def explorer_search_indexed(spark, d):
    """Searches of the explorer's resources by their gram index: short, long, common, odd and absent needles."""
    path, keys = fresh_dir(spark, "search"), ["resource_type", "id"]
    search_index.build(explorer_for(Tables(spark, d)), keys, path)
    return reduce(lambda a, b: a.unionByName(b), [
        search_index.search(spark, path, text, keys).withColumn("needle", F.lit(text)) for text in R.NEEDLES])


@query
def explorer_7d(spark, d):
    return explorer_for(Tables(spark, d), 7)


@query
def explorer_90d(spark, d):
    return explorer_for(Tables(spark, d), 90)


@query
def explorer_from_rollup(spark, d):
    """The explorer over 7, 30 and 90 days from daily rollups that were kept up through four batches of usage: most of
    the lines, the failed ones of the same days later, the newest days, and a day that is loaded again."""
    t = Tables(spark, d)
    target, log = _sync_dirs(spark, "rollup")
    rollups = Rollups(fresh_dir(spark, "rollup-days"))
    late, new = F.col("l_returnflag") == "R", F.col("l_shipdate") >= ntz_lit(dt.datetime(2001, 10, 20))
    for epoch, batch in enumerate((t.lineitem.filter(~late & ~new), t.lineitem.filter(late & ~new), t.lineitem.filter(new))):
        sync.append_epoch(spark, batch, "tpch", "lineitem", target, log, "usage", epoch)
        now = Tables(spark, d)
        now._frames["lineitem"] = sync.read_target(spark, target, log)
        rollups.refresh(now, rollup.days_of(batch, "l_shipdate"))
    rollups.refresh(now, [dt.date(2001, 10, 20)])
    spans = (7, R.WINDOW_DAYS, 90)
    window = rollups.window(now, max(spans))  # the reports read it many times, the rollups' folders are read once
    parts = [explorer_for(now, days, f=rollups.facts(now, days, window)).withColumn("days", F.lit(days)) for days in spans]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query
def published_views(spark, d):
    """Row counts read back through the published views of the consolidated tables."""
    published = {n: df for n, df in align.consolidate_all(R.catalogs_all(Tables(spark, d)), R.fixture_rule)[0].items()}
    names = views.publish_all(published)
    return reduce(lambda a, b: a.unionByName(b), [
        spark.table(n).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("view_name"), "rows") for n in names])


# ---- key checks (DQ-1..4) ------------------------------------------------------------------
@query
def pk_duplicates(spark, d):
    return quality.pk_duplicates(Tables(spark, d).lineitem, ["l_orderkey", "l_linenumber"])


@query
def pk_nulls(spark, d):
    t = Tables(spark, d)
    parts = [quality.pk_nulls(t[name], list(decl.primary_key)).select(F.lit(name).alias("table_name"), "rows", "nulls")
             for name, decl in R.fixture_keys().items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query
def fk_orphans(spark, d):
    t = Tables(spark, d)
    parent = t.customer.filter(F.col("c_mktsegment") != "BUILDING")
    return quality.fk_orphans(t.orders, "o_custkey", parent, "c_custkey")


@query
def key_report(spark, d):
    t = Tables(spark, d)
    decls = R.fixture_keys()
    names = set(decls) | {p for k in decls.values() for _, p, _ in k.foreign_keys}
    return quality.key_report({n: t[n] for n in names}, decls)


@query
def key_report_nested(spark, d):
    """Dotted keys in both directions, and a history table whose key comes from the registry."""
    t = Tables(spark, d)
    nested = t.events.select(F.struct("event_id", "user_id").alias("meta"))
    prices = R.prices(t).withColumnRenamed("sku", "sku_name")
    decls = registry.key_decls(["billing.list_prices"]) | {
        "nested_events": quality.KeyDecl(("meta.event_id",), (("meta.user_id", "nested_events", "meta.user_id"),))}
    return quality.key_report({"billing.list_prices": prices, "nested_events": nested}, decls)


# ---- tenant views over many tables (TEN-3, AG-17, AG-18) -----------------------------------
@query
def tenant_scope_all(spark, d):
    t = Tables(spark, d)
    scoped, skipped = tenant.tenant_scope_all(R.tenant_facts(t), R.workspaces(t), "workspace_id",
                                             R.WORKSPACE_FILTER, probe=True)
    return tenant.scope_report(scoped, skipped)


@query
def tenant_fanout(spark, d):
    """Orders as each of fifty tenants sees them, in one pass over the orders."""
    t = Tables(spark, d)
    return tenant.tenant_fanout(R.tenant_fact(t), R.workspaces(t), "workspace_id", R.TENANTS)


@query
def view_row_counts(spark, d):
    merged, _, _ = align.consolidate_all(R.catalogs_all(Tables(spark, d)), R.fixture_rule, discover="all")
    return align.row_counts(merged)


# ---- sync (SNK-*), compaction and the streaming copy (ST-1) ---------------------------------
def _sync_dirs(spark, name):
    root = fresh_dir(spark, name)
    return f"{root}/target", f"{root}/log"


@query
def sync_full(spark, d):
    t = Tables(spark, d)
    target, log = _sync_dirs(spark, "sync-full")
    sync.sync_table(spark, t.events, "tpch", "events", target, log, ts_override="ts")
    return sync.read_target(spark, target, log)


@query
def sync_full_fallback(spark, d):
    t = Tables(spark, d)
    target, log = _sync_dirs(spark, "sync-fallback")
    sync.sync_table(spark, t.nation, "tpch", "nation", target, log)              # FULL (no state)
    r = sync.sync_table(spark, t.nation, "tpch", "nation", target, log)          # FULL_FALLBACK
    assert r.mode == sync.FULL_FALLBACK, r.mode
    return sync.read_target(spark, target, log)


@query
def sync_incremental(spark, d):
    t = Tables(spark, d)
    target, log = _sync_dirs(spark, "sync-incr")
    sync.sync_table(spark, R.events_at_first_sync(t), "tpch", "events", target, log, ts_override="ts")
    r = sync.sync_table(spark, t.events, "tpch", "events", target, log, ts_override="ts")
    assert r.mode == sync.INCREMENTAL, r.mode
    # replay of the same batch (e.g. the log write was lost): replaces, never duplicates
    sync.copy_incremental(t.events, target, "ts", r.lo, r.hi)
    return sync.read_target(spark, target, log)


@query
def sync_incremental_schema_growth(spark, d):
    t = Tables(spark, d)
    target, log = _sync_dirs(spark, "sync-growth")
    sync.sync_table(spark, R.events_at_first_sync(t).drop("props"), "tpch", "events", target, log, ts_override="ts")
    sync.sync_table(spark, t.events, "tpch", "events", target, log, ts_override="ts")
    return sync.read_target(spark, target, log)


def _three_runs(spark, d, name):
    t = Tables(spark, d)
    root = fresh_dir(spark, name)
    log = f"{root}/log"
    runs = []
    for run, (ev, force) in enumerate([(R.events_at_first_sync(t), False), (t.events, False), (t.events, True)], 1):
        for table, src, ov in (("events", ev, "ts"), ("nation", t.nation, None)):
            r = sync.sync_table(spark, src, "tpch", table, f"{root}/{table}", log, force=force, ts_override=ov)
            runs.append((run, table, r.mode, r.rows))
    return log, runs


@query
def sync_modes(spark, d):
    _, runs = _three_runs(spark, d, "sync-modes")
    return spark.createDataFrame(runs, "run bigint, table_name string, mode string, rows bigint")


@query
def sync_state_upsert(spark, d):
    t = Tables(spark, d)
    root = fresh_dir(spark, "sync-state")
    log = f"{root}/log"
    for i, ev in enumerate((R.events_at_first_sync(t), t.events)):
        sync.sync_table(spark, ev, "tpch", "events", f"{root}/events", log, ts_override="ts")
        sync.sync_table(spark, t.nation, "tpch", "nation", f"{root}/nation", log)
        if i == 0:
            sync.snapshot_state(spark, log)  # later lookups: snapshot + commits since
    return sync.sync_state(spark, log).drop("updated_at")


def _sync_all_twice(spark, d, name):
    t = Tables(spark, d)
    root = fresh_dir(spark, name)
    log = f"{root}/log"
    first = sync.sync_all(spark, R.sync_sources(t, True), f"{root}/data", log, ts_overrides=R.SYNC_OVERRIDES)
    second = sync.sync_all(spark, R.sync_sources(t, False), f"{root}/data", log, ts_overrides=R.SYNC_OVERRIDES,
                           parallelism=2)
    return root, log, first, second


@query
def sync_all_tables(spark, d):
    root, log, _, second = _sync_all_twice(spark, d, "sync-all")
    parts = [sync.read_target(spark, f"{root}/data/{r.table.replace('.', '/')}", log)
             .agg(F.count(F.lit(1)).alias("target_rows"))
             .select(F.lit(r.table).alias("table_name"), F.lit(r.mode).alias("last_mode"),
                     F.lit(r.rows).cast("bigint").alias("rows_loaded"), "target_rows")
             for r in second]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query
def sync_summary(spark, d):
    _, log, _, _ = _sync_all_twice(spark, d, "sync-summary")
    lg = sync.read_log(spark, log)
    # one log row per table and run: number each table's loads in commit order
    per_table = Window.partitionBy("schema_name", "table_name").orderBy("seq")
    runs = lg.withColumn("run", F.row_number().over(per_table).cast("bigint"))
    return sync.sync_summary(runs, "run")


@query
def compact_files(spark, d):
    t = Tables(spark, d)
    target, log = _sync_dirs(spark, "compact")
    marks = [dt.datetime(2024, 1, day) for day in (4, 8, 12, 16, 20, 24, 28)]
    for mark in marks:  # a target of many batches
        sync.sync_table(spark, t.events.filter(F.col("ts") < ntz_lit(mark)), "tpch", "events", target, log, ts_override="ts")
    sync.sync_table(spark, t.events, "tpch", "events", target, log, ts_override="ts")
    assert sync.compact_target(spark, target, log) > 0
    return sync.read_target(spark, target, log)


@query
def sync_full_after_failure(spark, d):
    """A forced full load that fails half-way leaves the target as it was; the next run completes it."""
    t = Tables(spark, d)
    target, log = _sync_dirs(spark, "sync-failed")
    sync.sync_table(spark, R.events_at_first_sync(t), "tpch", "events", target, log, ts_override="ts")
    last = F.col("ts") > ntz_lit(R.SYNC_FIRST_MARK)
    broken = t.events.withColumn("value", F.when(last, F.raise_error(F.lit("source broke off")).cast("double")).otherwise(F.col("value")))
    try:
        sync.sync_table(spark, broken, "tpch", "events", target, log, force=True, ts_override="ts")
    except PySparkException:
        pass
    r = sync.sync_table(spark, t.events, "tpch", "events", target, log, ts_override="ts")
    assert r.mode == sync.INCREMENTAL, r.mode
    return sync.read_target(spark, target, log)


@query
def sync_uncommitted_hidden(spark, d):
    """Folders without a log row of their own table are invisible, whatever other tables have committed."""
    t = Tables(spark, d)
    root = fresh_dir(spark, "sync-hidden")
    log = f"{root}/log"
    sync.sync_table(spark, t.nation, "tpch", "nation", f"{root}/nation", log)
    sync.sync_table(spark, R.events_at_first_sync(t), "tpch", "events", f"{root}/events", log, ts_override="ts")
    sync.copy_full(t.events, f"{root}/events", "ts")
    sync.copy_incremental(t.events, f"{root}/events", "ts", R.SYNC_FIRST_MARK)
    sync.copy_full(t.nation, f"{root}/nation")
    return sync.read_target(spark, f"{root}/events", log)


@query
def sync_late_rows(spark, d):
    """Rows that arrive late, in a run that brings nothing else, are copied once and the mark stays."""
    t = Tables(spark, d)
    target, log = _sync_dirs(spark, "sync-late")
    first = R.events_at_first_sync(t)
    late = F.col("event_type") == "view"
    runs = [first.filter(~late), first.filter(late), first, t.events]
    for source in runs:
        sync.sync_table(spark, source, "tpch", "events", target, log, ts_override="ts", lookback=dt.timedelta(days=40), key=["event_id"])
    return sync.read_target(spark, target, log)


@query
def sync_null_marks(spark, d):
    """A sync column without any value: later runs copy nothing twice."""
    t = Tables(spark, d)
    target, log = _sync_dirs(spark, "sync-null")
    unmarked = t.events.withColumn("ts", F.lit(None).cast("timestamp_ntz"))
    for source in (unmarked, unmarked, unmarked):
        sync.sync_table(spark, source, "tpch", "events", target, log, ts_override="ts")
    return sync.read_target(spark, target, log)


@query
def sync_type_change(spark, d):
    """A column that widens from int to bigint is read as bigint throughout; a batch that has it as text is
    refused before it writes, and the run after that completes the target."""
    t = Tables(spark, d)
    target, log = _sync_dirs(spark, "sync-types")
    narrow = R.events_at_first_sync(t).withColumn("user_id", F.col("user_id").cast("int"))
    sync.sync_table(spark, narrow, "tpch", "events", target, log, ts_override="ts")
    sync.sync_table(spark, t.events.filter(F.col("ts") < ntz_lit(dt.datetime(2024, 1, 22))), "tpch", "events", target, log, ts_override="ts")
    try:
        sync.sync_table(spark, t.events.withColumn("user_id", F.col("user_id").cast("string")), "tpch", "events", target, log, ts_override="ts")
    except SchemaConflict:
        pass
    sync.sync_table(spark, t.events, "tpch", "events", target, log, ts_override="ts")
    return sync.read_target(spark, target, log)


@query
def snapshot_twice(spark, d):
    """A snapshot of a log without new commits is the one that is there; state is read from it and what came after."""
    t = Tables(spark, d)
    target, log = _sync_dirs(spark, "sync-snapshots")
    sync.sync_table(spark, R.events_at_first_sync(t), "tpch", "events", target, log, ts_override="ts")
    first, again = sync.snapshot_state(spark, log), sync.snapshot_state(spark, log)
    assert first == again
    sync.sync_table(spark, t.events, "tpch", "events", target, log, ts_override="ts")
    assert sync.snapshot_state(spark, log) > first
    return sync.sync_state(spark, log).drop("updated_at")


@query
def date_target_many_runs(spark, d):
    """Orders synced by their day in eight runs, each of which reloads the last day it had: folders are merged on the way."""
    t = Tables(spark, d)
    target, log = _sync_dirs(spark, "sync-days")
    orders = t.orders.withColumn("usage_date", F.col("o_orderdate").cast("date"))
    for year in [*range(1994, 2001), None]:
        upto = orders if year is None else orders.filter(F.col("o_orderdate") < ntz_lit(dt.datetime(year, 6, 15, 12)))
        sync.sync_table(spark, upto, "tpch", "orders", target, log, max_folders=3)
    return sync.read_target(spark, target, log)


@query
def stream_into_sync(spark, d):
    """Events that arrive as files, some of them twice, in a stream that commits to the sync log; a batch sync adds the rest."""
    t = Tables(spark, d)
    target, log = _sync_dirs(spark, "stream-sync")
    root = fresh_dir(spark, "stream-in")
    landing, checkpoint = f"{root}/landing", f"{root}/checkpoint"
    first, middle = R.events_at_first_sync(t), ntz_lit(dt.datetime(2024, 1, 22))
    again = t.events.filter(((F.col("ts") > ntz_lit(R.SYNC_FIRST_MARK)) & (F.col("ts") < middle)) | (F.col("event_type") == "view") & (F.col("ts") < middle))
    for arrived in (first, again):
        arrived.withColumn("ts", F.col("ts").cast("timestamp")).write.mode("append").parquet(landing)
        source = spark.readStream.schema(t.events.schema.simpleString()[7:-1].replace("timestamp_ntz", "timestamp").replace(":", " ")).parquet(landing)
        stream_to_log(spark, source, "tpch", "events", target, log, checkpoint, "ts", ["event_id"], "60 days")
    sync.sync_table(spark, t.events.withColumn("ts", F.col("ts").cast("timestamp")), "tpch", "events", target, log, ts_override="ts")
    return sync.read_target(spark, target, log).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query
def stream_copy_available_now(spark, d):
    t = Tables(spark, d)
    root = fresh_dir(spark, "stream")
    landing, out, ckpt = f"{root}/landing", f"{root}/out", f"{root}/checkpoint"
    R.events_at_first_sync(t).write.mode("append").parquet(landing)
    schema = t.events.schema
    stream_copy(spark, landing, schema, out, ckpt)
    stream_copy(spark, landing, schema, out, ckpt)            # nothing new: copies nothing
    t.events.filter(F.col("ts") > ntz_lit(R.SYNC_FIRST_MARK)).write.mode("append").parquet(landing)  # new files
    stream_copy(spark, landing, schema, out, ckpt)
    return spark.read.parquet(out)
