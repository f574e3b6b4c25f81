"""How the driver's tables play the roles the analytics expect.

The test tables are TPC-H-like; the analytics speak of usage, prices, jobs, lineage
and query logs. Every role below is a lazy projection of the given tables, so its
work grows with them. The role constants are fixed values of the test setup.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.functions.columns import QTY, last_days, ntz_lit
from meterlake.operators import lineage, lineage_graph, pricing
from meterlake.operators.quality import KeyDecl
from meterlake.sources.tables import Tables

# ---- fixed values of the test roles -------------------------------------------------
LINE_AS_OF = dt.date(2001, 11, 4)        # report date for lineitem-based roles
EVENT_AS_OF = dt.date(2024, 1, 31)       # report date for events-based roles
WINDOW_DAYS = 30                         # the 30-day analysis window
LINEAGE_DAYS = 365                       # span of the lineage graph that is walked
WORKSPACE_FILTER = "workspace_name RLIKE '^(BUILD|MACH).*'"
# price list versions: (start, end (None = open), factor on p_retailprice)
PRICE_VERSIONS = [
    ("1990-01-01", "1998-01-01", "1.00"),
    ("1998-01-01", "2001-01-01", "1.10"),
    ("2001-01-01", None, "1.25"),
]
# job definition history: (suffix added to s_name, change time)
JOB_VERSIONS = [("_old", "1996-01-01"), ("", "2000-01-01")]
# consumer type by o_orderpriority; any other priority is OTHER (not a counted consumer)
CONSUMER_TYPE = {"1-URGENT": "JOB", "2-HIGH": "NOTEBOOK", "3-MEDIUM": "DASHBOARD"}
COUNTED_CONSUMERS = ["NOTEBOOK", "JOB", "DASHBOARD"]
ENDPOINT_FAMILY_LIKE = "%ECON%"          # usage rows that belong to serving endpoints
PIPELINE_FAMILY = "PROMO"                # usage rows that belong to pipelines
SYNC_FIRST_MARK = dt.datetime(2024, 1, 15, 23, 59, 59, 999999)  # first load: ts <= 2024-01-15
# ---------------------------------------------------------------------------------------


def workspaces(t: Tables) -> DataFrame:
    """Workspace dimension: ``workspace_id, workspace_name``."""
    return t.customer.select(F.col("c_custkey").alias("workspace_id"),
                             F.col("c_mktsegment").alias("workspace_name"))


# texts searched for in the explorer's names
NEEDLES = ["7", "_1", "E_1", "table_1", "SUPPLIER#0", "endpoint_42", "99", "no such name"]
# fifty overlapping tenants: one per market segment, the others by workspace number
TENANTS = {f"segment_{n.lower()}": f"workspace_name RLIKE '^{n}'" for n in ("AUTO", "BUILD", "FURN", "HOUSE", "MACH")} \
    | {f"group_{k}": f"workspace_id % 45 = {k}" for k in range(45)}


def tenant_fact(t: Tables) -> DataFrame:
    """Orders carrying the tenant key ``workspace_id``."""
    return t.orders.withColumn("workspace_id", F.col("o_custkey"))


def _lines(t: Tables, window: bool, days: int = WINDOW_DAYS) -> DataFrame:
    li = t.lineitem
    return last_days(li, "l_shipdate", LINE_AS_OF, days) if window else li


def _state() -> F.Column:
    return F.when(F.col("l_returnflag") == "R", F.lit("FAILED")).otherwise(F.lit("SUCCESS"))


def usage_rows(t: Tables, window: bool = False, days: int = WINDOW_DAYS) -> DataFrame:
    """Row-level usage: one row per line item."""
    return _lines(t, window, days).select(
        F.col("l_suppkey").alias("resource_id"), F.col("l_orderkey").alias("update_id"),
        F.col("l_partkey").alias("sku"), F.col("l_quantity").cast(QTY).alias("quantity"),
        F.col("l_shipdate").cast("date").alias("usage_date"), _state().alias("state"))


def with_family(t: Tables, usage: DataFrame) -> DataFrame:
    """Usage with its SKU family, for reports that need no price."""
    return usage.join(t.part.select(F.col("p_partkey").alias("sku"), F.col("p_type").alias("family")), "sku")


def usage_daily(t: Tables, window: bool = False, days: int = WINDOW_DAYS) -> DataFrame:
    """Usage pre-aggregated to ``(resource_id, sku, usage_date, state)`` before pricing.

    Quantities are exact decimals, so ``sum(q) * price == sum(q * price)``; the
    aggregate runs map-side first and shrinks the input of the price join
    from one row per event to one row per resource, SKU and day.
    """
    return _lines(t, window, days).groupBy(
        F.col("l_suppkey").alias("resource_id"), F.col("l_partkey").alias("sku"),
        F.col("l_shipdate").cast("date").alias("usage_date"), _state().alias("state"),
    ).agg(F.sum(F.col("l_quantity").cast(QTY)).alias("quantity"))


def prices(t: Tables, versions=None) -> DataFrame:
    """List prices with validity history: ``sku, family, price_start_time, price_end_time, price``.

    The family comes from the same table, so usage joins by SKU once for both.
    """
    return pricing.price_versions(t.part, "p_partkey", "p_retailprice", versions or PRICE_VERSIONS, {"family": "p_type"})


MONTHLY_FROM, MONTHS = "1992-01-01", 120  # the long price history: a version a month
MONTHLY_GAP = 11                          # versions of every such month close after 15 days


def monthly_prices(t: Tables) -> DataFrame:
    """List prices with a version a month: ``price = round(base * (100 + 7 * month % 40) / 100, 2)``, as in ``prices``."""
    m = F.col("m")
    start = F.add_months(F.lit(MONTHLY_FROM).cast("date"), m)
    end = F.when(m % 12 == MONTHLY_GAP, F.date_add(start, 15)).when(m < MONTHS - 1, F.add_months(F.lit(MONTHLY_FROM).cast("date"), m + 1))
    factor = ((F.lit(100) + (m * 7) % 40).cast("decimal(5,2)") / F.lit(100).cast("decimal(5,2)")).cast("decimal(5,2)")
    listed = t.part.select(F.col("p_partkey").alias("sku"), F.col("p_retailprice").cast("decimal(12,2)").alias("base"))
    # dealt before each row becomes MONTHS rows, however few files or row groups the parts come in
    listed = listed.repartition(int(t.spark.conf.get("spark.sql.shuffle.partitions")), "sku")
    every = listed.select("sku", "base", F.explode(F.sequence(F.lit(0), F.lit(MONTHS - 1))).alias("m"))
    return every.select("sku", start.cast("timestamp_ntz").alias("price_start_time"), end.cast("timestamp_ntz").alias("price_end_time"),
                        F.round(F.col("base") * factor, 2).cast("decimal(12,2)").alias("price"))


def priced_rows(t: Tables, window: bool = False, days: int = WINDOW_DAYS) -> DataFrame:
    """Row-level usage with its valid price, family and exact ``cost``."""
    return pricing.price_usage(usage_rows(t, window, days), prices(t), keep=("family",))


def priced_daily(t: Tables, window: bool = True, days: int = WINDOW_DAYS) -> DataFrame:
    """Daily usage with its valid price and exact decimal ``cost``."""
    return pricing.price_usage(usage_daily(t, window, days), prices(t), keep=("family",))


def jobs_history(t: Tables) -> DataFrame:
    """Job definitions with history: ``job_id, name, change_time``."""
    arr = F.array(*[F.struct(F.lit(sfx).alias("sfx"), ntz_lit(ts).alias("ts")) for sfx, ts in JOB_VERSIONS])
    return (t.supplier.select("s_suppkey", "s_name", F.explode(arr).alias("v"))
            .select(F.col("s_suppkey").alias("job_id"),
                    F.concat(F.col("s_name"), F.col("v.sfx")).alias("name"),
                    F.col("v.ts").alias("change_time")))


def jobs_latest(t: Tables) -> DataFrame:
    return pricing.latest(jobs_history(t), "job_id", ["change_time"])


def writes(t: Tables, window: bool = True, days: int = WINDOW_DAYS) -> DataFrame:
    """Lineage writes: job ``job_id`` wrote table ``table_id`` on ``write_date``."""
    return _lines(t, window, days).select(F.col("l_suppkey").alias("job_id"), F.col("l_partkey").alias("table_id"),
                                    F.col("l_shipdate").cast("date").alias("write_date"))


def _consumer_type() -> F.Column:
    c = F.lit("OTHER")
    for prio, typ in reversed(list(CONSUMER_TYPE.items())):
        c = F.when(F.col("o_orderpriority") == prio, F.lit(typ)).otherwise(c)
    return c


def reads(t: Tables, window: bool = True, days: int = WINDOW_DAYS) -> DataFrame:
    """Lineage reads: ``table_id`` read by ``consumer_type``/``consumer_id`` on ``read_date``."""
    li = _lines(t, window, days).select("l_orderkey", "l_partkey", "l_shipdate")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority")
    return (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(F.col("l_partkey").alias("table_id"), _consumer_type().alias("consumer_type"),
                    F.col("o_custkey").alias("consumer_id"),
                    F.col("l_shipdate").cast("date").alias("read_date")))


def data_flow(t: Tables, days: int = LINEAGE_DAYS) -> DataFrame:
    """Lineage graph of ``days`` days: job -> table -> consumer; consumers of type JOB are the jobs of that id."""
    return lineage_graph.data_flow(writes(t, True, days), lineage.counted(reads(t, True, days), COUNTED_CONSUMERS))


def query_log(t: Tables) -> DataFrame:
    """Endpoint query log: ``statement_id, endpoint_id, start_time, latency``."""
    e = t.events.filter(F.col("event_type") == "view")
    return e.select(F.col("event_id").alias("statement_id"), F.col("user_id").alias("endpoint_id"),
                    F.col("ts").alias("start_time"), F.col("value").alias("latency"))


def node_timeline(t: Tables) -> DataFrame:
    """Node utilization samples: ``cluster_id, ts, cpu``."""
    return t.events.select(F.col("user_id").alias("cluster_id"), "ts", F.col("value").alias("cpu"))


# ---- regional catalogs for the consolidation ------------------------------------------
# which orders a regional catalog holds; the last catalog of a set holds all the others
CATALOG_ORDER_STATUS = {"A": "F", "B": "O", "C": "P"}


def catalogs_orders(t: Tables, names: tuple[str, ...] = ("A", "B", "C")) -> dict[str, DataFrame]:
    """Orders held by the regional catalogs ``names`` (split by ``o_orderstatus``).

    Every order is in exactly one of them, whatever its status: the last one holds those of
    no other, a NULL status included. A has every column; B lacks ``o_orderpriority`` and
    adds ``o_clerk``; C carries ``o_custkey`` as a string (a scalar type mismatch).
    """
    holder = F.lit(names[-1])
    for c in reversed(names[:-1]):
        holder = F.when(F.col("o_orderstatus") == CATALOG_ORDER_STATUS[c], c).otherwise(holder)
    shapes = {
        "A": lambda o: o,
        "B": lambda o: o.drop("o_orderpriority").withColumn("o_clerk", F.col("o_custkey").cast("string")),
        "C": lambda o: o.withColumn("o_custkey", F.col("o_custkey").cast("string")),
    }
    return {c: shapes[c](t.orders.filter(holder == c)) for c in names}


def catalogs_struct(t: Tables) -> dict[str, DataFrame]:
    """Struct mismatch: ``info`` is struct(o_orderstatus, o_custkey) in A, struct(o_orderstatus) in C."""
    cats = catalogs_orders(t, ("A", "C"))
    a = cats["A"].select("o_orderkey", F.struct("o_orderstatus", "o_custkey").alias("info"))
    c = cats["C"].select("o_orderkey", F.struct("o_orderstatus").alias("info"))
    return {"A": a, "C": c}


EVENTS_SPLIT = dt.datetime(2024, 1, 16)


def catalogs_mixed_events(t: Tables) -> dict[str, DataFrame]:
    """Events in A (before Jan 16) and B (from Jan 16); account-level ``signup`` rows appear in both."""
    e = t.events
    signup = F.col("event_type") == "signup"
    signup = F.coalesce(signup, F.lit(False))
    early = F.coalesce(F.col("ts") < ntz_lit(EVENTS_SPLIT), F.lit(False))  # a NULL time goes to B
    return {"A": e.filter(early | signup), "B": e.filter(~early | signup)}


def catalogs_all(t: Tables) -> dict[str, dict[str, DataFrame]]:
    """Three catalogs of ``schema.table`` frames for the multi-table consolidation.

    Holds a GLOBAL table (nation in every catalog), a MIXED table (events), regional
    tables, a table only in a later catalog (supplier in B, dropped by primary-only
    discovery) and excluded names (``metadata`` schema, ``__`` prefixes).
    """
    o = catalogs_orders(t)
    ev = catalogs_mixed_events(t)
    cust = t.customer
    in_a = F.coalesce(F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING"), F.lit(False))
    return {
        "A": {"tpch.orders": o["A"], "tpch.nation": t.nation, "tpch.events": ev["A"],
              "tpch.customer": cust.filter(in_a),
              "metadata.sync_log": t.region, "__staging.orders": o["A"], "tpch.__tmp": t.region},
        "B": {"tpch.orders": o["B"], "tpch.nation": t.nation, "tpch.events": ev["B"],
              "tpch.supplier": t.supplier},
        "C": {"tpch.orders": o["C"], "tpch.nation": t.nation,
              "tpch.customer": cust.filter(~in_a)},
    }


def catalogs_platform(t: Tables) -> dict[str, dict[str, DataFrame]]:
    """Three catalogs under platform table names, for the registry's rules."""
    o, ev = catalogs_orders(t), catalogs_mixed_events(t)
    return {
        "A": {"access.audit": ev["A"], "access.workspaces_latest": t.nation, "lakeflow.jobs": o["A"]},
        "B": {"access.audit": ev["B"], "access.workspaces_latest": t.nation, "lakeflow.jobs": o["B"]},
        "C": {"access.workspaces_latest": t.nation, "lakeflow.jobs": o["C"]},
    }


# regionality of the fixture tables: (regionality, dedup key for MIXED)
FIXTURE_TABLES = {
    "tpch.nation": ("GLOBAL", None),
    "tpch.region": ("GLOBAL", None),
    "tpch.events": ("MIXED", ["event_id"]),
}


def fixture_rule(name: str):
    return FIXTURE_TABLES.get(name, ("REGIONAL", None))


# ---- resource subsets ---------------------------------------------------------------------
def endpoint_usage(priced: DataFrame) -> DataFrame:
    """Priced usage of serving endpoints (FIL-3: ``family LIKE '%ECON%'``)."""
    return priced.filter(F.col("family").like(ENDPOINT_FAMILY_LIKE))


def pipeline_usage(df: DataFrame) -> DataFrame:
    """Usage of pipelines (FIL-4: ``family = 'PROMO'``)."""
    return df.filter(F.col("family") == PIPELINE_FAMILY)


def pipeline_outputs(df: DataFrame) -> DataFrame:
    """Output tables of each pipeline: the SKUs of its usage rows (``pipeline_id, table_id``)."""
    return pipeline_usage(df).select(F.col("resource_id").alias("pipeline_id"), F.col("sku").alias("table_id"))


def nested_usage(t: Tables, window: bool = True) -> DataFrame:
    """Usage whose resource ids sit in a ``usage_metadata`` struct, as in the platform table."""
    u = with_family(t, usage_daily(t, window))
    meta = F.struct(
        F.col("resource_id").alias("job_id"),
        F.lit(None).cast("bigint").alias("cluster_id"),
        F.lit(None).cast("bigint").alias("warehouse_id"),
        F.when(F.col("family").like(ENDPOINT_FAMILY_LIKE), F.col("resource_id")).alias("serving_endpoint_id"),
        F.when(F.col("family") == PIPELINE_FAMILY, F.col("resource_id")).alias("pipeline_id"),
    )
    return u.select(meta.alias("usage_metadata"), "sku", "usage_date", "state", "quantity", "family")


# ---- declared keys of the fixture tables (for DQ-*) ------------------------------------------
def fixture_keys() -> dict[str, KeyDecl]:
    """Declared keys of the test tables (composite key on lineitem, foreign keys to parents)."""
    return {
        "orders": KeyDecl(("o_orderkey",), (("o_custkey", "customer", "c_custkey"),)),
        "lineitem": KeyDecl(("l_orderkey", "l_linenumber"),
                            (("l_orderkey", "orders", "o_orderkey"), ("l_partkey", "part", "p_partkey"),
                             ("l_suppkey", "supplier", "s_suppkey"))),
        "customer": KeyDecl(("c_custkey",), (("c_nationkey", "nation", "n_nationkey"),)),
        "supplier": KeyDecl(("s_suppkey",), (("s_nationkey", "nation", "n_nationkey"),)),
        "part": KeyDecl(("p_partkey",)),
        "nation": KeyDecl(("n_nationkey",), (("n_regionkey", "region", "r_regionkey"),)),
        "events": KeyDecl(("event_id",)),
    }


def tenant_facts(t: Tables) -> dict[str, DataFrame]:
    """Facts for TEN-3: two carry the tenant key (one spelled in upper case), two do not."""
    return {
        "orders": tenant_fact(t),
        "customer": t.customer.withColumn("WORKSPACE_ID", F.col("c_custkey")),
        "part": t.part,
        "supplier": t.supplier,
    }


# ---- sync sources: the same tables at two points in time --------------------------------
def events_at_first_sync(t: Tables) -> DataFrame:
    """Events as the source looked at the first sync (rows up to the first mark)."""
    return t.events.filter(F.col("ts") <= ntz_lit(SYNC_FIRST_MARK))


ORDERS_FIRST_MARK = dt.datetime(1998, 1, 1)


def sync_sources(t: Tables, first: bool) -> dict[str, DataFrame]:
    """``schema.table`` sources for the multi-table sync; ``first`` = the earlier snapshot.

    ``orders`` has no candidate sync column, so it is synced with an explicit
    override (``o_orderdate``); ``nation`` and ``customer`` have none (fallback).
    """
    o = t.orders
    if first:
        o = o.filter(F.col("o_orderdate") <= ntz_lit(ORDERS_FIRST_MARK))
    return {
        "tpch.events": events_at_first_sync(t).withColumnRenamed("ts", "event_time") if first
        else t.events.withColumnRenamed("ts", "event_time"),
        "tpch.orders": o,
        "tpch.nation": t.nation,
        "tpch.customer": t.customer,
        "metadata.sync_log": t.region,
    }


SYNC_OVERRIDES = {"tpch.orders": "o_orderdate"}
