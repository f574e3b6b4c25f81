"""DuckDB SQL equal to each catalogue query (views: the driver's tables by name).

The SQL spells out the same fixture roles as ``plans.roles``; it is an independent
statement of the expected result, used by the correctness gate.
"""

from __future__ import annotations

import datetime as dt

# ---- role fragments --------------------------------------------------------------------
WIN_LINES = ("(SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-10-05' "
             "AND l_shipdate < TIMESTAMP '2001-11-05')")

PRICES = """(
  SELECT p_partkey AS sku, TIMESTAMP '1990-01-01' AS ps, TIMESTAMP '1998-01-01' AS pe,
         CAST(round(CAST(p_retailprice AS DECIMAL(12,2)) * 1.00, 2) AS DECIMAL(12,2)) AS price FROM part
  UNION ALL
  SELECT p_partkey, TIMESTAMP '1998-01-01', TIMESTAMP '2001-01-01',
         CAST(round(CAST(p_retailprice AS DECIMAL(12,2)) * 1.10, 2) AS DECIMAL(12,2)) FROM part
  UNION ALL
  SELECT p_partkey, TIMESTAMP '2001-01-01', CAST(NULL AS TIMESTAMP),
         CAST(round(CAST(p_retailprice AS DECIMAL(12,2)) * 1.25, 2) AS DECIMAL(12,2)) FROM part
)"""


def usage(lines: str) -> str:
    return f"""(
  SELECT l.l_suppkey AS resource_id, l.l_orderkey AS update_id, l.l_partkey AS sku,
         CAST(l.l_quantity AS DECIMAL(20,6)) AS quantity, CAST(l.l_shipdate AS DATE) AS usage_date,
         CASE WHEN l.l_returnflag = 'R' THEN 'FAILED' ELSE 'SUCCESS' END AS state, p.p_type AS family
  FROM {lines} l JOIN part p ON l.l_partkey = p.p_partkey
)"""


def priced(lines: str) -> str:
    return f"""(
  SELECT u.*, pr.price, u.quantity * pr.price AS cost
  FROM {usage(lines)} u JOIN {PRICES} pr
    ON u.sku = pr.sku AND CAST(u.usage_date AS TIMESTAMP) >= pr.ps
   AND (pr.pe IS NULL OR CAST(u.usage_date AS TIMESTAMP) < pr.pe)
)"""


JOBS_LATEST = """(
  SELECT s_suppkey AS job_id, s_name AS name, TIMESTAMP '2000-01-01' AS change_time FROM supplier
)"""

WRITES = f"""(
  SELECT l_suppkey AS job_id, l_partkey AS table_id, CAST(l_shipdate AS DATE) AS write_date FROM {WIN_LINES}
)"""

READS = f"""(
  SELECT l.l_partkey AS table_id,
         CASE o.o_orderpriority WHEN '1-URGENT' THEN 'JOB' WHEN '2-HIGH' THEN 'NOTEBOOK'
              WHEN '3-MEDIUM' THEN 'DASHBOARD' ELSE 'OTHER' END AS consumer_type,
         o.o_custkey AS consumer_id, CAST(l.l_shipdate AS DATE) AS read_date
  FROM {WIN_LINES} l JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""

COUNTED_READS = f"(SELECT * FROM {READS} r WHERE consumer_type IN ('NOTEBOOK', 'JOB', 'DASHBOARD'))"

SQL: dict[str, str] = {}

SQL["tenant_scope"] = """
SELECT o.*, o.o_custkey AS workspace_id FROM orders o
WHERE o.o_custkey IN (SELECT c_custkey FROM customer WHERE regexp_matches(c_mktsegment, '^(BUILD|MACH).*'))
"""

SQL["job_cost_per_consumer"] = f"""
WITH cost AS (
  SELECT resource_id AS job_id, sum(cost) AS c FROM {priced(WIN_LINES)} GROUP BY 1
), per_table AS (
  SELECT table_id, count(*) AS consumers FROM {COUNTED_READS} GROUP BY 1
), job_use AS (
  SELECT p.job_id, count(*) AS tables, coalesce(sum(pt.consumers), 0) AS consumers
  FROM (SELECT DISTINCT job_id, table_id FROM {WRITES}) p
  LEFT JOIN per_table pt ON p.table_id = pt.table_id GROUP BY 1
)
SELECT j.job_id, j.name, CAST(round(c.c, 2) AS DOUBLE) AS total_cost,
       CAST(coalesce(u.tables, 0) AS BIGINT) AS tables, CAST(coalesce(u.consumers, 0) AS BIGINT) AS consumers,
       CAST(round(c.c, 2) AS DOUBLE) / NULLIF(CAST(coalesce(u.consumers, 0) AS DOUBLE), 0) AS cost_per_consumer
FROM {JOBS_LATEST} j JOIN cost c ON j.job_id = c.job_id LEFT JOIN job_use u ON j.job_id = u.job_id
"""

# ---- consolidation ------------------------------------------------------------------------
_A = "(SELECT * FROM orders WHERE o_orderstatus = 'F')"
_B = "(SELECT * FROM orders WHERE o_orderstatus = 'O')"
_C = "(SELECT * FROM orders WHERE o_orderstatus IS NULL OR o_orderstatus NOT IN ('F', 'O'))"
_NOT_A = "(SELECT * FROM orders WHERE o_orderstatus IS DISTINCT FROM 'F')"

SQL["union_all_catalogs"] = f"""
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       o_orderpriority, CAST(NULL AS VARCHAR) AS o_clerk FROM {_A}
UNION ALL
SELECT o_orderkey, CAST(o_custkey AS VARCHAR), o_orderstatus, o_totalprice, o_orderdate,
       CAST(NULL AS VARCHAR), CAST(o_custkey AS VARCHAR) FROM {_B}
UNION ALL
SELECT o_orderkey, CAST(o_custkey AS VARCHAR), o_orderstatus, o_totalprice, o_orderdate,
       o_orderpriority, CAST(NULL AS VARCHAR) FROM {_C}
"""

SQL["union_missing_columns"] = f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       CAST(NULL AS VARCHAR) AS o_clerk FROM {_A}
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, CAST(NULL AS VARCHAR),
       CAST(o_custkey AS VARCHAR) FROM {_NOT_A}
"""

SQL["union_type_mismatch_scalar"] = f"""
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       o_orderpriority FROM {_A}
UNION ALL
SELECT o_orderkey, CAST(o_custkey AS VARCHAR), o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM {_NOT_A}
"""

SQL["union_type_mismatch_struct"] = f"""
SELECT o_orderkey, CAST(to_json(struct_pack(o_orderstatus := o_orderstatus, o_custkey := o_custkey)) AS VARCHAR)
       AS info FROM {_A}
UNION ALL
SELECT o_orderkey, CAST(to_json(struct_pack(o_orderstatus := o_orderstatus)) AS VARCHAR) FROM {_NOT_A}
"""

SQL["union_global_primary_only"] = "SELECT * FROM nation"

SQL["union_mixed_dedup"] = "SELECT * FROM events"

SQL["consolidate_all_counts"] = """
SELECT 'tpch.orders' AS view, 'REGIONAL' AS regionality, count(*) AS rows FROM orders
UNION ALL SELECT 'tpch.nation', 'GLOBAL', count(*) FROM nation
UNION ALL SELECT 'tpch.events', 'MIXED', count(*) FROM events
UNION ALL SELECT 'tpch.customer', 'REGIONAL', count(*) FROM customer
"""

SQL["drift_report"] = f"""
WITH meta(col_order, "column", type_a, type_b, type_c) AS (VALUES
  (1, 'o_orderkey', 'bigint', 'bigint', 'bigint'),
  (2, 'o_custkey', 'bigint', 'bigint', 'string'),
  (3, 'o_orderstatus', 'string', 'string', 'string'),
  (4, 'o_totalprice', 'double', 'double', 'double'),
  (5, 'o_orderdate', 'timestamp_ntz', 'timestamp_ntz', 'timestamp_ntz'),
  (6, 'o_orderpriority', 'string', NULL, 'string'),
  (7, 'o_clerk', NULL, 'string', NULL)
), counts AS (
  SELECT 'A' AS catalog, count(*) AS rows FROM {_A}
  UNION ALL SELECT 'B', count(*) FROM {_B}
  UNION ALL SELECT 'C', count(*) FROM {_C}
), cells AS (
  SELECT "column", 'A' AS catalog, type_a AS type, type_a IS DISTINCT FROM type_b OR type_a IS DISTINCT FROM type_c AS d,
         type_a, type_b, type_c FROM meta
  UNION ALL SELECT "column", 'B', type_b, NULL, type_a, type_b, type_c FROM meta
  UNION ALL SELECT "column", 'C', type_c, NULL, type_a, type_b, type_c FROM meta
)
SELECT 'tpch.orders' AS "table", c."column", c.catalog, c.type,
       CASE WHEN c.type IS NULL THEN 'missing'
            WHEN (SELECT count(DISTINCT x) FROM (VALUES (c.type_a), (c.type_b), (c.type_c)) v(x)) > 1
              THEN 'mismatch' ELSE 'ok' END AS status,
       n.rows
FROM cells c JOIN counts n ON c.catalog = n.catalog
"""

# ---- pricing and cost ------------------------------------------------------------------------
ALL_LINES = "lineitem"


def _money(x: str) -> str:
    return f"CAST(round({x}, 2) AS DOUBLE)"


def _ratio(num: str, den: str) -> str:
    return f"CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0)"


ALL_READS = """(
  SELECT l.l_partkey AS table_id,
         CASE o.o_orderpriority WHEN '1-URGENT' THEN 'JOB' WHEN '2-HIGH' THEN 'NOTEBOOK'
              WHEN '3-MEDIUM' THEN 'DASHBOARD' ELSE 'OTHER' END AS consumer_type,
         o.o_custkey AS consumer_id, CAST(l.l_shipdate AS DATE) AS read_date
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""
ALL_COUNTED_READS = f"(SELECT * FROM {ALL_READS} r WHERE consumer_type IN ('NOTEBOOK', 'JOB', 'DASHBOARD'))"

SQL["price_asof_join"] = f"""
SELECT resource_id, update_id, sku, usage_date, CAST(quantity AS DOUBLE) AS quantity,
       CAST(price AS DOUBLE) AS price, {_money('cost')} AS cost
FROM {priced(ALL_LINES)} x
"""

SQL["latest_dimension"] = f"SELECT * FROM {JOBS_LATEST} j"

SQL["cost_by_job"] = f"""
SELECT resource_id AS job_id, {_money('sum(cost)')} AS total_cost FROM {priced(WIN_LINES)} x GROUP BY 1
"""

SQL["nested_field_cost"] = f"""
WITH u AS (
  SELECT struct_pack(job_id := resource_id,
                     serving_endpoint_id := CASE WHEN family LIKE '%ECON%' THEN resource_id END,
                     pipeline_id := CASE WHEN family = 'PROMO' THEN resource_id END) AS usage_metadata, cost
  FROM {priced(WIN_LINES)} x
)
SELECT usage_metadata.job_id AS job_id, {_money('sum(cost)')} AS total_cost,
       {_money('sum(CASE WHEN usage_metadata.serving_endpoint_id IS NOT NULL THEN cost END)')} AS endpoint_cost,
       {_money('sum(CASE WHEN usage_metadata.pipeline_id IS NOT NULL THEN cost END)')} AS pipeline_cost
FROM u GROUP BY 1
"""

SQL["cost_success_vs_failed"] = f"""
SELECT resource_id AS job_id,
       {_money("coalesce(sum(CASE WHEN state = 'SUCCESS' THEN cost END), 0)")} AS cost_success,
       {_money("coalesce(sum(CASE WHEN state = 'FAILED' THEN cost END), 0)")} AS cost_failed
FROM {priced(WIN_LINES)} x GROUP BY 1
"""

SQL["cost_trend_daily"] = f"""
SELECT resource_id, usage_date AS bucket, {_money('sum(cost)')} AS cost FROM {priced(ALL_LINES)} x GROUP BY 1, 2
"""

SQL["rolling_30d_cost"] = f"""
WITH d AS (SELECT resource_id, usage_date, sum(cost) AS c FROM {priced(ALL_LINES)} x GROUP BY 1, 2)
SELECT resource_id, usage_date, {_money('c')} AS daily_cost,
       {_money('sum(c) OVER (PARTITION BY resource_id ORDER BY usage_date RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW)')} AS rolling_cost
FROM d
"""

SQL["cost_efficiency_trend"] = f"""
WITH cost AS (
  SELECT resource_id AS job_id, CAST(date_trunc('month', usage_date) AS DATE) AS bucket, sum(cost) AS c
  FROM {priced(ALL_LINES)} x GROUP BY 1, 2
), prod AS (
  SELECT DISTINCT l_suppkey AS job_id, l_partkey AS table_id,
         CAST(date_trunc('month', CAST(l_shipdate AS DATE)) AS DATE) AS bucket FROM lineitem
), pt AS (
  SELECT table_id, CAST(date_trunc('month', read_date) AS DATE) AS bucket, count(*) AS r
  FROM {ALL_COUNTED_READS} r GROUP BY 1, 2
), used AS (
  SELECT p.job_id, p.bucket, sum(pt.r) AS reads FROM prod p JOIN pt ON p.table_id = pt.table_id AND p.bucket = pt.bucket
  GROUP BY 1, 2
)
SELECT coalesce(c.job_id, u.job_id) AS job_id, coalesce(c.bucket, u.bucket) AS bucket, {_money('c.c')} AS cost,
       CAST(coalesce(u.reads, 0) AS BIGINT) AS reads, {_ratio(_money('c.c'), 'coalesce(u.reads, 0)')} AS cost_per_read
FROM cost c FULL OUTER JOIN used u ON c.job_id = u.job_id AND c.bucket = u.bucket
"""

# ---- lineage ---------------------------------------------------------------------------------
SQL["tables_per_job"] = f"SELECT job_id, count(DISTINCT table_id) AS tables FROM {WRITES} w GROUP BY 1"

SQL["consumers_per_table"] = f"SELECT table_id, count(*) AS consumers FROM {COUNTED_READS} r GROUP BY 1"

SQL["consumer_breakdown"] = f"""
SELECT table_id, count(DISTINCT consumer_type || ':' || CAST(consumer_id AS VARCHAR)) AS distinct_consumers,
       CAST(count(*) FILTER (WHERE consumer_type = 'JOB') AS BIGINT) AS job,
       CAST(count(*) FILTER (WHERE consumer_type = 'NOTEBOOK') AS BIGINT) AS notebook,
       CAST(count(*) FILTER (WHERE consumer_type = 'DASHBOARD') AS BIGINT) AS dashboard
FROM {COUNTED_READS} r GROUP BY 1
"""

SQL["lineage_job_table_consumer"] = f"""
WITH pt AS (
  SELECT table_id, consumer_type, count(DISTINCT consumer_id) AS consumers, count(*) AS reads
  FROM {COUNTED_READS} r GROUP BY 1, 2
)
SELECT p.table_id, p.job_id, pt.consumer_type, pt.consumers, pt.reads
FROM (SELECT DISTINCT job_id, table_id FROM {WRITES} w) p JOIN pt ON p.table_id = pt.table_id
"""

SQL["lineage_edges"] = f"""
SELECT 'job:' || CAST(job_id AS VARCHAR) AS source, 'table:' || CAST(table_id AS VARCHAR) AS target,
       count(*) AS weight FROM {WRITES} w GROUP BY job_id, table_id
UNION ALL
SELECT 'table:' || CAST(table_id AS VARCHAR), consumer_type, count(*) FROM {COUNTED_READS} r GROUP BY table_id, consumer_type
"""

UNUSED = f"""(
  SELECT DISTINCT table_id FROM {WRITES} w
  WHERE NOT EXISTS (SELECT 1 FROM {COUNTED_READS} r WHERE r.table_id = w.table_id)
)"""

SQL["unused_tables"] = f"SELECT * FROM {UNUSED} u"

SQL["table_freshness"] = """
SELECT l_partkey AS table_id, max(CAST(l_shipdate AS DATE)) AS last_write,
       CAST(date_diff('day', max(CAST(l_shipdate AS DATE)), DATE '2001-11-04') AS BIGINT) AS age_days
FROM lineitem GROUP BY 1
"""

SQL["table_refresh_stats"] = """
WITH d AS (SELECT l_partkey AS table_id, CAST(l_shipdate AS DATE) AS dd, count(*) AS n FROM lineitem GROUP BY 1, 2),
g AS (SELECT table_id, n, dd - lag(dd) OVER (PARTITION BY table_id ORDER BY dd) AS gap FROM d)
SELECT table_id, count(*) AS refreshes, round(avg(gap), 6) AS mean_gap_days, CAST(sum(n) AS BIGINT) AS rows
FROM g GROUP BY 1
"""

# ---- table, endpoint and pipeline attribution ------------------------------------------------
TABLE_COST = f"""(
  WITH cost AS (SELECT resource_id AS job_id, {_money('sum(cost)')} AS cost FROM {priced(WIN_LINES)} x GROUP BY 1),
  pairs AS (SELECT DISTINCT job_id, table_id FROM {WRITES} w),
  n AS (SELECT job_id, count(*) AS n FROM pairs GROUP BY 1)
  SELECT p.table_id, round(sum(c.cost / n.n), 6) AS cost
  FROM pairs p JOIN n ON p.job_id = n.job_id JOIN cost c ON p.job_id = c.job_id GROUP BY 1
)"""

TABLE_COST_PER_READ = f"""(
  SELECT tc.table_id, tc.cost, CAST(coalesce(r.reads, 0) AS BIGINT) AS reads,
         round({_ratio('tc.cost', 'coalesce(r.reads, 0)')}, 6) AS cost_per_read
  FROM {TABLE_COST} tc LEFT JOIN (SELECT table_id, count(*) AS reads FROM {COUNTED_READS} r GROUP BY 1) r
    ON tc.table_id = r.table_id
)"""

SQL["table_cost"] = f"SELECT * FROM {TABLE_COST} t"
SQL["table_cost_per_read"] = f"SELECT * FROM {TABLE_COST_PER_READ} t"
SQL["unused_tables_with_cost"] = f"SELECT u.table_id, tc.cost FROM {UNUSED} u JOIN {TABLE_COST} tc ON u.table_id = tc.table_id"

QUERY_LOG = """(
  SELECT event_id AS statement_id, user_id AS endpoint_id, ts AS start_time, value AS latency
  FROM events WHERE event_type = 'view'
)"""

ENDPOINT_REPORT = f"""(
  WITH cost AS (SELECT resource_id AS endpoint_id, sum(cost) AS c FROM {priced(WIN_LINES)} x
                WHERE family LIKE '%ECON%' GROUP BY 1),
  q AS (SELECT endpoint_id, count(*) AS q FROM {QUERY_LOG} ql
        WHERE start_time >= TIMESTAMP '2024-01-01' AND start_time < TIMESTAMP '2024-02-01' GROUP BY 1)
  SELECT c.endpoint_id, {_money('c.c')} AS total_cost, CAST(coalesce(q.q, 0) AS BIGINT) AS query_count,
         {_ratio(_money('c.c'), 'coalesce(q.q, 0)')} AS cost_per_query
  FROM cost c LEFT JOIN q ON c.endpoint_id = q.endpoint_id
)"""

SQL["endpoint_cost_per_query"] = f"SELECT * FROM {ENDPOINT_REPORT} e"

PIPE_USAGE = f"(SELECT * FROM {priced(WIN_LINES)} x WHERE family = 'PROMO')"
PIPE_OUTS = f"(SELECT DISTINCT resource_id AS pipeline_id, sku AS table_id FROM {PIPE_USAGE} pu)"

PIPELINE_ROI = f"""(
  WITH cost AS (SELECT resource_id AS pipeline_id, sum(cost) AS c FROM {PIPE_USAGE} pu GROUP BY 1),
  pt AS (SELECT table_id, count(*) AS consumers FROM {COUNTED_READS} r GROUP BY 1),
  used AS (SELECT o.pipeline_id, coalesce(sum(pt.consumers), 0) AS consumers
           FROM {PIPE_OUTS} o LEFT JOIN pt ON o.table_id = pt.table_id GROUP BY 1)
  SELECT c.pipeline_id, {_money('c.c')} AS cost, CAST(coalesce(u.consumers, 0) AS BIGINT) AS consumers,
         {_ratio(_money('c.c'), 'coalesce(u.consumers, 0)')} AS cost_per_consumer
  FROM cost c LEFT JOIN used u ON c.pipeline_id = u.pipeline_id
)"""

SQL["pipeline_roi"] = f"SELECT * FROM {PIPELINE_ROI} p"

SQL["pipeline_cost_by_table"] = f"""
WITH cost AS (SELECT resource_id AS pipeline_id, {_money('sum(cost)')} AS cost FROM {PIPE_USAGE} pu GROUP BY 1),
n AS (SELECT pipeline_id, count(*) AS n FROM {PIPE_OUTS} o GROUP BY 1)
SELECT o.pipeline_id, o.table_id, round(c.cost / n.n, 6) AS cost_share
FROM {PIPE_OUTS} o JOIN n ON o.pipeline_id = n.pipeline_id JOIN cost c ON o.pipeline_id = c.pipeline_id
"""

SQL["cost_per_run"] = f"""
WITH cost AS (SELECT resource_id AS pipeline_id, sum(cost) AS c FROM {PIPE_USAGE} pu GROUP BY 1),
runs AS (SELECT resource_id AS pipeline_id, count(DISTINCT update_id) AS runs FROM {usage(WIN_LINES)} u
         WHERE family = 'PROMO' GROUP BY 1)
SELECT c.pipeline_id, CAST(coalesce(r.runs, 0) AS BIGINT) AS runs, {_money('c.c')} AS cost,
       {_ratio(_money('c.c'), 'coalesce(r.runs, 0)')} AS cost_per_run
FROM cost c LEFT JOIN runs r ON c.pipeline_id = r.pipeline_id
"""

# ---- query patterns, percentiles, utilization ----------------------------------------------
SQL["query_pattern_by_hour"] = f"""
SELECT CAST(hour(start_time) AS BIGINT) AS hour, CAST(dayofweek(start_time) AS BIGINT) AS weekday, count(*) AS n
FROM {QUERY_LOG} q GROUP BY 1, 2
"""

SQL["peak_hour"] = f"""
WITH per AS (SELECT endpoint_id, CAST(hour(start_time) AS BIGINT) AS hour, count(*) AS n FROM {QUERY_LOG} q GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY endpoint_id ORDER BY n DESC, hour ASC) AS rn FROM per)
SELECT endpoint_id, hour, n FROM ranked WHERE rn = 1
"""

SQL["latency_percentiles"] = f"""
SELECT endpoint_id, round(quantile_cont(latency, 0.5), 6) AS p50, round(quantile_cont(latency, 0.95), 6) AS p95,
       round(quantile_cont(latency, 0.99), 6) AS p99
FROM {QUERY_LOG} q GROUP BY 1
"""

SQL["node_utilization_hourly"] = """
SELECT user_id AS cluster_id, date_trunc('hour', ts) AS hour_start, round(avg(value), 6) AS avg_cpu,
       max(value) AS max_cpu, round(quantile_cont(value, 0.95), 6) AS p95_cpu, count(*) AS samples
FROM events GROUP BY 1, 2
"""

SQL["efficiency_score"] = f"""
WITH e AS (SELECT endpoint_id, {_ratio('query_count', 'total_cost')} AS v FROM {ENDPOINT_REPORT} r)
SELECT endpoint_id, round(v, 6) AS per_cost_unit,
       round(CASE WHEN v IS NULL THEN NULL ELSE percent_rank() OVER (PARTITION BY v IS NULL ORDER BY v) END, 6) AS score
FROM e
"""

# ---- ranking, quadrants, explorer ------------------------------------------------------------
SQL["top10_cost_per_read"] = f"""
SELECT * FROM {TABLE_COST_PER_READ} t ORDER BY cost_per_read DESC NULLS LAST, table_id LIMIT 10
"""

SQL["cost_utilization_quadrant"] = f"""
WITH t AS (SELECT table_id, cost, reads FROM {TABLE_COST_PER_READ} x),
m AS (SELECT median(cost) AS mc, median(reads) AS mr FROM t)
SELECT t.table_id, t.cost, t.reads,
       CASE WHEN t.cost > m.mc THEN 'high' ELSE 'low' END || '_' || CASE WHEN t.reads > m.mr THEN 'high' ELSE 'low' END
         AS quadrant
FROM t, m
"""

JOB_REPORT = SQL["job_cost_per_consumer"]

EXPLORER = f"""(
  WITH parts AS (
    SELECT 'JOB' AS resource_type, job_id AS id, name, total_cost AS cost, consumers AS utilization
    FROM ({JOB_REPORT}) j
    UNION ALL
    SELECT 'TABLE', table_id, 'table_' || CAST(table_id AS VARCHAR), cost, reads FROM {TABLE_COST_PER_READ} t
    UNION ALL
    SELECT 'ENDPOINT', endpoint_id, 'endpoint_' || CAST(endpoint_id AS VARCHAR), total_cost, query_count
    FROM {ENDPOINT_REPORT} e
    UNION ALL
    SELECT 'PIPELINE', pipeline_id, 'pipeline_' || CAST(pipeline_id AS VARCHAR), cost, consumers FROM {PIPELINE_ROI} p
  )
  SELECT resource_type, CAST(id AS BIGINT) AS id, name, CAST(cost AS DOUBLE) AS cost,
         CAST(utilization AS BIGINT) AS utilization, CAST(round(CAST(CAST({_ratio('cost', 'utilization')} AS VARCHAR) AS DECIMAL(38,12)), 6) AS DOUBLE) AS cost_per_utilization
  FROM parts
)"""

SQL["resource_explorer"] = f"SELECT * FROM {EXPLORER} x"
SQL["explorer_search"] = f"SELECT * FROM {EXPLORER} x WHERE contains(lower(name), '7')"

# ---- key checks ------------------------------------------------------------------------------
SQL["pk_duplicates"] = """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
"""

SQL["pk_nulls"] = """
SELECT 'orders' AS table_name, count(*) AS rows, count(*) FILTER (WHERE o_orderkey IS NULL) AS nulls FROM orders
UNION ALL SELECT 'lineitem', count(*), count(*) FILTER (WHERE l_orderkey IS NULL OR l_linenumber IS NULL) FROM lineitem
UNION ALL SELECT 'customer', count(*), count(*) FILTER (WHERE c_custkey IS NULL) FROM customer
UNION ALL SELECT 'supplier', count(*), count(*) FILTER (WHERE s_suppkey IS NULL) FROM supplier
UNION ALL SELECT 'part', count(*), count(*) FILTER (WHERE p_partkey IS NULL) FROM part
UNION ALL SELECT 'nation', count(*), count(*) FILTER (WHERE n_nationkey IS NULL) FROM nation
UNION ALL SELECT 'events', count(*), count(*) FILTER (WHERE event_id IS NULL) FROM events
"""

SQL["fk_orphans"] = """
SELECT o_custkey, count(*) AS rows FROM orders o
WHERE o_custkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_mktsegment <> 'BUILDING' AND c.c_custkey = o.o_custkey)
GROUP BY 1
"""


def _pk_line(table: str, cols: list[str]) -> str:
    k = ", ".join(cols)
    anynull = " OR ".join(f"{c} IS NULL" for c in cols)
    return f"""SELECT '{table}' AS table_name, 'pk({k})' AS key_name, 'pk' AS kind,
       CAST(sum(n) AS BIGINT) AS rows, CAST(count(*) FILTER (WHERE n > 1 AND NOT ({anynull})) AS BIGINT) AS duplicates,
       CAST(coalesce(sum(n) FILTER (WHERE {anynull}), 0) AS BIGINT) AS nulls, CAST(0 AS BIGINT) AS orphans
FROM (SELECT {k}, count(*) AS n FROM {table} GROUP BY {k}) g"""


def _fk_line(table: str, col: str, ptable: str, pcol: str) -> str:
    return f"""SELECT '{table}' AS table_name, 'fk({col} -> {ptable}.{pcol})' AS key_name, 'fk' AS kind,
       count(*) AS rows, CAST(0 AS BIGINT) AS duplicates,
       count(*) FILTER (WHERE c.{col} IS NULL) AS nulls,
       count(*) FILTER (WHERE c.{col} IS NOT NULL AND p.k IS NULL) AS orphans
FROM {table} c LEFT JOIN (SELECT DISTINCT {pcol} AS k FROM {ptable}) p ON c.{col} = p.k"""


SQL["key_report"] = "\nUNION ALL\n".join([
    _pk_line("orders", ["o_orderkey"]), _fk_line("orders", "o_custkey", "customer", "c_custkey"),
    _pk_line("lineitem", ["l_orderkey", "l_linenumber"]),
    _fk_line("lineitem", "l_orderkey", "orders", "o_orderkey"),
    _fk_line("lineitem", "l_partkey", "part", "p_partkey"),
    _fk_line("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    _pk_line("customer", ["c_custkey"]), _fk_line("customer", "c_nationkey", "nation", "n_nationkey"),
    _pk_line("supplier", ["s_suppkey"]), _fk_line("supplier", "s_nationkey", "nation", "n_nationkey"),
    _pk_line("part", ["p_partkey"]),
    _pk_line("nation", ["n_nationkey"]), _fk_line("nation", "n_regionkey", "region", "r_regionkey"),
    _pk_line("events", ["event_id"]),
])

# ---- tenant views over many tables -----------------------------------------------------------
_SCOPED_KEYS = "(SELECT c_custkey FROM customer WHERE regexp_matches(c_mktsegment, '^(BUILD|MACH).*'))"

SQL["tenant_scope_all"] = f"""
SELECT 'orders' AS table_name, true AS scoped, count(*) AS rows FROM orders WHERE o_custkey IN {_SCOPED_KEYS}
UNION ALL SELECT 'customer', true, count(*) FROM customer WHERE c_custkey IN {_SCOPED_KEYS}
UNION ALL SELECT 'part', false, CAST(0 AS BIGINT)
UNION ALL SELECT 'supplier', false, CAST(0 AS BIGINT)
"""

SQL["view_row_counts"] = """
SELECT 'tpch.orders' AS view, count(*) AS rows FROM orders
UNION ALL SELECT 'tpch.nation', count(*) FROM nation
UNION ALL SELECT 'tpch.events', count(*) FROM events
UNION ALL SELECT 'tpch.customer', count(*) FROM customer
UNION ALL SELECT 'tpch.supplier', count(*) FROM supplier
"""

# ---- sync, compaction, streaming copy: the expected final content ----------------------------
_M1 = "TIMESTAMP '2024-01-15 23:59:59.999999'"

SQL["sync_full"] = "SELECT * FROM events"
SQL["sync_full_fallback"] = "SELECT * FROM nation"
SQL["sync_incremental"] = "SELECT * FROM events"
SQL["sync_incremental_schema_growth"] = f"""
SELECT event_id, ts, user_id, event_type, value, CASE WHEN ts <= {_M1} THEN NULL ELSE props END AS props FROM events
"""

SQL["sync_modes"] = f"""
SELECT CAST(1 AS BIGINT) AS run, 'events' AS table_name, 'FULL' AS mode, (SELECT count(*) FROM events WHERE ts <= {_M1}) AS rows
UNION ALL SELECT 1, 'nation', 'FULL', (SELECT count(*) FROM nation)
UNION ALL SELECT 2, 'events', 'INCREMENTAL', (SELECT count(*) FROM events WHERE ts > {_M1})
UNION ALL SELECT 2, 'nation', 'FULL_FALLBACK', (SELECT count(*) FROM nation)
UNION ALL SELECT 3, 'events', 'FULL', (SELECT count(*) FROM events)
UNION ALL SELECT 3, 'nation', 'FULL', (SELECT count(*) FROM nation)
"""

SQL["sync_state_upsert"] = """
SELECT 'tpch' AS schema_name, 'events' AS table_name, 'tpch.events' AS full_table_name,
       max(ts) AS last_sync_timestamp, 'INCREMENTAL' AS last_sync_mode, 'SUCCESS' AS sync_status FROM events
UNION ALL SELECT 'tpch', 'nation', 'tpch.nation', CAST(NULL AS TIMESTAMP), 'FULL_FALLBACK', 'SUCCESS'
"""

SQL["sync_all_tables"] = f"""
SELECT 'tpch.events' AS table_name, 'INCREMENTAL' AS last_mode,
       (SELECT count(*) FROM events WHERE ts > {_M1}) AS rows_loaded, (SELECT count(*) FROM events) AS target_rows
UNION ALL SELECT 'tpch.orders', 'INCREMENTAL', (SELECT count(*) FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01'),
       (SELECT count(*) FROM orders)
UNION ALL SELECT 'tpch.nation', 'FULL_FALLBACK', (SELECT count(*) FROM nation), (SELECT count(*) FROM nation)
UNION ALL SELECT 'tpch.customer', 'FULL_FALLBACK', (SELECT count(*) FROM customer), (SELECT count(*) FROM customer)
"""

SQL["sync_summary"] = """
SELECT CAST(run AS BIGINT) AS run, CAST(f AS BIGINT) AS full_loads, CAST(i AS BIGINT) AS incremental_loads
FROM (VALUES (1, 4, 0), (2, 2, 2)) v(run, f, i)
"""

SQL["compact_files"] = "SELECT * FROM events"
SQL["sync_full_after_failure"] = "SELECT * FROM events"
SQL["sync_uncommitted_hidden"] = f"SELECT * FROM events WHERE ts <= {_M1}"
SQL["sync_late_rows"] = "SELECT * FROM events"
SQL["sync_null_marks"] = "SELECT * REPLACE (CAST(NULL AS TIMESTAMP) AS ts) FROM events"
SQL["published_views"] = """
SELECT 'tpch__orders' AS view_name, count(*) AS rows FROM orders
UNION ALL SELECT 'tpch__nation', count(*) FROM nation
UNION ALL SELECT 'tpch__events', count(*) FROM events
UNION ALL SELECT 'tpch__customer', count(*) FROM customer
"""
SQL["unpriced_usage"] = f"""
SELECT resource_id, update_id, sku, usage_date, CAST(quantity AS DOUBLE) AS quantity, state
FROM {usage('lineitem')} WHERE usage_date >= DATE '2001-01-01' OR usage_date < DATE '1990-01-01'
"""
SQL["price_overlaps"] = """
SELECT p_partkey AS sku, TIMESTAMP '1990-01-01' AS price_start_time, TIMESTAMP '1998-01-01' AS price_end_time,
       TIMESTAMP '1997-06-01' AS next_start FROM part
"""
SQL["explorer_search_by_type"] = f"SELECT * FROM {EXPLORER} x WHERE resource_type = 'TABLE' AND contains(lower(name), '1')"


def _days(sql: str, days: int) -> str:
    """The 30-day report over another number of days ending at the same dates."""
    end, event_end = dt.date(2001, 11, 4), dt.date(2024, 1, 31)
    first = f"TIMESTAMP '{end - dt.timedelta(days=days)}'", f"TIMESTAMP '{event_end - dt.timedelta(days=days)}'"
    return sql.replace("TIMESTAMP '2001-10-05'", first[0]).replace("TIMESTAMP '2024-01-01'", first[1])


SQL["explorer_7d"] = _days(SQL["resource_explorer"], 7)
SQL["explorer_90d"] = _days(SQL["resource_explorer"], 90)
SQL["stream_copy_available_now"] = "SELECT * FROM events"
SQL["consolidate_by_registry"] = """
SELECT 'access.audit' AS view, 'MIXED' AS regionality, count(*) AS rows FROM events
UNION ALL SELECT 'access.workspaces_latest', 'GLOBAL', count(*) FROM nation
UNION ALL SELECT 'lakeflow.jobs', 'REGIONAL', count(*) FROM orders
"""
SQL["key_report_nested"] = """
SELECT 'billing.list_prices' AS table_name, 'pk(sku_name, price_start_time)' AS key_name, 'pk' AS kind, 3 * count(*) AS rows,
       CAST(0 AS BIGINT) AS duplicates, CAST(0 AS BIGINT) AS nulls, CAST(0 AS BIGINT) AS orphans FROM part
UNION ALL SELECT 'nested_events', 'pk(meta.event_id)', 'pk', count(*), 0, 0, 0 FROM events
UNION ALL SELECT 'nested_events', 'fk(meta.user_id -> nested_events.meta.user_id)', 'fk', count(*), 0,
       count(*) FILTER (user_id IS NULL), 0 FROM events
"""

# ---- lineage over several hops ---------------------------------------------------------------
YEAR_LINES = ("(SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-11-04' "
              "AND l_shipdate < TIMESTAMP '2001-11-05')")
_FLOW = f"""
edges AS MATERIALIZED (
  SELECT DISTINCT 'job:' || l_suppkey AS src, 'table:' || l_partkey AS dst FROM {YEAR_LINES}
  UNION
  SELECT 'table:' || l.l_partkey, CASE o.o_orderpriority WHEN '1-URGENT' THEN 'job:' WHEN '2-HIGH' THEN 'notebook:' ELSE 'dashboard:' END || o.o_custkey
  FROM {YEAR_LINES} l JOIN orders o ON l.l_orderkey = o.o_orderkey
  WHERE o.o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM'))"""
_FAILED = f"SELECT DISTINCT 'job:' || l_suppkey FROM {WIN_LINES} WHERE l_returnflag = 'R'"
_DEAREST = f"SELECT 'table:' || table_id AS node FROM {TABLE_COST_PER_READ} t ORDER BY cost_per_read DESC NULLS LAST, table_id LIMIT 10"
# longer than the longest shortest path between any two nodes of the test data
_HOPS = 30

_DOWNSTREAM = f"""
WITH RECURSIVE {_FLOW},
walk(node, hops) AS ({_FAILED.replace("DISTINCT 'job:' || l_suppkey", "DISTINCT 'job:' || l_suppkey, 0")}
  UNION SELECT e.dst, w.hops + 1 FROM walk w JOIN edges e ON e.src = w.node WHERE w.hops < {_HOPS})
SELECT node, min(hops)::BIGINT AS hops FROM walk GROUP BY 1"""
SQL["lineage_downstream"] = _DOWNSTREAM
SQL["lineage_impact"] = f"SELECT split_part(node, ':', 1) AS kind, hops, count(*) AS nodes FROM ({_DOWNSTREAM}) d GROUP BY 1, 2"


def _walk(name: str, src: str, dst: str, hops: int) -> str:
    return f"""{name}(start, node, hops) AS (SELECT node, node, 0 FROM starts
  UNION SELECT w.start, e.{dst}, w.hops + 1 FROM {name} w JOIN edges e ON e.{src} = w.node WHERE w.hops < {hops})"""


SQL["lineage_upstream"] = f"""
WITH RECURSIVE {_FLOW}, starts AS MATERIALIZED ({_DEAREST}), {_walk('up', 'dst', 'src', _HOPS)}
SELECT start, node, min(hops)::BIGINT AS hops FROM up GROUP BY 1, 2"""

SQL["lineage_related"] = f"""
WITH RECURSIVE {_FLOW}, starts AS MATERIALIZED ({_DEAREST}), {_walk('up', 'dst', 'src', 3)}, {_walk('down', 'src', 'dst', 3)}
SELECT start, 'upstream' AS direction, node, min(hops)::BIGINT AS hops FROM up GROUP BY start, node HAVING min(hops) > 0
UNION ALL
SELECT start, 'downstream', node, min(hops)::BIGINT FROM down GROUP BY start, node HAVING min(hops) > 0"""

SQL["latency_ranks"] = f"""
WITH v AS (SELECT endpoint_id, CAST(latency AS DOUBLE) AS latency, count(*) AS cnt FROM {QUERY_LOG} q WHERE latency IS NOT NULL GROUP BY 1, 2)
SELECT endpoint_id, latency, cnt,
       CAST(coalesce(sum(cnt) OVER (PARTITION BY endpoint_id ORDER BY latency ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS below,
       CAST(sum(cnt) OVER (PARTITION BY endpoint_id) AS BIGINT) AS n
FROM v"""

SQL["price_asof_long_history"] = """
WITH versions AS (
  SELECT p_partkey AS sku, CAST(DATE '1992-01-01' + to_months(CAST(m AS INTEGER)) AS TIMESTAMP) AS ps,
         CASE WHEN m % 12 = 11 THEN CAST(DATE '1992-01-01' + to_months(CAST(m AS INTEGER)) AS TIMESTAMP) + INTERVAL 15 DAY
              WHEN m < 119 THEN CAST(DATE '1992-01-01' + to_months(CAST(m + 1 AS INTEGER)) AS TIMESTAMP) END AS pe,
         CAST(round(CAST(p_retailprice AS DECIMAL(12,2)) * CAST((100 + (m * 7) % 40) / 100.0 AS DECIMAL(5,2)), 2) AS DECIMAL(12,2)) AS price
  FROM part, range(0, 120) r(m))
SELECT l.l_suppkey AS resource_id, l.l_orderkey AS update_id, l.l_partkey AS sku, CAST(l.l_shipdate AS DATE) AS usage_date,
       CAST(CAST(l.l_quantity AS DECIMAL(20,6)) AS DOUBLE) AS quantity, CAST(v.price AS DOUBLE) AS price,
       CAST(round(CAST(l.l_quantity AS DECIMAL(20,6)) * v.price, 2) AS DOUBLE) AS cost, CASE WHEN l.l_returnflag = 'R' THEN 'FAILED' ELSE 'SUCCESS' END AS state
FROM lineitem l JOIN versions v ON l.l_partkey = v.sku AND CAST(l.l_shipdate AS DATE) >= v.ps AND (v.pe IS NULL OR CAST(l.l_shipdate AS DATE) < v.pe)
"""
SQL["price_asof_long_history"] = f"SELECT * EXCLUDE (state) FROM ({SQL['price_asof_long_history']}) x"

# ---- sync: types, snapshots, many runs, streams ------------------------------------------------
SQL["sync_type_change"] = "SELECT * FROM events"
SQL["snapshot_twice"] = """
SELECT 'tpch' AS schema_name, 'events' AS table_name, 'tpch.events' AS full_table_name,
       max(ts) AS last_sync_timestamp, 'INCREMENTAL' AS last_sync_mode, 'SUCCESS' AS sync_status FROM events"""
SQL["date_target_many_runs"] = "SELECT *, CAST(o_orderdate AS DATE) AS usage_date FROM orders"
SQL["stream_into_sync"] = "SELECT * FROM events"

SQL["explorer_from_rollup"] = " UNION ALL ".join(
    f"SELECT *, {days} AS days FROM ({SQL[key]}) e{days}" for days, key in ((7, "explorer_7d"), (30, "resource_explorer"), (90, "explorer_90d")))

# ---- many tenants, rolling distinct counts ----------------------------------------------------
_TENANTS = {f"segment_{n.lower()}": f"regexp_matches(c_mktsegment, '^{n}')" for n in ("AUTO", "BUILD", "FURN", "HOUSE", "MACH")} \
    | {f"group_{k}": f"c_custkey % 45 = {k}" for k in range(45)}
SQL["tenant_fanout"] = " UNION ALL ".join(
    f"SELECT o.*, o.o_custkey AS workspace_id, '{name}' AS tenant FROM orders o WHERE o.o_custkey IN (SELECT c_custkey FROM customer WHERE {p})"
    for name, p in _TENANTS.items())

SQL["consumers_rolling_30d"] = """
WITH r AS (
  SELECT DISTINCT l.l_partkey AS table_id, CAST(l.l_shipdate AS DATE) AS day, o.o_orderpriority || ':' || o.o_custkey AS consumer
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE o.o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM'))
SELECT d.table_id, d.day, count(DISTINCT r.consumer) AS consumers
FROM (SELECT DISTINCT table_id, day FROM r) d JOIN r ON r.table_id = d.table_id AND r.day BETWEEN d.day - 29 AND d.day GROUP BY 1, 2"""

SQL["explorer_search_indexed"] = f"""
SELECT e.*, n.needle FROM ({SQL["resource_explorer"]}) e, (VALUES ('7'), ('_1'), ('E_1'), ('table_1'), ('SUPPLIER#0'), ('endpoint_42'), ('99'), ('no such name')) n(needle)
WHERE contains(lower(e.name), lower(n.needle))"""

SQL["rolling_24h_load"] = """
WITH h AS (SELECT user_id AS cluster_id, date_trunc('hour', ts) AS hour, sum(CAST(value AS DECIMAL(18,6))) AS load FROM events GROUP BY 1, 2)
SELECT cluster_id, CAST(hour AS TIMESTAMP) AS hour, CAST(load AS DOUBLE) AS load,
       CAST(sum(load) OVER (PARTITION BY cluster_id ORDER BY hour RANGE BETWEEN INTERVAL 23 HOURS PRECEDING AND CURRENT ROW) AS DOUBLE) AS load_24h
FROM h"""
