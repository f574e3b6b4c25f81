"""Many tenants in one pass, and distinct consumers over moving windows from daily sketches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterlake.operators import lineage, tenant


@pytest.fixture
def dim(spark):
    rows = [(i, f"{'dev' if i % 3 else 'prod'}-{i}") for i in range(40)] + [(4, "extra"), (None, "dev-x"), (41, None)]
    return spark.createDataFrame(rows, "workspace_id long, workspace_name string")


def test_fanout_equals_a_scope_per_tenant(spark, dim):
    """Seventy tenants (two words of bits), predicates that overlap, fit nothing, or are NULL."""
    fact = spark.createDataFrame([(i % 45 if i % 11 else None, i) for i in range(300)], "WORKSPACE_ID long, v int")
    filters = {f"t{k}": f"workspace_id % {k + 1} = 0" for k in range(64)} | {
        "dev": "workspace_name LIKE 'dev%'", "extra": "workspace_name = 'extra'", "none": "false", "unknown": "CAST(NULL AS boolean)", "all": "true", "last": "workspace_id = 39"}
    got = sorted((r.tenant, r.WORKSPACE_ID, r.v) for r in tenant.tenant_fanout(fact, dim, "workspace_id", filters).collect())
    # every sixth of the numbered tenants, and all of the others, are compared with a scope of their own
    some = [name for i, name in enumerate(filters) if i % 6 == 0 or i >= 64]
    want = sorted((name, r.WORKSPACE_ID, r.v) for name in some for r in tenant.tenant_scope(fact, dim, "workspace_id", filters[name]).collect())
    assert [x for x in got if x[0] in some] == want and len({x[0] for x in got}) > 60


def test_fanout_reads_the_fact_once(spark, dim, workdir):
    spark.range(100).select((F.col("id") % 40).alias("workspace_id"), "id").write.parquet(f"{workdir}/fact")
    df = tenant.tenant_fanout(spark.read.parquet(f"{workdir}/fact"), dim, "workspace_id", {f"t{k}": f"workspace_id > {k}" for k in range(50)})
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Union" not in plan
    with pytest.raises(ValueError, match="no tenants"):
        tenant.tenant_fanout(dim, dim, "workspace_id", {})
    with pytest.raises(ValueError, match="no column"):
        tenant.tenant_fanout(spark.range(1), dim, "workspace_id", {"a": "true"})


def reads(spark, rows):
    return spark.createDataFrame(rows, "table_id long, consumer_type string, consumer_id long, read_date date")


def test_rolling_consumers_are_exact_for_few(spark):
    day = lambda d: dt.date(2024, 1, 1) + dt.timedelta(days=d)
    rows = [(t, "JOB" if c % 2 else "NOTEBOOK", c, day(d)) for t in (1, 2) for d in (0, 3, 4, 9, 20) for c in range(t * 10 + d, t * 10 + d + 12)]
    rows += [(1, "JOB", None, day(2)), (1, "JOB", 5, None), (None, "JOB", 7, day(1))]
    got = {(r.table_id, r.day): r.consumers for r in lineage.consumers_rolling(lineage.daily_consumer_sketches(reads(spark, rows)), 7).collect()}
    usable = [r for r in rows if r[2] is not None and r[3] is not None]
    want = {(t, d): len({(k, c) for u, k, c, e in usable if u == t and 0 <= (d - e).days < 7}) for t, d in {(r[0], r[3]) for r in usable}}
    assert got == want
    assert lineage.consumers_rolling(lineage.daily_consumer_sketches(reads(spark, [])), 7).collect() == []


def test_rolling_consumers_error_and_size_for_many(spark):
    """200,000 consumers a day, half of them new each day: within four standard errors, a sketch of some 4 KB a day."""
    many = spark.range(0, 600_000).select(F.lit(1).cast("long").alias("table_id"), F.lit("JOB").alias("consumer_type"),
                                          (F.col("id") % 200_000 + F.floor(F.col("id") / 200_000) * 100_000).alias("consumer_id"),
                                          F.date_add(F.lit("2024-01-01").cast("date"), F.floor(F.col("id") / 200_000).cast("int")).alias("read_date"))
    sketches = lineage.daily_consumer_sketches(many).cache()
    assert sketches.agg(F.max(F.length("sketch"))).first()[0] <= 4200
    got = {r.day.day: r.consumers for r in lineage.consumers_rolling(sketches, 2).collect()}
    for d, exact in ((1, 200_000), (2, 300_000), (3, 300_000)):
        assert abs(got[d] / exact - 1) < 4 * 0.83 / 64


def test_rolling_consumers_shuffle_a_sketch_about_once(spark):
    """Three hundred days of five tables over 30 days: few sketches are handed on, a day in two sketches is one row, and chunk bounds change nothing."""
    from tests.test_price_history import joined_rows
    rows = [(t, "JOB", c, dt.date(1969, 6, 1) + dt.timedelta(days=d)) for t in range(5) for d in range(0, 300, 1 + t) for c in (d % 40, d % 7, t)]
    sketches = lineage.daily_consumer_sketches(reads(spark, rows)).localCheckpoint()
    df = lineage.consumers_rolling(sketches.unionByName(sketches.filter("table_id = 2")), 30)
    got = [(r.table_id, r.day, r.consumers) for r in df.collect()]
    want = [(t, d, len({c for u, _, c, e in rows if u == t and 0 <= (d - e).days < 30})) for t, d in {(r[0], r[3]) for r in rows}]
    assert sorted(got) == sorted(want)
    assert joined_rows(df._jdf.queryExecution().executedPlan()) <= 1.5 * (len(want) + 100)
