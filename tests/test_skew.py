"""A key with 99% of the rows, broadcast off: its join is split, or it is reduced before the shuffle."""

import pytest
from pyspark.sql import functions as F

from meterlake.operators import lineage, pricing, quality

CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def cluster_like(spark):
    before = {k: spark.conf.get(k) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def hot(spark, n=60_000):
    key = F.when(F.col("id") % 100 == 0, F.col("id")).otherwise(F.lit(7))
    return spark.range(0, n, 1, 8).select(key.alias("sku"), F.lit("2024-01-05").cast("date").alias("usage_date"),
                                          F.col("id").cast("decimal(20,6)").alias("quantity"), F.uuid().alias("note"))


def test_price_join_of_a_hot_sku_is_split(cluster_like):
    usage = hot(cluster_like)
    skus = cluster_like.range(0, 60_000, 100).union(cluster_like.createDataFrame([(7,)], "id bigint"))
    dim = skus.withColumnRenamed("id", "sku").withColumn("base", F.lit(2.0)).withColumn("kind", F.lit("ECON"))
    prices = pricing.price_versions(dim, "sku", "base", [("2020-01-01", None, "1.00")], {"family": "kind"})
    priced = pricing.price_usage(usage, prices, keep=("family",))
    assert "skew=true" in executed(priced) and priced.count() == 60_000


def test_orphans_are_counted_before_the_join(cluster_like):
    child = hot(cluster_like).withColumnRenamed("sku", "fk")
    parent = cluster_like.createDataFrame([(100,)], "pk bigint")
    plan = executed(quality.fk_orphans(child, "fk", parent, "pk"))
    join = plan[plan.index("Join"):]
    assert "partial_count" in join  # the count is below the join
    assert quality.fk_orphans(child, "fk", parent, "pk").filter("fk = 7").first()["rows"] == 59_400


def test_unused_tables_reduce_both_sides(cluster_like):
    t = hot(cluster_like).withColumnRenamed("sku", "table_id")
    plan = executed(lineage.unused_tables(t, t.filter("table_id = 7")))
    assert plan.split("Initial Plan")[0].count("HashAggregate(keys=[table_id") >= 4


def test_latest_takes_map_columns(spark):
    rows = spark.sql("SELECT 1 AS id, 5 AS v, map('a', 1) AS tags UNION ALL SELECT 1, 6, map('b', 2) UNION ALL SELECT 2, 1, NULL")
    got = {r.id: (r.v, r.tags) for r in pricing.latest(rows, "id", ["v"]).collect()}
    assert got == {1: (6, {"b": 2}), 2: (1, None)}


def test_mixed_keeps_null_keys_and_duplicates_of_one_catalog(spark):
    from meterlake.operators import align
    a = spark.createDataFrame([(1, "x"), (1, "y"), (None, "n"), (None, "n")], "event_id bigint, v string")
    b = spark.createDataFrame([(1, "x"), (2, "z"), (None, "m")], "event_id bigint, v string")
    out = align.consolidate({"A": a, "B": b}, align.MIXED, ["event_id"])
    assert sorted((r.event_id or -1, r.v) for r in out.collect()) == [(-1, "m"), (-1, "n"), (-1, "n"), (1, "x"), (1, "y"), (2, "z")]


def test_new_source_columns_are_seen(spark, workdir):
    from meterlake.sources.tables import discover, load
    spark.range(1).write.parquet(f"{workdir}/s/t.parquet")
    assert load(spark, f"{workdir}/s", "t").columns == ["id"]
    spark.range(1).withColumn("extra", F.lit(1)).write.mode("overwrite").parquet(f"{workdir}/s/t.parquet")
    assert load(spark, f"{workdir}/s", "t").columns == ["id", "extra"]
    assert list(discover(spark, workdir)) == ["s.t"]


def test_quantities_keep_their_digits(spark):
    usage = spark.sql("SELECT 1 AS sku, date'2024-01-01' AS usage_date, 0.123456789BD AS quantity")
    prices = spark.sql("SELECT 1 AS sku, timestamp_ntz'2020-01-01' AS price_start_time, CAST(NULL AS timestamp_ntz) AS price_end_time, CAST(2 AS decimal(12,2)) AS price")
    assert str(pricing.price_usage(usage, prices).first()["cost"]).startswith("0.246913578")
