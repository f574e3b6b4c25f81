"""Rolling sums over dense histories: equal to one window per key, with bounded partitions."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from meterlake.operators import attribution


def load(spark, hours=20_000):
    """99 % of the rows are one resource's, hour by hour over two years; before 1970 too; ties and a NULL time."""
    at = F.timestamp_micros((F.col("id") - 3000) * 3_600_000_000)
    hot = spark.range(hours).select(F.lit("hot").alias("k"), at.alias("ts"), (F.col("id") % 7).alias("v"))
    other = spark.range(200).select(F.concat(F.lit("k"), F.col("id") % 9).alias("k"), F.timestamp_micros((F.col("id") % 50) * 5_000_000_000).alias("ts"), F.col("id").alias("v"))
    return hot.union(other).union(spark.sql("SELECT 'hot', CAST(NULL AS timestamp), 5L UNION ALL SELECT CAST(NULL AS string), timestamp'2024-01-01', 3L"))


@pytest.mark.parametrize("width, chunk", [(24, None), (24, 24), (24, 7), (1, 500), (720, 100)])
def test_equals_a_window_per_key(spark, width, chunk):
    df = load(spark, 2000)
    got = attribution.rolling_sum(df, "k", "ts", "v", dt.timedelta(hours=width), chunk=chunk and dt.timedelta(hours=chunk))
    frame = Window.partitionBy("k").orderBy(F.unix_micros("ts")).rangeBetween(-(width * 3_600_000_000 - 1), 0)
    want = df.filter("ts IS NOT NULL").withColumn("rolling", F.sum("v").over(frame))
    assert got.columns == want.columns and got.exceptAll(want).count() == 0 == want.exceptAll(got).count()


def test_one_resource_is_many_groups(spark):
    """No window partition holds more than a chunk and the width before it."""
    df = attribution.rolling_sum(load(spark), "k", "ts", "v", dt.timedelta(hours=24))
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.getClass().getSimpleName() != "Window":
        plan = plan.children().apply(0)
    assert "k#" in plan.partitionSpec().mkString() and "__chunk#" in plan.partitionSpec().mkString()
    t = F.unix_micros("ts")
    chunks = load(spark).filter("ts IS NOT NULL").select("k", F.explode(F.sequence(F.floor(t / (192 * 3.6e9)), F.floor((t + 24 * 3.6e9 - 1) / (192 * 3.6e9)))).alias("c"))
    assert chunks.groupBy("k", "c").count().agg(F.max("count")).first()[0] <= 192 + 24
    assert df.count() == 20_201
