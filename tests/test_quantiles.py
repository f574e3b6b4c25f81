"""Exact distributed ranks and quantiles against numpy / Spark's own window functions."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from meterlake.functions import quantiles


@pytest.fixture
def skewed(spark):
    rng = np.random.default_rng(7)
    rows = [(0, float(v)) for v in rng.integers(0, 50, 900)]           # hot key, many ties
    rows += [(k, float(v)) for k in range(1, 6) for v in rng.normal(10, 3, 40).round(3)]
    rows += [(6, 1.5)]                                                  # single-row key
    rows += [(7, float(v)) for v in (-3.0, -0.001, 0.0, 0.0, 1e-9, 2.0, 2.0, 1e12)]  # signs, zero, wide range
    return spark.createDataFrame(rows, "k bigint, v double"), rows


def test_quantiles_match_numpy(spark, skewed):
    df, rows = skewed
    got = {r.k: (r.p50, r.p95, r.p99) for r in quantiles.quantiles(df, "v", ["k"], (0.5, 0.95, 0.99), partitions=5).collect()}
    for k in {r[0] for r in rows}:
        vals = np.array([v for kk, v in rows if kk == k])
        exp = np.quantile(vals, [0.5, 0.95, 0.99])
        assert got[k] == pytest.approx(tuple(exp), rel=1e-12, abs=1e-9)


def test_percent_rank_matches_window(spark, skewed):
    df, _ = skewed
    ours = quantiles.with_percent_rank(df, "v", "score", ["k"], partitions=5)
    ref = df.withColumn("score", F.percent_rank().over(Window.partitionBy("k").orderBy("v")))
    assert ours.exceptAll(ref).count() == 0 and ref.exceptAll(ours).count() == 0


def test_both_ways_agree(spark, skewed):
    df, _ = skewed
    one, many = (quantiles.value_ranks(df, "v", ["k"], partitions=p) for p in (None, 7))
    assert "rangepartitioning" not in one._jdf.queryExecution().executedPlan().toString()
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0


def test_global_median(spark):
    df = spark.createDataFrame([(float(x),) for x in [5, 1, 3, 2, 4, 4]], "v double")
    assert quantiles.exact_quantile(df, "v", 0.5) == pytest.approx(3.5)


def test_latency_exact_and_approximate(spark, skewed):
    from meterlake.operators.attribution import latency
    df, _ = skewed
    ex = {r.k: (r.p50, r.p95) for r in latency(df, "v", "k", (0.5, 0.95)).collect()}
    ap = {r.k: (r.p50, r.p95) for r in latency(df, "v", "k", (0.5, 0.95), exact=False).collect()}
    assert set(ex) == set(ap)
    for k in ex:  # the sketch returns an observed value near the exact (interpolated) quantile
        assert abs(ap[k][0] - ex[k][0]) <= 0.05 * max(1.0, abs(ex[k][0])) + 1.0


def test_narrow_values_are_split_evenly(spark):
    """200,000 distinct values within 0.2 % of each other, of one key with most of the rows: no range holds much more than its share."""
    from meterlake.session import fresh_dir
    import os
    df = spark.range(0, 210_000, 1, 6).select(
        F.when(F.col("id") < 200_000, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        F.when(F.col("id") < 200_000, 1000 + F.col("id") / 100_000).otherwise(F.col("id") % 7).alias("v"))
    r = quantiles.value_ranks(df, "v", ["k"], partitions=40)
    hot = r.filter("k = 'hot'").select((F.col("below") == F.round((F.col("v") - 1000) * 100_000)).alias("ok"), "n", "cnt")
    assert hot.filter("not ok or n <> 200000 or cnt <> 1").count() == 0 and hot.count() == 200_000
    newest = max((p for p in os.scandir(os.path.dirname(fresh_dir(spark, "x"))) if p.name.startswith("value-ranges")), key=lambda p: p.stat().st_mtime)
    sizes = [x["n"] for x in spark.read.parquet(newest.path).groupBy("k", "__b").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(sizes) < 3 * 200_000 / 40 and len(sizes) > 40
    q = quantiles.quantiles(df, "v", ["k"], (0.5, 0.99), partitions=40).filter("k = 'hot'").first()
    assert (q.p50, q.p99) == pytest.approx((1000.999995, 1001.9799901), rel=1e-12)


def test_null_keys_and_values(spark):
    rows = [(None, 1.0), (None, 3.0), (None, None), ("a", float("nan")), ("a", 2.0), ("b", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    assert {r.k: r.p50 for r in quantiles.quantiles(df, "v", ["k"]).collect()} == {None: 2.0, "a": 2.0}
    ranked = {(r.k, r.v): r.score for r in quantiles.with_percent_rank(df.filter("not isnan(v) or v is null"), "v", keys=["k"]).collect()}
    assert ranked == {(None, 1.0): 0.0, (None, 3.0): 1.0, (None, None): None, ("a", 2.0): 0.0, ("b", None): None}
    assert quantiles.quantiles(df.limit(0), "v", ["k"]).collect() == []
