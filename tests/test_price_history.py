"""As-of price join: equal to the interval join, and linear in usage where SKUs have thousands of versions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from meterlake.operators import pricing

PRICES = "sku long, price_start_time timestamp_ntz, price_end_time timestamp_ntz, price decimal(12,2), family string"


def history(rng, skus, versions):
    """Touching intervals, some closed early (a gap), the last one open for most SKUs."""
    from decimal import Decimal
    out = []
    for s in range(skus):
        at = dt.datetime(2020, 1, 1) + dt.timedelta(days=rng.randint(0, 30))
        for v in range(versions):
            nxt = at + dt.timedelta(hours=rng.randint(1, 80))
            end = None if v == versions - 1 and s % 4 else nxt if rng.random() < 0.8 else at + (nxt - at) / 2
            out.append((s, at, end, Decimal(rng.randint(1, 9999)) / 100, f"f{s % 3}"))
            at = nxt
    return out


def rows(df):
    return sorted((tuple(map(str, r)) for r in df.collect()))


@pytest.mark.parametrize("bin_days, rows_per_task", [(32, 10 ** 6), (1, 10 ** 6), (5, 3), (1000, 7)])
def test_equals_the_interval_join(spark, bin_days, rows_per_task):
    rng = random.Random(bin_days)
    prices = spark.createDataFrame(history(rng, 12, 40), PRICES)
    times = [(rng.choice([None, *range(14)]), i, rng.choice([None] + [dt.datetime(2019, 12, 25) + dt.timedelta(hours=rng.randint(0, 3500))] * 20)) for i in range(800)]
    times += [(3, 1000 + i, dt.datetime(2020, 2, 2, 2)) for i in range(200)]  # a hot time of one SKU
    usage = spark.createDataFrame(times, "sku long, id long, at timestamp_ntz").withColumn("quantity", F.lit(2).cast("decimal(20,6)"))
    got = pricing.price_usage_asof(usage, prices, date="at", keep=("family",), bin_days=bin_days, rows_per_task=rows_per_task)
    want = pricing.price_usage(usage, prices, date="at", keep=("family",))
    assert rows(got.select(want.columns)) == rows(want) and want.count() > 400


def test_versions_that_start_together_and_nulls(spark):
    t = lambda d: dt.datetime(2024, 1, d)
    from decimal import Decimal as D
    prices = spark.createDataFrame([(1, t(1), t(5), D(1), "a"), (1, t(1), None, D(2), "b"), (1, t(8), t(9), D(3), "c"), (None, t(1), None, D(9), "x"), (1, None, None, D(9), "x")], PRICES)
    usage = spark.createDataFrame([(1, t(1)), (1, t(7)), (1, t(8)), (1, t(10)), (1, None), (None, t(3)), (2, t(3)), (1, dt.datetime(2023, 12, 31))], "sku long, usage_date timestamp_ntz") \
        .withColumn("quantity", F.lit(1))
    got = pricing.price_usage_asof(usage, prices)
    assert {(r.usage_date.day, r.price) for r in got.collect()} == {(1, D(2)), (7, D(2)), (8, D(3))}
    assert pricing.price_usage_asof(usage.limit(0), prices).count() == 0 == pricing.price_usage_asof(usage, prices.limit(0)).count()


def joined_rows(plan):
    """Largest number of output rows of any operator that ran, by Spark's own metrics."""
    most = 0
    nodes = [plan]
    while nodes:
        p = nodes.pop()
        if p.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            nodes.append(p.executedPlan())
            continue
        if p.getClass().getSimpleName().endswith("QueryStageExec"):
            nodes.append(p.plan())
            continue
        rows_out = p.metrics().get("numOutputRows")
        if rows_out.isDefined():
            most = max(most, rows_out.get().value())
        nodes += [p.children().apply(i) for i in range(p.children().size())]
    return most


def test_thousands_of_versions_stay_linear(spark):
    """20,000 usage rows of one SKU with 5,000 versions: no operator makes more rows than usage and versions together."""
    start = F.lit("2000-01-01").cast("timestamp_ntz")
    day = lambda c: (start + F.make_dt_interval(c)).alias
    prices = spark.range(5000).select(F.lit(1).cast("long").alias("sku"), day(F.col("id").cast("int"))("price_start_time"),
                                      day((F.col("id") + 1).cast("int"))("price_end_time"), F.col("id").cast("decimal(12,2)").alias("price"))
    usage = spark.range(20_000).select(F.lit(1).cast("long").alias("sku"), F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") % 5000).cast("int")).alias("usage_date"),
                                       F.lit(1).cast("decimal(20,6)").alias("quantity"))
    df = pricing.price_usage_asof(usage, prices, rows_per_task=50)
    assert all(r.price == (r.usage_date - dt.date(2000, 1, 1)).days for r in df.collect())
    assert joined_rows(df._jdf.queryExecution().executedPlan()) <= 2 * 25_000
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "price_end_time" not in "".join(line for line in text.splitlines() if "Join" in line)


def test_a_version_is_shuffled_once(spark):
    """A long price list is neither aggregated nor joined by shuffles before the one sorted pass, unless a SKU is hot."""
    prices = spark.range(40_000).select((F.col("id") % 400).alias("sku"), F.timestamp_add("DAY", F.floor(F.col("id") / 400).cast("int"), F.lit("2020-01-01").cast("timestamp_ntz")).alias("price_start_time"),
                                        F.lit(None).cast("timestamp_ntz").alias("price_end_time"), (F.col("id") % 97).cast("decimal(12,2)").alias("price"))
    usage = spark.range(4000).select((F.col("id") % 400).alias("sku"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 90).cast("int")).alias("usage_date"), F.lit(1).alias("quantity"))
    df = pricing.price_usage_asof(usage, prices)
    want = {(s, d): (d * 400 + s) % 97 for s in range(400) for d in range(90)}
    assert all(r.price == want[r.sku, (r.usage_date - dt.date(2020, 1, 1)).days] for r in df.collect())
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "SortMergeJoin" not in text and "ShuffledHashJoin" not in text


def test_the_long_list_is_made_in_many_tasks(spark):
    from meterlake.plans import roles as R
    from meterlake.sources.tables import Tables
    assert R.monthly_prices(Tables(spark, "/root/testdata/sf0.001")).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
