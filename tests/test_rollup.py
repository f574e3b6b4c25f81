"""Daily rollups: late rows, reloaded and emptied days, refreshes that broke off, merged generations."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterlake.operators import rollup

DAY = lambda d: dt.date(2024, 1, d)


@pytest.fixture
def SUMS(spark):  # noqa: N802  columns need a session
    return {"cost": F.sum("cost"), "n": F.count(F.lit(1))}


def facts(spark, rows):
    return spark.createDataFrame([(DAY(d) if d else None, k, c) for d, k, c in rows], "day0 date, k string, cost long")


def got(spark, path, as_of=31, days=30):
    return {(r.day.day, r.k): (r.cost, r.n) for r in rollup.read(spark, path, DAY(as_of), days).collect()}


def test_only_touched_days_are_aggregated_anew(spark, workdir, SUMS):
    rows = [(1, "a", 5), (1, "a", 6), (1, None, 1), (2, "a", 7), (None, "a", 9)]
    assert rollup.refresh(facts(spark, rows), "day0", ["k"], SUMS, workdir) == 1
    assert got(spark, workdir) == {(1, "a"): (11, 2), (1, None): (1, 1), (2, "a"): (7, 1)}
    # a late row of day 1, and a change of day 2 that nobody reports: only day 1 follows
    rollup.refresh(facts(spark, [*rows, (1, "b", 3), (2, "a", 100)]), "day0", ["k"], SUMS, workdir, [DAY(1)])
    assert got(spark, workdir) == {(1, "a"): (11, 2), (1, None): (1, 1), (1, "b"): (3, 1), (2, "a"): (7, 1)}
    # a day loaded again counts once, a day without rows any more is empty, no days change nothing
    rollup.refresh(facts(spark, [(1, "a", 5)]), "day0", ["k"], SUMS, workdir, [DAY(1), DAY(2), DAY(3)])
    rollup.refresh(facts(spark, [(1, "a", 5)]), "day0", ["k"], SUMS, workdir, [DAY(1)])
    assert rollup.refresh(facts(spark, []), "day0", ["k"], SUMS, workdir, []) is None
    assert got(spark, workdir) == {(1, "a"): (5, 1)}


def test_window_and_merge(spark, workdir, SUMS):
    for d in (1, 2, 5, 9):
        rollup.refresh(facts(spark, [(d, "a", d)]), "day0", ["k"], SUMS, workdir, [DAY(d)])
    rollup.refresh(facts(spark, [(2, "a", 20)]), "day0", ["k"], SUMS, workdir, [DAY(2), DAY(9)])
    want = {(1, "a"): (1, 1), (2, "a"): (20, 1), (5, "a"): (5, 1)}
    assert got(spark, workdir) == want
    assert got(spark, workdir, as_of=5, days=3) == {(2, "a"): (20, 1), (5, "a"): (5, 1)}  # both ends are in
    assert rollup.merge(spark, workdir) == 6 and got(spark, workdir) == want
    assert {r.gen for r in spark.read.parquet(f"{workdir}/data").filter("gen = 6").collect()} == {6}


def test_a_refresh_that_broke_off_is_not_read(spark, workdir, SUMS):
    rollup.refresh(facts(spark, [(1, "a", 5)]), "day0", ["k"], SUMS, workdir)
    half = facts(spark, [(1, "a", 99)]).select(F.col("day0").alias("day"), "k", "cost", F.lit(1).cast("long").alias("n"))
    half.write.parquet(f"{workdir}/data/gen={2:010d}")  # its days were never written
    assert got(spark, workdir) == {(1, "a"): (5, 1)}
    assert rollup.refresh(facts(spark, [(1, "a", 6)]), "day0", ["k"], SUMS, workdir, [DAY(1)]) == 2
    assert got(spark, workdir) == {(1, "a"): (6, 1)}
    with pytest.raises(ValueError, match="nothing was rolled up"):
        rollup.read(spark, f"{workdir}/none", DAY(1), 1)


def test_days_reach_the_scan(spark, workdir, SUMS):
    facts(spark, [(d, "a", d) for d in range(1, 29)]).write.parquet(f"{workdir}/facts")
    rollup.refresh(spark.read.parquet(f"{workdir}/facts"), "day0", ["k"], SUMS, f"{workdir}/r")
    plan = rollup.read(spark, f"{workdir}/r", DAY(9), 7)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("GreaterThanOrEqual(day,2024-01-02)") >= 2 and plan.count("LessThanOrEqual(day,2024-01-09)") >= 2


def test_explorer_windows_come_from_one_read_of_the_rollups(spark, monkeypatch):
    from meterlake.plans import catalog

    read, real = [], rollup.read
    monkeypatch.setattr(rollup, "read", lambda spark, path, as_of, days: (read.append((path.rsplit("/", 1)[1], days)), real(spark, path, as_of, days))[1])
    catalog.explorer_from_rollup(spark, "/root/testdata/sf0.001")
    assert sorted(read) == [("cost", 90), ("reads", 90), ("writes", 90)]


def test_a_window_holds_the_shorter_ones(spark, workdir):
    facts = spark.createDataFrame([(DAY(d), "a", d) for d in range(1, 20)], "day date, k string, v int")
    rollup.refresh(facts, "day", ["k"], {"v": F.sum("v")}, f"{workdir}/w")
    longest = rollup.read(spark, f"{workdir}/w", DAY(15), 12)
    for days in (0, 3, 12):
        direct = rollup.read(spark, f"{workdir}/w", DAY(15), days)
        assert sorted(rollup.within(longest, DAY(15), days).collect()) == sorted(direct.collect())
