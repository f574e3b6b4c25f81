"""Sync decisions and replay safety (SNK-1..9)."""

import datetime as dt
import os
import subprocess
import sys

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from meterlake.sources import sync


def test_choose_mode_decision_table():
    for has_state in (False, True):
        for force in (False, True):
            for ts in (None, "event_time"):
                got = sync.choose_mode(has_state, force, ts)
                if not has_state or force:
                    assert got == sync.FULL
                elif ts is None:
                    assert got == sync.FULL_FALLBACK
                else:
                    assert got == sync.INCREMENTAL


def test_timestamp_column_order_and_case(spark):
    df = spark.createDataFrame([(1, 2, 3)], "Start_Time int, UPDATED_AT int, x int")
    assert sync.get_timestamp_column(df) == "UPDATED_AT"
    assert sync.get_timestamp_column(spark.createDataFrame([(1,)], "x int")) is None
    assert sync.get_timestamp_column(df, override="start_time") == "Start_Time"


def _ev(spark, rows):
    return spark.createDataFrame([(i, dt.datetime(2024, 1, d, h)) for i, d, h in rows], "id int, ts timestamp_ntz")


def test_late_row_within_mark_is_kept_by_max_mark(spark, workdir):
    # D-1: the mark is the max loaded event time, not the wall clock
    tgt, log = f"{workdir}/t", f"{workdir}/log"
    sync.sync_table(spark, _ev(spark, [(1, 1, 0), (2, 2, 0)]), "s", "e", tgt, log, ts_override="ts")
    src2 = _ev(spark, [(1, 1, 0), (2, 2, 0), (3, 2, 5), (4, 3, 0)])  # row 3 arrives late but is after the mark
    r = sync.sync_table(spark, src2, "s", "e", tgt, log, ts_override="ts")
    assert r.mode == sync.INCREMENTAL and r.rows == 2
    assert sorted(x.id for x in sync.read_target(spark, tgt, log).collect()) == [1, 2, 3, 4]


def test_replay_of_a_batch_does_not_duplicate(spark, workdir):
    # D-5
    tgt, log = f"{workdir}/t", f"{workdir}/log"
    sync.sync_table(spark, _ev(spark, [(1, 1, 0)]), "s", "e", tgt, log, ts_override="ts")
    src = _ev(spark, [(1, 1, 0), (2, 2, 0)])
    r = sync.sync_table(spark, src, "s", "e", tgt, log, ts_override="ts")
    sync.copy_incremental(src, tgt, "ts", r.lo, r.hi)
    sync.copy_incremental(src, tgt, "ts", r.lo, r.hi)
    assert sync.read_target(spark, tgt, log).count() == 2


def test_uncommitted_batch_is_invisible(spark, workdir):
    tgt, log = f"{workdir}/t", f"{workdir}/log"
    sync.sync_table(spark, _ev(spark, [(1, 1, 0)]), "s", "e", tgt, log, ts_override="ts")
    sync.copy_incremental(_ev(spark, [(9, 5, 0)]), tgt, "ts", dt.datetime(2024, 1, 1))
    assert sync.read_target(spark, tgt, log).count() == 1


def test_same_day_date_rows_are_not_lost(spark, workdir):
    # D-2: a DATE sync column reloads whole days >= the mark day
    tgt, log = f"{workdir}/t", f"{workdir}/log"
    d = lambda rows: spark.createDataFrame(rows, "id int, usage_date date")
    day = dt.date(2024, 1, 2)
    sync.sync_table(spark, d([(1, dt.date(2024, 1, 1)), (2, day)]), "s", "u", tgt, log)
    r = sync.sync_table(spark, d([(1, dt.date(2024, 1, 1)), (2, day), (3, day), (4, dt.date(2024, 1, 3))]),
                        "s", "u", tgt, log)
    assert r.mode == sync.INCREMENTAL
    assert sorted(x.id for x in sync.read_target(spark, tgt, log).collect()) == [1, 2, 3, 4]


def test_null_marks_are_reported(spark, workdir):
    # D-3
    tgt, log = f"{workdir}/t", f"{workdir}/log"
    src = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, None)], "id int, ts timestamp_ntz")
    r = sync.sync_table(spark, src, "s", "e", tgt, log, ts_override="ts")
    assert r.null_marks == 1 and r.rows == 2


def test_schema_growth_and_state(spark, workdir):
    tgt, log = f"{workdir}/t", f"{workdir}/log"
    sync.sync_table(spark, _ev(spark, [(1, 1, 0)]), "s", "e", tgt, log, ts_override="ts")
    src = _ev(spark, [(1, 1, 0), (2, 2, 0)]).withColumn("extra", F.lit("x"))
    sync.sync_table(spark, src, "s", "e", tgt, log, ts_override="ts")
    rows = {r.id: r.extra for r in sync.read_target(spark, tgt, log).collect()}
    assert rows == {1: None, 2: "x"}
    st_ = sync.sync_state(spark, log).collect()
    assert len(st_) == 1 and st_[0].last_sync_mode == "INCREMENTAL"
    assert st_[0].last_sync_timestamp == dt.datetime(2024, 1, 2)


def test_summary_counts_full_and_fallback(spark, workdir):
    log = f"{workdir}/log"
    nat = spark.createDataFrame([(1,)], "n int")
    sync.sync_table(spark, nat, "s", "n", f"{workdir}/n", log)
    sync.sync_table(spark, nat, "s", "n", f"{workdir}/n", log)
    r = sync.sync_summary(sync.read_log(spark, log)).first()
    assert (r.full_loads, r.incremental_loads) == (2, 0)


def test_compact_keeps_content(spark, workdir):
    df = spark.range(1000).withColumn("v", F.col("id") * 2)
    df.repartition(20).write.parquet(f"{workdir}/in")
    n = sync.compact(spark, f"{workdir}/in", f"{workdir}/out", target_file_mb=64)
    out = spark.read.parquet(f"{workdir}/out")
    assert n == 1 and out.count() == 1000
    assert out.exceptAll(df).count() == 0


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(min_value=1, max_value=27), min_size=1, max_size=3, unique=True))
def test_incremental_splits_equal_one_full_load(spark, cuts):
    # property: runs ending at the same mark = one full load, for any split of the rows
    from meterlake.session import fresh_dir
    wd = fresh_dir(spark, "prop")
    rows = [(i, 1 + i % 28, i % 24) for i in range(60)]
    full = _ev(spark, rows)
    tgt, log = f"{wd}/t", f"{wd}/log"
    for c in sorted(cuts):
        sync.sync_table(spark, full.filter(F.dayofmonth("ts") <= c), "s", "e", tgt, log, ts_override="ts")
    sync.sync_table(spark, full, "s", "e", tgt, log, ts_override="ts")
    got = sync.read_target(spark, tgt, log)
    assert got.count() == 60 and got.exceptAll(full).count() == 0


def test_lookback_picks_up_late_rows_once(spark, workdir):
    # D-1 with lookback: a row older than the mark that arrives later is copied once
    tgt, log = f"{workdir}/t", f"{workdir}/log"
    sync.sync_table(spark, _ev(spark, [(1, 1, 0), (2, 3, 0)]), "s", "e", tgt, log, ts_override="ts")
    late = _ev(spark, [(1, 1, 0), (2, 3, 0), (3, 2, 0), (4, 4, 0)])  # id 3 is late (day 2 < mark day 3)
    for _ in range(2):  # the second run re-reads the span and must add nothing
        sync.sync_table(spark, late, "s", "e", tgt, log, ts_override="ts",
                        lookback=dt.timedelta(days=5), key=["id"])
    assert sorted(x.id for x in sync.read_target(spark, tgt, log).collect()) == [1, 2, 3, 4]


def test_state_from_snapshot_plus_recent_commits(spark, workdir):
    tgt, log = f"{workdir}/t", f"{workdir}/log"
    src = _ev(spark, [(1, 1, 0)])
    sync.sync_table(spark, src, "s", "e", tgt, log, ts_override="ts")
    sync.sync_table(spark, spark.createDataFrame([(1,)], "n int"), "s", "n", f"{workdir}/n", log)
    gen = sync.snapshot_state(spark, log)
    assert gen is not None
    r = sync.sync_table(spark, _ev(spark, [(1, 1, 0), (2, 2, 0)]), "s", "e", tgt, log, ts_override="ts")
    assert r.mode == sync.INCREMENTAL and r.rows == 1  # the mark came from the snapshot
    st_ = {x.table_name: x for x in sync.sync_state(spark, log).collect()}
    assert st_["e"].last_sync_timestamp == dt.datetime(2024, 1, 2) and st_["e"].last_sync_mode == "INCREMENTAL"
    assert st_["n"].last_sync_mode == "FULL"
    assert sync.read_log(spark, log).filter("sync_status = 'SUCCESS'").count() == 3


def test_empty_full_load_is_readable(spark, workdir):
    tgt, log = f"{workdir}/t", f"{workdir}/log"
    r = sync.sync_table(spark, _ev(spark, [(1, 1, 0)]).limit(0), "s", "e", tgt, log, ts_override="ts")
    assert r.mode == sync.FULL and r.rows == 0
    out = sync.read_target(spark, tgt, log)
    assert out.count() == 0 and out.columns == ["id", "ts"]
    r2 = sync.sync_table(spark, _ev(spark, [(1, 1, 0), (2, 2, 0)]), "s", "e", tgt, log, ts_override="ts")
    assert r2.mode == sync.INCREMENTAL and sync.read_target(spark, tgt, log).count() == 2


def test_empty_full_load_with_date_column(spark, workdir):
    tgt, log = f"{workdir}/t", f"{workdir}/log"
    d = lambda rows: spark.createDataFrame(rows, "id int, usage_date date")
    r = sync.sync_table(spark, d([]), "s", "u", tgt, log)
    assert r.mode == sync.FULL and r.rows == 0
    out = sync.read_target(spark, tgt, log)
    assert out.count() == 0 and set(out.columns) == {"id", "usage_date"}
    sync.sync_table(spark, d([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2))]), "s", "u", tgt, log)
    got = sync.read_target(spark, tgt, log)
    assert sorted(x.id for x in got.collect()) == [1, 2]
    assert got.schema["usage_date"].dataType.simpleString() == "date"


def test_failed_full_load_keeps_the_old_content(spark, workdir):
    tgt, log = f"{workdir}/t", f"{workdir}/log"
    sync.sync_table(spark, _ev(spark, [(i, 1 + i, 0) for i in range(10)]), "s", "e", tgt, log, ts_override="ts")
    broken = _ev(spark, [(i, 1 + i, 0) for i in range(12)]).withColumn(
        "id", F.when(F.col("id") == 11, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("id")))
    with pytest.raises(PySparkException):
        sync.sync_table(spark, broken, "s", "e", tgt, log, force=True, ts_override="ts")
    assert sync.read_target(spark, tgt, log).count() == 10
    r = sync.sync_table(spark, _ev(spark, [(i, 1 + i, 0) for i in range(12)]), "s", "e", tgt, log, ts_override="ts")
    assert (r.mode, r.rows) == (sync.INCREMENTAL, 2) and sync.read_target(spark, tgt, log).count() == 12
    assert all(f.startswith("full-") for f in sync.unused_folders(spark, tgt, log))


def test_mark_never_moves_back(spark, workdir):
    tgt, log = f"{workdir}/t", f"{workdir}/log"
    run = lambda rows: sync.sync_table(spark, _ev(spark, rows), "s", "e", tgt, log, ts_override="ts",
                                       lookback=dt.timedelta(days=5), key=["id"])
    run([(1, 1, 0), (2, 4, 0)])
    r = run([(3, 2, 0)])  # only a late row
    assert r.rows == 1 and r.hi == dt.datetime(2024, 1, 4)
    assert run([(1, 1, 0), (2, 4, 0), (3, 2, 0)]).rows == 0
    assert sorted(x.id for x in sync.read_target(spark, tgt, log).collect()) == [1, 2, 3]


def test_column_of_null_marks_is_copied_once(spark, workdir):
    tgt, log = f"{workdir}/t", f"{workdir}/log"
    src = spark.createDataFrame([(i, None) for i in range(5)], "id int, ts timestamp_ntz")
    assert [sync.sync_table(spark, src, "s", "e", tgt, log, ts_override="ts").rows for _ in range(3)] == [5, 0, 0]
    later = src.unionByName(_ev(spark, [(9, 1, 0)]))
    assert sync.sync_table(spark, later, "s", "e", tgt, log, ts_override="ts").rows == 1
    assert sync.read_target(spark, tgt, log).count() == 6


def test_a_batch_of_another_table_commits_nothing(spark, workdir):
    log = f"{workdir}/log"
    sync.sync_table(spark, _ev(spark, [(1, 1, 0)]), "s", "a", f"{workdir}/a", log, ts_override="ts")
    sync.copy_full(_ev(spark, [(7, 1, 0)]), f"{workdir}/b", "ts")
    with pytest.raises(ValueError):
        sync.read_target(spark, f"{workdir}/b", log)
    d = spark.createDataFrame([(1, dt.date(2024, 1, 1))], "id int, usage_date date")
    sync.sync_table(spark, d, "s", "u", f"{workdir}/u", log)
    sync.copy_incremental(spark.createDataFrame([(2, dt.date(2024, 1, 5))], "id int, usage_date date"), f"{workdir}/u", "usage_date", None)
    assert sync.read_target(spark, f"{workdir}/u", log).count() == 1


def test_many_batches_compact_into_sorted_files(spark, workdir):
    tgt, log = f"{workdir}/t", f"{workdir}/log"
    for last in range(2, 9):
        sync.sync_table(spark, _ev(spark, [(i, i, 0) for i in range(1, last)]), "s", "e", tgt, log, ts_override="ts")
    before = sync.read_target(spark, tgt, log)
    rows, files = sorted(map(tuple, before.collect())), len(before.inputFiles())
    assert sync.compact_target(spark, tgt, log) == 1
    after = sync.read_target(spark, tgt, log)
    assert sorted(map(tuple, after.collect())) == rows and len(after.inputFiles()) < files
    assert [r.id for r in after.collect()] == sorted(r.id for r in after.collect())
    assert sync.compact_target(spark, tgt, log) == 0
    r = sync.sync_table(spark, _ev(spark, [(i, i, 0) for i in range(1, 12)]), "s", "e", tgt, log, ts_override="ts")
    assert r.mode == sync.INCREMENTAL and r.rows == 4 and sync.read_target(spark, tgt, log).count() == 11


def test_full_load_of_many_small_files_is_compacted(spark, workdir):
    tgt, log = f"{workdir}/t", f"{workdir}/log"
    sync.sync_table(spark, _ev(spark, [(i, 1 + i % 28, 0) for i in range(100)]).repartition(12), "s", "e", tgt, log, ts_override="ts")
    out = sync.read_target(spark, tgt, log)
    assert len(out.inputFiles()) == 1 and out.count() == 100
    assert sync.sync_state(spark, log).first().last_sync_mode == sync.FULL
    assert sync.sync_summary(sync.read_log(spark, log)).first().full_loads == 1


def test_dates_are_not_in_every_file(spark, workdir):
    rows = [(i, dt.date(2024, 1, 1) + dt.timedelta(days=i % 60)) for i in range(600)]
    folder = sync.copy_full(spark.createDataFrame(rows, "id int, usage_date date").repartition(8), f"{workdir}/t", "usage_date")
    assert len(spark.read.parquet(f"{workdir}/t/{folder}").inputFiles()) <= 8


def test_a_failing_table_does_not_stop_the_others(spark, workdir):
    bad = spark.range(3).select(F.raise_error(F.lit("broken")).cast("int").alias("x"))
    good = _ev(spark, [(1, 1, 0)]).withColumnRenamed("ts", "event_time")
    for workers in (1, 2):
        root = f"{workdir}/{workers}"
        with pytest.raises(sync.SyncFailed) as e:
            sync.sync_all(spark, {"s.a": bad, "s.b": good, "s.c": bad, "s.d": good}, root, f"{root}/log", parallelism=workers)
        assert [r.status for r in e.value.results] == ["FAILED", "SUCCESS", "FAILED", "SUCCESS"]
        assert sync.read_target(spark, f"{root}/s/d", f"{root}/log").count() == 1


def test_errors_of_the_log_are_not_taken_for_an_empty_log(spark, workdir):
    spark.createDataFrame([("x",)], "a string").write.text(f"{workdir}/log/commits/day=2024-01-01/commit-1")
    with pytest.raises(Exception, match="not a Parquet file|FAILED_READ_FILE"):
        sync.sync_state(spark, f"{workdir}/log").collect()


ZONE_SCRIPT = """
import datetime as dt, sys, tempfile
sys.path.insert(0, {repo!r})
from meterlake.session import build_session
from meterlake.sources import sync
spark = build_session("local[2]", shuffle_partitions=2)
root = tempfile.mkdtemp(prefix="meterlake-zone-")
rows = "SELECT id, timestamp'2024-03-10 00:00:00' + make_interval(0, 0, 0, 0, id * 7, 0, 0) AS event_time FROM range({{}})"
got = [sync.sync_table(spark, spark.sql(rows.format(n)), "s", "e", root + "/t", root + "/log").rows for n in (5, 12, 12)]
print("RESULT", got, sync.read_target(spark, root + "/t", root + "/log").count())
"""


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Tokyo"])
def test_marks_do_not_depend_on_the_host_zone(zone):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    p = subprocess.run([sys.executable, "-c", ZONE_SCRIPT.format(repo=repo)], capture_output=True, text=True,
                       timeout=600, env=os.environ | {"TZ": zone})
    assert "RESULT [5, 7, 0] 12" in p.stdout, p.stdout[-500:] + p.stderr[-2000:]
