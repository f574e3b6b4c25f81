"""Type changes, repeated snapshots, many runs, compaction and streams in the sync log."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterlake.sources import schemas, sync
from meterlake.streaming import stream_into_sync


def paths(workdir):
    return f"{workdir}/t", f"{workdir}/log"


def ev(spark, ids, kind="int", day=1, **more):
    df = spark.createDataFrame([(i, dt.datetime(2024, 1, day, i % 24)) for i in ids], "id int, ts timestamp_ntz")
    return df.select(F.col("id").cast(kind).alias("id"), "ts", *[F.lit(v).alias(k) for k, v in more.items()])


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


S = lambda ddl: StructType.fromDDL(ddl)


@pytest.mark.parametrize("a, b, want", [
    ("a int", "a bigint", "a bigint"), ("a bigint", "a smallint", "a bigint"), ("a float", "a double", "a double"), ("a int", "a double", "a double"),
    ("a decimal(10,2)", "a decimal(8,4)", "a decimal(12,4)"), ("A int, b string", "B string, c date", "A int, b string, c date"),
    ("s struct<x:int>", "s struct<X:bigint,y:string>", "s struct<x:bigint,y:string>"), ("a array<int>", "a array<bigint>", "a array<bigint>"),
    ("m map<string,int>", "m map<string,bigint>", "m map<string,bigint>")])
def test_schemas_widen(spark, a, b, want):
    assert schemas.merged(S(a), S(b)).simpleString() == S(want).simpleString()


@pytest.mark.parametrize("a, b", [("a int", "a string"), ("a bigint", "a double"), ("a date", "a timestamp"), ("a decimal(38,0)", "a decimal(10,5)"),
                                  ("s struct<x:int>", "s struct<x:string>"), ("a array<int>", "a int"), ("m map<int,int>", "m map<string,int>")])
def test_schemas_that_conflict(spark, a, b):
    with pytest.raises(schemas.SchemaConflict):
        schemas.merged(S(a), S(b))


def test_a_wider_type_is_read_in_old_folders_too(spark, workdir):
    tgt, log = paths(workdir)
    nested = lambda df, k: df.withColumn("s", F.struct(F.col("id").cast(k).alias("x"))).withColumn("l", F.array(F.col("id").cast(k)))
    sync.sync_table(spark, nested(ev(spark, [1, 2]), "int"), "s", "e", tgt, log, ts_override="ts")
    sync.sync_table(spark, nested(ev(spark, [3, 4], "bigint", 2), "bigint"), "s", "e", tgt, log, ts_override="ts")
    sync.sync_table(spark, nested(ev(spark, [5], "smallint", 3), "int"), "s", "e", tgt, log, ts_override="ts")  # narrower again: kept wide
    got = sync.read_target(spark, tgt, log)
    assert got.schema["id"].dataType.simpleString() == "bigint" and ids(got) == [1, 2, 3, 4, 5]
    assert sorted((r.s.x, r.l) for r in got.collect()) == [(i, [i]) for i in range(1, 6)]
    assert sync.compact_target(spark, tgt, log) == 1 and ids(sync.read_target(spark, tgt, log)) == [1, 2, 3, 4, 5]


def test_a_type_that_does_not_fit_is_refused_before_the_write(spark, workdir):
    tgt, log = paths(workdir)
    sync.sync_table(spark, ev(spark, [1]), "s", "e", tgt, log, ts_override="ts")
    before = sync.unused_folders(spark, tgt, log)
    with pytest.raises(schemas.SchemaConflict, match="id: int against string"):
        sync.sync_table(spark, ev(spark, [1, 2], "string", 2), "s", "e", tgt, log, ts_override="ts")
    assert sync.unused_folders(spark, tgt, log) == before
    assert ids(sync.read_target(spark, tgt, log)) == [1]
    last = sync.read_log(spark, log).orderBy(F.desc("seq")).first()
    assert (last.sync_status, last.error) == (sync.FAILED, "SchemaConflict")
    sync.sync_table(spark, ev(spark, [3], day=3), "s", "e", tgt, log, ts_override="ts")
    assert ids(sync.read_target(spark, tgt, log)) == [1, 3]


def test_snapshot_without_a_commit_since(spark, workdir):
    tgt, log = paths(workdir)
    assert sync.snapshot_state(spark, log) is None
    sync.sync_table(spark, ev(spark, [1]), "s", "e", tgt, log, ts_override="ts")
    first = sync.snapshot_state(spark, log)
    assert sync.snapshot_state(spark, log) == first
    # a snapshot that broke off is not read, and written again
    sync.sync_table(spark, ev(spark, [2], day=2), "s", "e", tgt, log, ts_override="ts")
    top = sync.sync_state(spark, log).count() and sync._current(spark, log).agg(F.max("seq")).first()[0]
    spark.range(1).write.parquet(f"{log}/snapshots/gen={top:020d}/_temporary/0")
    assert sync._newest_snapshot(spark, log) == first and sync.snapshot_state(spark, log) == top
    assert ids(sync.read_target(spark, tgt, log)) == [1, 2]


def test_thirty_runs_of_a_date_target(spark, workdir):
    """Each run reloads its last day: two scans at most, a bounded list of folders, no row twice."""
    tgt, log = paths(workdir)
    rows = [(i, dt.date(2024, 1, 1) + dt.timedelta(days=i // 3)) for i in range(90)]
    most = 0
    for run in range(1, 31):
        r = sync.sync_table(spark, spark.createDataFrame(rows[:run * 3 - 1] + [(1000, None)], "id int, usage_date date").coalesce(1), "s", "u", tgt, log, max_folders=6)
        most = max(most, len(sync._target_row(spark, tgt, log)["live"]))
    assert most <= 7 and r.mode == sync.INCREMENTAL
    got = sync.read_target(spark, tgt, log)
    assert ids(got) == [*range(89), 1000]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Relation") <= 2


def test_a_compaction_that_fails_leaves_the_load_committed(spark, workdir, monkeypatch):
    tgt, log = paths(workdir)

    def broken(*a, **k):
        raise OSError("disk full")

    with monkeypatch.context() as m:
        m.setattr(sync, "compact_target", broken)
        r = sync.sync_table(spark, ev(spark, range(40)).repartition(9), "s", "e", tgt, log, ts_override="ts")
    assert r.status == sync.SUCCESS and r.rows == 40 and ids(sync.read_target(spark, tgt, log)) == list(range(40))
    assert [(x.sync_status, x.error) for x in sync.read_log(spark, log).orderBy("seq").collect()] == [(sync.SUCCESS, None), (sync.NOT_COMPACTED, "OSError")]
    assert sync.sync_table(spark, ev(spark, [50], day=2), "s", "e", tgt, log, ts_override="ts").mode == sync.INCREMENTAL


def test_folders_of_large_files_are_not_rewritten(spark, workdir):
    tgt, log = paths(workdir)
    wide = ev(spark, range(3000)).withColumn("pad", F.sha2(F.col("id").cast("string"), 512)).coalesce(1)
    sync.sync_table(spark, wide, "s", "e", tgt, log, ts_override="ts")
    for i in (2, 3, 4):
        sync.sync_table(spark, ev(spark, [10_000 + i], day=i, pad="x"), "s", "e", tgt, log, ts_override="ts")
    large = sync._target_row(spark, tgt, log)["live"][0]["folder"]
    assert sync.compact_target(spark, tgt, log, file_mb=0.2) == 1
    live = [x["folder"] for x in sync._target_row(spark, tgt, log)["live"]]
    assert live[0] == large and len(live) == 2 and sync.read_target(spark, tgt, log).count() == 3003


# ---- streams ---------------------------------------------------------------------------------
def stream(spark, workdir, tgt, log, **more):
    source = spark.readStream.schema("id int, ts timestamp").parquet(f"{workdir}/in")
    stream_into_sync(spark, source, "s", "e", tgt, log, f"{workdir}/ckpt", "ts", **more)


def arrive(spark, workdir, numbers, day=1):
    ev(spark, numbers, day=day).withColumn("ts", F.col("ts").cast("timestamp")).write.mode("append").parquet(f"{workdir}/in")


def test_streamed_rows_are_in_the_target(spark, workdir):
    tgt, log = paths(workdir)
    arrive(spark, workdir, [1, 2])
    stream(spark, workdir, tgt, log)
    stream(spark, workdir, tgt, log)  # nothing new
    arrive(spark, workdir, [3], 2)
    stream(spark, workdir, tgt, log)
    assert ids(sync.read_target(spark, tgt, log)) == [1, 2, 3]
    assert sync.sync_state(spark, log).first().last_sync_timestamp == dt.datetime(2024, 1, 2, 3)
    # a batch sync of the same table goes on from the stream's mark, and the stream's epochs survive it
    r = sync.sync_table(spark, ev(spark, [3, 4], day=2).withColumn("ts", F.col("ts").cast("timestamp")), "s", "e", tgt, log, ts_override="ts")
    arrive(spark, workdir, [5], 3)
    stream(spark, workdir, tgt, log)
    assert r.rows == 1 and ids(sync.read_target(spark, tgt, log)) == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("when", ["before the log row", "after the log row"])
def test_a_stream_killed_at_its_commit_resumes(spark, workdir, monkeypatch, when):
    """The epoch is run again: written anew where its log row is missing, left out where it is there."""
    tgt, log = paths(workdir)
    arrive(spark, workdir, [1, 2])
    stream(spark, workdir, tgt, log)
    arrive(spark, workdir, [3, 4], 2)
    commit = sync.log_sync

    def killed(*a, **k):
        if when == "after the log row":
            commit(*a, **k)
        raise OSError("killed")

    with monkeypatch.context() as m:
        m.setattr(sync, "log_sync", killed)
        with pytest.raises(Exception):
            stream(spark, workdir, tgt, log)
    assert ids(sync.read_target(spark, tgt, log)) == ([1, 2] if when == "before the log row" else [1, 2, 3, 4])
    stream(spark, workdir, tgt, log)
    arrive(spark, workdir, [5], 3)
    stream(spark, workdir, tgt, log)
    assert ids(sync.read_target(spark, tgt, log)) == [1, 2, 3, 4, 5]


def test_rows_that_come_again_are_dropped_within_the_watermark(spark, workdir):
    tgt, log = paths(workdir)
    for numbers, day in (([1, 2, 2], 1), ([2, 3], 1), ([4], 9), ([5], 1)):  # the last one is older than the watermark
        arrive(spark, workdir, numbers, day)
        stream(spark, workdir, tgt, log, key=["id"], lateness="3 days")
    assert ids(sync.read_target(spark, tgt, log)) == [1, 2, 3, 4]
    with pytest.raises(ValueError, match="watermark"):
        stream(spark, workdir, tgt, log, key=["id"])


def test_an_epoch_is_committed_once(spark, workdir):
    tgt, log = paths(workdir)
    assert sync.append_epoch(spark, ev(spark, [1]), "s", "e", tgt, log, "q", 0, "ts")
    assert not sync.append_epoch(spark, ev(spark, [1]), "s", "e", tgt, log, "q", 0, "ts")
    assert sync.append_epoch(spark, ev(spark, [2]), "s", "e", tgt, log, "other", 0, "ts")
    assert not sync.append_epoch(spark, ev(spark, []), "s", "e", tgt, log, "q", 1, "ts")
    sync.compact_target(spark, tgt, log)
    assert not sync.append_epoch(spark, ev(spark, [1]), "s", "e", tgt, log, "q", 0, "ts")
    assert ids(sync.read_target(spark, tgt, log)) == [1, 2]
    with pytest.raises(ValueError, match="DATE"):
        sync.append_epoch(spark, ev(spark, [9]).select(F.to_date("ts").alias("event_date")), "s", "d", f"{tgt}-d", log, "q", 0)


@pytest.mark.parametrize("value", ["id", "7", "null"])
def test_compaction_sorts_no_more_rows_in_a_task_than_allowed(spark, workdir, monkeypatch, value):
    """Files are cut by rows too, also where all rows are alike in the sync column or have none; nothing is compacted again."""
    tgt, log = f"{workdir}/t-{value}", f"{workdir}/l-{value}"
    monkeypatch.setattr(sync, "SORT_ROWS", 100)
    source = spark.range(0, 1000, 1, 40).select("id", F.expr(f"timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, {value})").alias("ts"))
    sync.sync_table(spark, source, "s", "t", tgt, log, ts_override="ts")
    got = sync.read_target(spark, tgt, log)
    files = [r["count"] for r in got.groupBy(F.col("_metadata.file_path")).count().collect()]
    assert sorted(r.id for r in got.collect()) == list(range(1000))
    assert len(files) == 10 and max(files) <= 200 and sync.compact_target(spark, tgt, log) == 0
