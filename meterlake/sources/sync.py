"""SNK-1..10: full / incremental copy with an append-only sync log as the only commit point.

Target layout (plain Parquet, no table format needed)::

    <target>/full-<id>/part-*.parquet     one full load
    <target>/inc-<id>/part-*.parquet      one incremental batch
    <target>/compact-<id>/part-*.parquet  the live rows rewritten into larger files

* Every load writes a folder of its own with a new id and changes no other. Its commit is one
  log row, which lists the folders that make up the table from then on (``live``). A load
  that fails, or whose log row was never written, leaves a folder that no row names: readers
  do not see it and a new run copies its rows again. Nothing is overwritten in place, so a
  failed full load leaves the old content readable.
* FULL / FULL_FALLBACK start a new list, and with it a new schema (D-4).
* INCREMENTAL loads rows with ``ts > lo`` (the bound is pushed into the scan) and adds its
  folder to the list. The saved mark is the highest one written, never below the old mark,
  and is taken from the new folder, not from the wall clock (D-1).
* A DATE sync column reloads whole days ``>= lo`` (D-2): the older folders of the list are
  visible only for days before ``lo`` from then on.
* Readers read the folders that the table's newest log row names, with the schema it names, so
  columns added by later batches appear (SNK-3). A batch that changes a type widens the schema or,
  where nothing holds both types, fails before it writes (``sources.schemas``).
* A stream commits its epochs to the same log (``append_epoch``); the log row holds the last epoch
  of every stream, so an epoch that is run again changes nothing.
* One writer per table at a time; different tables may be synced at once.
"""

from __future__ import annotations

import datetime as dt
import itertools
import json
import math
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType, TimestampType

from meterlake.functions.columns import between_marks, date_lit
from meterlake.sources.schemas import fitted, merged

FULL, FULL_FALLBACK, INCREMENTAL = "FULL", "FULL_FALLBACK", "INCREMENTAL"
SUCCESS, COMPACTED, FAILED, NOT_COMPACTED = "SUCCESS", "COMPACTED", "FAILED", "COMPACTION_FAILED"
#: Live folders beyond which an incremental target is compacted.
MAX_FOLDERS = 24
#: Share of the wanted file size below which a folder's files count as small.
SMALL = 0.5
#: Rows that one task sorts for a file of a compaction: Parquet can be so small that a file's rows do not fit a task.
SORT_ROWS = 2_000_000

# Sync-column candidates, matched case-insensitively, first match wins.
SYNC_CANDIDATES = [
    "event_time", "created_at", "updated_at", "modified_at", "timestamp", "event_date",
    "created_time", "update_time", "usage_date", "change_time", "start_time",
]

LOG_SCHEMA = ("schema_name string, table_name string, full_table_name string, "
              "last_sync_timestamp timestamp_ntz, last_sync_mode string, sync_status string, "
              "updated_at timestamp, batch_id string, seq bigint, rows bigint, null_marks bigint, error string, "
              "target string, mark_column string, live array<struct<folder:string,before:date>>, columns string, epochs map<string,bigint>")

_seq = itertools.count()


@dataclass
class SyncResult:
    table: str
    mode: str
    rows: int
    lo: object
    hi: object
    batch_id: str
    status: str = "SUCCESS"
    null_marks: int = 0


def get_timestamp_column(df: DataFrame, override: str | None = None) -> str | None:
    """SNK-5: the sync column: ``override`` if given, else the first candidate present
    (case-insensitive); returns the column's own spelling, or None."""
    by_lower = {c.lower(): c for c in df.columns}
    if override:
        return by_lower.get(override.lower())
    for cand in SYNC_CANDIDATES:
        if cand in by_lower:
            return by_lower[cand]
    return None


def choose_mode(has_state: bool, force: bool, ts_col: str | None) -> str:
    """SNK-4: no state or forced -> FULL; no sync column -> FULL_FALLBACK; else INCREMENTAL."""
    if not has_state or force:
        return FULL
    if ts_col is None:
        return FULL_FALLBACK
    return INCREMENTAL


def _is_date(df: DataFrame, col: str | None) -> bool:
    return col is not None and isinstance(df.schema[col].dataType, DateType)


def _write(df: DataFrame, target: str, kind: str, ts_col: str | None) -> str:
    """Write ``df`` to a new folder of the target; returns the folder's name.

    Rows are sorted by the sync column within files, so row-group statistics prune later
    reads; rows of one day are brought together first, so that a day is not in every file.
    """
    if ts_col:
        df = (df.hint("rebalance", ts_col) if _is_date(df, ts_col) else df).sortWithinPartitions(ts_col)
    folder = f"{kind}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(f"{target}/{folder}")
    return folder


def copy_full(df: DataFrame, target: str, ts_col: str | None = None) -> str:
    """SNK-1 / SNK-2: write all of ``df`` as a new folder; it counts once the log names it."""
    return _write(df, target, "full", ts_col)


def copy_incremental(df: DataFrame, target: str, ts_col: str, lo, hi=None,
                     lookback: dt.timedelta | None = None, key: list[str] | None = None,
                     loaded: DataFrame | None = None) -> str:
    """SNK-3 + FIL-1: write the rows with ``lo < ts <= hi`` as a new folder.

    Without a low mark every row that has a mark is new. DATE columns take the days ``>= lo``
    (D-2). With ``lookback``, ``key`` and the rows ``loaded`` so far (D-1), the batch goes back to
    ``lo - lookback`` and leaves out keys that are loaded already (a LEFT ANTI join over the
    whole span that is read again), so rows that arrived late are copied exactly once.
    """
    known = df.filter(F.col(ts_col).isNotNull())
    if _is_date(df, ts_col):
        new = known if lo is None else known.filter(F.col(ts_col) >= date_lit(lo))
        if hi is not None:
            new = new.filter(F.col(ts_col) <= date_lit(hi))
    elif lookback is not None and key and lo is not None and loaded is not None:
        seen = between_marks(loaded, ts_col, lo - lookback, None).select(*key).distinct()
        new = between_marks(known, ts_col, lo - lookback, hi).join(seen, list(key), "left_anti").select(*df.columns)
    else:
        new = between_marks(known, ts_col, lo, hi)
    return _write(new, target, "inc", ts_col)


# ---- sync log (SNK-6) --------------------------------------------------------------------
#   <log>/commits/day=<UTC day>/commit-<seq>-<id>/   one folder per commit (the commit point)
#   <log>/snapshots/gen=<seq>/                       newest committed row per table up to <seq>
# ``seq`` is the UTC clock in microseconds x 1000 plus a per-process counter, so the day of
# any seq is known without reading.
LOG_COLUMNS = [c.split()[0] for c in LOG_SCHEMA.split(", ")]  # the types hold no ", "


def _seq_day(seq: int) -> dt.date:
    return dt.datetime.fromtimestamp(seq // 1_000_000_000, dt.timezone.utc).date()


def log_sync(spark: SparkSession, log_path: str, rows: list[dict]) -> None:
    """Append log rows. The log write is the commit point of a batch.

    Every commit is its own folder: concurrent table jobs never share a write staging
    area, and a commit becomes visible only once its job has committed. Commits are
    grouped in day folders so state lookups read only the days after the latest
    snapshot.
    """
    now = dt.datetime.now(dt.timezone.utc)
    recs = []
    for r in rows:
        recs.append((r["schema_name"], r["table_name"], r.get("full_table_name") or f"{r['schema_name']}.{r['table_name']}",
                     r.get("last_sync_timestamp"), r["last_sync_mode"], r.get("sync_status", "SUCCESS"), now,
                     r.get("batch_id"), time.time_ns() // 1000 * 1000 + next(_seq) % 1000,
                     r.get("rows"), r.get("null_marks"), r.get("error"), r.get("target"), r.get("mark_column"), r.get("live"),
                     r.get("columns"), r.get("epochs")))
    seq = recs[0][8]
    path = f"{log_path}/commits/day={_seq_day(seq).isoformat()}/commit-{seq:020d}-{uuid.uuid4().hex[:8]}"
    spark.createDataFrame(recs, LOG_SCHEMA).coalesce(1).write.mode("error").parquet(path)


def _exists(spark: SparkSession, pattern: str) -> bool:
    """Whether any path matches ``pattern``; other errors of the file system are raised."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def _size(spark: SparkSession, paths: list[str]) -> tuple[int, int]:
    """Bytes and number of the Parquet files in the folders, from the file listing."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    total = files = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        for status in path.getFileSystem(conf).listStatus(path):
            if status.isFile() and status.getPath().getName().endswith(".parquet"):
                total, files = total + status.getLen(), files + 1
    return total, files


def read_log(spark: SparkSession, log_path: str, since: dt.date | None = None) -> DataFrame:
    """Log rows of every commit, or of the commits made on ``since`` or later."""
    if since is None:
        pattern = f"{log_path}/commits/day=*/commit-*"
    else:
        today = dt.datetime.now(dt.timezone.utc).date()
        days = [(since + dt.timedelta(days=i)).isoformat() for i in range((today - since).days + 1)]
        pattern = f"{log_path}/commits/day={{{','.join(days)}}}/commit-*"
    if not _exists(spark, pattern):
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).parquet(pattern).select(*LOG_COLUMNS)


def _latest(log: DataFrame) -> DataFrame:
    """Newest committed log row per table (``max_by`` on ``seq``), all log columns."""
    rest = [c for c in LOG_COLUMNS if c not in ("schema_name", "table_name")]
    m = F.max_by(F.struct(*rest), "seq").alias("s")
    return (log.filter(F.col("sync_status").isin(SUCCESS, COMPACTED)).groupBy("schema_name", "table_name").agg(m)
            .select("schema_name", "table_name", *[F.col(f"s.{c}").alias(c) for c in rest]))


def snapshot_state(spark: SparkSession, log_path: str) -> int | None:
    """Write the current state as a snapshot generation; returns its ``seq`` (None if no log).

    Run it periodically (e.g. daily): later state lookups read the newest snapshot plus
    the commits made since, however long the log's history is. Without a commit since the
    newest snapshot that one stays; one that broke off is written again.
    """
    state = _current(spark, log_path).cache()
    try:
        top = state.agg(F.max("seq")).first()[0]
        if top is None:
            return None
        path = f"{log_path}/snapshots/gen={top:020d}"
        if not _exists(spark, f"{path}/_SUCCESS"):
            state.coalesce(1).write.mode("overwrite").parquet(path)
        return int(top)
    finally:
        state.unpersist()


def _newest_snapshot(spark: SparkSession, log_path: str) -> int:
    """``seq`` of the newest snapshot that was written to its end, from the folder listing."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{log_path}/snapshots/gen=*/_SUCCESS")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return max(int(f.getPath().getParent().getName().removeprefix("gen=")) for f in found)


def _current(spark: SparkSession, log_path: str) -> DataFrame:
    if not _exists(spark, f"{log_path}/snapshots/gen=*/_SUCCESS"):
        return _latest(read_log(spark, log_path))
    gen = _newest_snapshot(spark, log_path)
    base = spark.read.schema(LOG_SCHEMA).parquet(f"{log_path}/snapshots/gen={gen:020d}")
    recent = read_log(spark, log_path, since=_seq_day(gen)).filter(F.col("seq") > gen)
    return _latest(base.unionByName(recent))


def sync_state(spark: SparkSession, log_path: str) -> DataFrame:
    """Current state per table: the newest committed log row.

    Columns are those of the control table: ``schema_name, table_name,
    full_table_name, last_sync_timestamp, last_sync_mode, sync_status, updated_at``.
    """
    return _current(spark, log_path).select(
        "schema_name", "table_name", "full_table_name", "last_sync_timestamp", "last_sync_mode",
        F.lit(SUCCESS).alias("sync_status"), "updated_at")


def _state_rows(spark: SparkSession, log_path: str) -> dict[tuple[str, str], object]:
    """(schema, table) -> newest committed log row: one row per table on the driver."""
    return {(r["schema_name"], r["table_name"]): r for r in _current(spark, log_path).collect()}


def read_target(spark: SparkSession, target: str, log_path: str, ts_col: str | None = None) -> DataFrame:
    """The committed rows of a sync target: the folders that its newest log row names."""
    row = _target_row(spark, target, log_path)
    if row is None:
        raise ValueError(f"nothing was committed to {target}")
    return _read_live(spark, target, row["live"], ts_col or row["mark_column"], _columns(row))


def _target_row(spark: SparkSession, target: str, log_path: str):
    return _current(spark, log_path).filter(F.col("target") == target).orderBy(F.desc("seq")).first()


def _columns(row) -> StructType | None:
    """The schema that a log row names; None for rows written before there was one."""
    return StructType.fromJson(json.loads(row["columns"])) if row is not None and row["columns"] else None


def _read_live(spark: SparkSession, target: str, live, ts_col: str | None, columns: StructType | None = None) -> DataFrame:
    """Rows of the live folders; a folder with a ``before`` day shows only earlier days (and rows without a day).

    Two scans at most, however many folders and days there are: the day of a file's folder
    is looked up by the file's path.
    """
    reader = spark.read.schema(columns) if columns is not None else spark.read.option("mergeSchema", "true")
    whole = [f"{target}/{x['folder']}" for x in live if x["before"] is None]
    cut = {x["folder"]: x["before"] for x in live if x["before"] is not None}
    out = reader.parquet(*whole) if whole else None
    if cut:
        part = reader.parquet(*[f"{target}/{f}" for f in cut])
        before = F.create_map(*[c for f, d in cut.items() for c in (F.lit(f), date_lit(d))])
        folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
        # the first bound reaches the scan, the second is each folder's own
        shown = (F.col(ts_col) < date_lit(max(cut.values()))) & (F.col(ts_col) < before[folder])
        part = part.filter(F.col(ts_col).isNull() | shown).select(*part.columns)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def _mark_out(df: DataFrame, col: str):
    """max(col) without a zone shift: TIMESTAMP marks leave Spark as microseconds."""
    if isinstance(df.schema[col].dataType, TimestampType):
        return F.unix_micros(F.max(col))
    return F.max(col)


def _as_mark(value) -> dt.datetime | None:
    """The mark as UTC wall time: microseconds, a date or a zone-less time."""
    if value is None:
        return None
    if isinstance(value, int):
        return dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=value)
    if isinstance(value, dt.datetime):
        return value
    return dt.datetime.combine(value, dt.time())


def _loaded_stats(spark: SparkSession, folder: str, ts_col: str | None):
    """Rows, highest mark and rows without a mark of the folder just written."""
    df = spark.read.option("mergeSchema", "false").parquet(folder)
    aggs = [F.count(F.lit(1)).alias("rows")]
    if ts_col:
        aggs += [_mark_out(df, ts_col).alias("hi"), F.count_if(F.col(ts_col).isNull()).alias("nulls")]
    r = df.agg(*aggs).first()
    return int(r["rows"]), (_as_mark(r["hi"]) if ts_col else None), (int(r["nulls"]) if ts_col else 0)


def sync_table(spark: SparkSession, source: DataFrame, schema: str, table: str, target: str, log_path: str,
               force: bool = False, ts_override: str | None = None, lookback: dt.timedelta | None = None,
               key: list[str] | None = None, state: dict | None = None, file_mb: float = 128.0,
               max_folders: int = MAX_FOLDERS) -> SyncResult:
    """SNK-4 + SNK-1..3 + SNK-6 for one table: pick the mode, copy, measure, commit to the log.

    The source is read once for the copy; the mark (``max`` of the sync column) and the
    row count are then taken from the folder just written, so the saved mark is exactly
    the newest row loaded (D-1) and no extra pass over the whole source is needed. An incremental batch is fitted
    to the target's schema, or widens it; ``SchemaConflict`` is raised, and logged, before anything is written. A full
    load that left many small files, and an incremental target of more than ``max_folders`` folders, are
    compacted into files of about ``file_mb`` after the commit.
    """
    ts_col = get_timestamp_column(source, ts_override)
    # ``state``: the run's state rows by (schema, table), read once by ``sync_all``
    row = (state if state is not None else _state_rows(spark, log_path)).get((schema, table))
    mode = choose_mode(row is not None, force, ts_col)
    is_date = _is_date(source, ts_col)
    lo = None if mode != INCREMENTAL else row["last_sync_timestamp"]
    entry = dict(schema_name=schema, table_name=table, last_sync_mode=mode, target=target, mark_column=ts_col,
                 epochs=row["epochs"] if row is not None else None)
    try:
        if mode == INCREMENTAL:
            columns, source = _grown(spark, row, target, source)
            at = lo.date() if is_date and lo is not None else lo
            loaded = _read_live(spark, target, row["live"], ts_col, columns) if lookback is not None and key else None
            folder = copy_incremental(source, target, ts_col, at, lookback=lookback, key=key, loaded=loaded)
            rows, hi, _ = _loaded_stats(spark, f"{target}/{folder}", ts_col)
            # rows without a mark are never copied incrementally (D-3); the count uses
            # the IsNull filter, which row-group statistics answer without reading data
            nulls = source.filter(F.col(ts_col).isNull()).count()
            mark = max((m for m in (lo, hi) if m is not None), default=None)  # late rows never pull it back
            hidden = at if is_date else None
            live = [(x["folder"], x["before"] if hidden is None else min(x["before"] or hidden, hidden)) for x in row["live"]]
        else:
            columns = source.schema
            folder = copy_full(source, target, ts_col)
            rows, mark, nulls = _loaded_stats(spark, f"{target}/{folder}", ts_col)
            live = []
        live.append((folder, None))
        log_sync(spark, log_path, [entry | dict(last_sync_timestamp=mark, batch_id=folder, rows=rows, null_marks=nulls,
                                                live=live, columns=columns.json())])
    except Exception as e:
        log_sync(spark, log_path, [entry | dict(last_sync_timestamp=lo, sync_status=FAILED, error=type(e).__name__)])
        raise
    _tidied(spark, entry, target, log_path, file_mb, mode != INCREMENTAL or len(live) > max_folders)
    return SyncResult(f"{schema}.{table}", mode, rows, lo, mark, folder, SUCCESS, nulls)


def _grown(spark: SparkSession, row, target: str, batch: DataFrame) -> tuple[StructType, DataFrame]:
    """The target's schema after ``batch``, and the batch fitted to it; raises ``SchemaConflict``."""
    columns = _columns(row) or _read_live(spark, target, row["live"], row["mark_column"]).schema
    columns = merged(columns, batch.schema)
    return columns, fitted(batch, columns)


def _tidied(spark: SparkSession, entry: dict, target: str, log_path: str, file_mb: float, due: bool) -> None:
    """Compact the target if that is ``due``. The load is committed by then, and stays so whatever
    becomes of this: a compaction that fails is a log row of its own, and the next load tries again."""
    if not due:
        return
    try:
        compact_target(spark, target, log_path, file_mb)
    except Exception as e:
        log_sync(spark, log_path, [entry | dict(sync_status=NOT_COMPACTED, error=type(e).__name__)])


def append_epoch(spark: SparkSession, batch: DataFrame, schema: str, table: str, target: str, log_path: str, stream: str, epoch: int,
                 ts_override: str | None = None, file_mb: float = 128.0, max_folders: int = MAX_FOLDERS) -> bool:
    """ST-1 into SNK-3: commit one epoch of the stream named ``stream``; False if it was committed before.

    The epoch's folder bears its name: an attempt that broke off before its log row was written is
    overwritten by the next one, and an epoch that the table's newest log row has (or has passed) is left out,
    so each row counts once however often an epoch is run. An epoch without rows commits nothing.
    """
    row = _state_rows(spark, log_path).get((schema, table))
    epochs = dict(row["epochs"] or {}) if row is not None else {}
    if epochs.get(stream, -1) >= epoch or batch.isEmpty():
        return False
    columns = batch.schema
    if row is not None:
        columns, batch = _grown(spark, row, target, batch)
    ts_col = get_timestamp_column(batch, ts_override)
    if _is_date(batch, ts_col):
        raise ValueError(f"{ts_col} is a DATE: its last day is reloaded by the batch sync, a stream cannot do that")
    folder = f"stream-{stream}-{epoch:012d}"
    batch.write.mode("overwrite").parquet(f"{target}/{folder}")
    rows, hi, nulls = _loaded_stats(spark, f"{target}/{folder}", ts_col)
    lo = row["last_sync_timestamp"] if row is not None else None
    live = [tuple(x) for x in row["live"]] if row is not None else []
    entry = dict(schema_name=schema, table_name=table, last_sync_mode=INCREMENTAL, target=target, mark_column=ts_col, epochs=epochs | {stream: epoch})
    log_sync(spark, log_path, [entry | dict(last_sync_timestamp=max((m for m in (lo, hi) if m is not None), default=None), batch_id=folder,
                                            rows=rows, null_marks=nulls, live=[*live, (folder, None)], columns=columns.json())])
    _tidied(spark, entry, target, log_path, file_mb, len(live) >= max_folders)
    return True


class SyncFailed(Exception):
    """Some tables of a run failed; ``results`` has every table's result, failed ones included."""

    def __init__(self, results: list[SyncResult], errors: dict[str, Exception]):
        super().__init__("; ".join(f"{t}: {type(e).__name__}" for t, e in errors.items()))
        self.results, self.errors = results, errors


def sync_all(spark: SparkSession, sources: dict[str, DataFrame], target_root: str, log_path: str,
             force: bool = False, ts_overrides: dict[str, str] | None = None, parallelism: int = 1,
             excluded=("information_schema", "metadata"), lookbacks: dict[str, dt.timedelta] | None = None,
             keys: dict[str, list[str]] | None = None) -> list[SyncResult]:
    """SNK-7: sync every ``schema.table`` source into ``<target_root>/<schema>/<table>``.

    Tables are independent jobs; ``parallelism > 1`` submits them from a small
    thread pool so several write jobs share the cluster. A table that fails does not keep
    the others from being synced; after the last one ``SyncFailed`` carries every result.
    """
    ts_overrides, lookbacks, keys = ts_overrides or {}, lookbacks or {}, keys or {}
    names = [n for n in sources if n.split(".")[0] not in excluded and not n.split(".")[0].startswith("__")]

    # one state lookup for the whole run (one row per table) instead of one per table
    state = _state_rows(spark, log_path)
    errors: dict[str, Exception] = {}

    def run(name):
        schema, table = name.split(".", 1)
        try:
            return sync_table(spark, sources[name], schema, table, f"{target_root}/{schema}/{table}", log_path,
                              force, ts_overrides.get(name), lookbacks.get(name), keys.get(name), state=state)
        except Exception as e:  # reported below, with the other tables' results
            errors[name] = e
            return SyncResult(name, "", 0, None, None, "", FAILED)

    def pooled(name):
        # each table's jobs go to the FAIR pool "sync" when the cluster runs the FAIR scheduler
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", "sync")
        try:
            return run(name)
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    if parallelism <= 1:
        results = [run(n) for n in names]
    else:
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            results = list(pool.map(pooled, names))
    if errors:
        raise SyncFailed(results, errors)
    return results


def sync_summary(log: DataFrame, by: str | None = None) -> DataFrame:
    """SNK-8: number of full loads (FULL and FULL_FALLBACK) and incremental loads."""
    aggs = [F.count_if(F.col("last_sync_mode").contains("FULL")).cast("bigint").alias("full_loads"),
            F.count_if(F.col("last_sync_mode") == INCREMENTAL).cast("bigint").alias("incremental_loads")]
    ok = log.filter(F.col("sync_status") == SUCCESS)
    return ok.groupBy(by).agg(*aggs) if by else ok.agg(*aggs)


# ---- compaction (SNK-9) ---------------------------------------------------------------------
def _ideal_files(size: int, file_mb: float, rows: int = 0) -> int:
    """Files of ``file_mb`` for ``size`` bytes, more of them where they would hold over SORT_ROWS of the ``rows`` to sort."""
    return max(1, math.ceil(size / (file_mb * 1024 * 1024)), math.ceil(rows / SORT_ROWS))


def _resized(df: DataFrame, n: int, sort_col: str | None) -> DataFrame:
    """``df`` in ``n`` partitions, ranged and sorted by ``sort_col`` where there is one; rows alike in it (or without it) are dealt over several."""
    if not sort_col:
        return df.repartition(n)
    return df.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(n, sort_col, "__tie").drop("__tie").sortWithinPartitions(sort_col)


def compact(spark: SparkSession, path_in: str, path_out: str, target_file_mb: float = 128.0,
            sort_col: str | None = None) -> int:
    """Rewrite the files of one folder into ``path_out``, a new folder, with files of about
    ``target_file_mb``; returns their number. Sizes come from the file listing, rows from the footers."""
    df = spark.read.option("mergeSchema", "true").parquet(path_in)
    n = _ideal_files(_size(spark, [path_in])[0], target_file_mb, df.count() if sort_col else 0)
    _resized(df, n, sort_col).write.mode("error").parquet(path_out)
    return n


def compact_target(spark: SparkSession, target: str, log_path: str, file_mb: float = 128.0) -> int:
    """Rewrite the small files of a sync target into one folder and switch readers to it with a log row.

    Only folders whose files are on average below SMALL of ``file_mb`` are read and rewritten, each without
    the rows that it hides, into files of ``file_mb`` and SORT_ROWS rows at most; folders of large files stay as they are. The old folders stay for readers
    that have listed them; ``unused_folders`` names them. Returns the number of files written, or 0 where
    that would not make fewer of them.
    """
    row = _target_row(spark, target, log_path)
    sizes = {x["folder"]: _size(spark, [f"{target}/{x['folder']}"]) for x in row["live"]}
    small = [x for x in row["live"] if sizes[x["folder"]][0] < SMALL * file_mb * 1024 * 1024 * sizes[x["folder"]][1]]
    ts_col, columns = row["mark_column"], _columns(row)
    files = sum(sizes[x["folder"]][1] for x in small)
    n = _ideal_files(sum(sizes[x["folder"]][0] for x in small), file_mb)
    if files <= n:
        return 0
    df = _read_live(spark, target, small, ts_col, columns)
    if ts_col:
        n = max(n, _ideal_files(0, file_mb, df.count()))
        if files <= n:
            return 0
    folder = f"compact-{uuid.uuid4().hex}"
    _resized(df, n, ts_col).write.mode("error").parquet(f"{target}/{folder}")
    stay = [tuple(x) for x in row["live"] if x not in small]
    log_sync(spark, log_path, [row.asDict() | dict(sync_status=COMPACTED, batch_id=folder, live=[*stay, (folder, None)])])
    return n


def unused_folders(spark: SparkSession, target: str, log_path: str) -> list[str]:
    """Folders of the target that its newest log row does not name: superseded or never committed."""
    row = _target_row(spark, target, log_path)
    live = {x["folder"] for x in row["live"]} if row else set()
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    return sorted(x.getPath().getName() for x in found if x.isDirectory() and x.getPath().getName() not in live)
