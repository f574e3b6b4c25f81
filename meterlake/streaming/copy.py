"""ST-1: the incremental copy as a Structured Streaming job with ``availableNow``.

For tables that support streaming reads, the file source tracks which input files
were already processed in its checkpoint, and the file sink commits output files
through its own metadata log. A rerun (or a restart after a lost executor / driver)
resumes from the checkpoint: each input file is copied exactly once and readers of
the output only ever see committed files.

``stream_into_sync`` brings a stream into the same target as the batch sync: every micro-batch is an epoch that
the sync log commits.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from meterlake.sources import sync


def stream_copy(spark: SparkSession, in_path: str, schema: StructType | str, out_path: str, checkpoint: str,
                fmt: str = "parquet", max_files_per_trigger: int | None = None) -> None:
    """Copy every not-yet-processed file under ``in_path`` to ``out_path``, then stop."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    q = (reader.load(in_path).writeStream.format(fmt)
         .option("checkpointLocation", checkpoint)
         .outputMode("append")
         .trigger(availableNow=True)
         .start(out_path))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def stream_into_sync(spark: SparkSession, stream: DataFrame, schema: str, table: str, target: str, log_path: str, checkpoint: str,
                     ts_col: str | None = None, key: list[str] | None = None, lateness: str | None = None, file_mb: float = 128.0) -> None:
    """Bring everything that ``stream`` has now into the sync target, exactly once, then stop.

    Spark runs the last epoch of a checkpoint again when a run broke off in it, with the same rows.
    Epochs are told apart by the query id that the checkpoint keeps and their number, and the sync
    log knows the last one of each query, so an epoch whose commit was written is not written twice, and
    one whose commit was not is written anew. With ``key`` and ``lateness`` rows that come again are dropped: a key is
    remembered until the watermark (the newest ``ts_col`` minus ``lateness``) has passed it, and
    rows older than the watermark are dropped, as nobody knows any more whether they came before.
    """
    if key:
        if not (ts_col and lateness):
            raise ValueError("key needs ts_col and lateness: without a watermark every key would be kept for ever")
        stream = stream.withWatermark(ts_col, lateness).dropDuplicatesWithinWatermark(key)

    def commit(batch: DataFrame, epoch: int) -> None:
        # the checkpoint's own id: the same after a restart, another one for a new checkpoint
        ident = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"].replace("-", "")
        sync.append_epoch(spark, batch, schema, table, target, log_path, ident, epoch, ts_col, file_mb)

    q = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(commit).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
