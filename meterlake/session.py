"""Spark session settings and the shared working folder.

Every job here is DataFrame code; the settings below are the ones the plans rely on:
UTC session time, adaptive query execution (partition coalescing, skew-join splitting,
runtime broadcast switching) and an explicit broadcast size bound.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings. Broadcast is decided by Spark from plan statistics against
# this bound (never by an unconditional hint), so a side that grows past it falls
# back to a shuffled join.
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    # lets Spark filter the large side of a shuffled join by the small side's keys, above its own thresholds
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def build_session(master: str | None = None, app: str = "meterlake",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None, sized_for: tuple[int, int] | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings this library expects.

    The shuffle width is the cluster's unless ``shuffle_partitions`` or ``sized_for`` (bytes read,
    executor cores; see ``scale_settings``) is given.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(SQL_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if sized_for:
        conf.update(scale_settings(*sized_for))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    The cluster's value is used as is. Only when it is unset in a local run (tests) a
    folder is created and registered, so later calls and ``checkpoint()`` agree; on a
    cluster an unset value is an error, since executors do not share the driver's disk.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="meterlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def fresh_dir(spark: SparkSession, prefix: str) -> str:
    """A new, unique folder under the shared folder (never reused, never cleared)."""
    base = shared_dir(spark)
    path = f"{base}/{prefix}-{uuid.uuid4().hex[:12]}"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: later uses read it instead of computing it again."""
    path = fresh_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scale_settings(input_bytes: int, executors_cores: int, target_partition_mb: int = 256) -> dict[str, str]:
    """Shuffle and scan sizing for a large cluster, from the bytes a job reads.

    * scan splits of ``target_partition_mb`` (``spark.sql.files.maxPartitionBytes``);
    * an initial shuffle width that keeps each shuffle partition near the same size,
      at least twice the total core count; AQE then coalesces small partitions
      toward ``advisoryPartitionSizeInBytes`` and splits skewed ones;
    * skewed partitions are those 5x the median and above 1 GB.

    Apply with ``spark.conf.set`` for each item (all are runtime SQL settings).
    """
    target = target_partition_mb * 1024 * 1024
    width = max(2 * executors_cores, -(-input_bytes // target))
    return {
        "spark.sql.files.maxPartitionBytes": str(target),
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(width),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * 1024 * 1024),
    }
