"""Task failures during a sync (lost executor / failed attempt): retries must not lose or
duplicate rows. Runs in its own process with ``local[4,3]`` (3 attempts per task)."""

import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent("""
    import os, sys, tempfile, uuid
    sys.path.insert(0, {repo!r})
    from pyspark import TaskContext
    from pyspark.sql import SparkSession, functions as F
    from meterlake.sources import sync

    spark = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "4")
             .getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    root = tempfile.mkdtemp(prefix="meterlake-resilience-")
    marks = root + "/failures"
    os.makedirs(marks)

    def flaky(batches):
        ctx = TaskContext.get()
        if ctx.partitionId() == 1 and ctx.attemptNumber() == 0:
            open(os.path.join(marks, uuid.uuid4().hex), "w").close()  # proof the failure happened
            raise RuntimeError("injected task failure")
        yield from batches

    def source(n):
        df = spark.range(0, n, numPartitions=4).select(
            "id", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id)").alias("ts"))
        return df.mapInPandas(flaky, df.schema)

    tgt, log = root + "/t", root + "/log"
    r1 = sync.sync_table(spark, source(1000), "s", "e", tgt, log, ts_override="ts")
    r2 = sync.sync_table(spark, source(1500), "s", "e", tgt, log, ts_override="ts")
    out = sync.read_target(spark, tgt, log)
    n, d = out.count(), out.select("id").distinct().count()
    print("RESULT", r1.mode, r1.rows, r2.mode, r2.rows, n, d, len(os.listdir(marks)) > 0)
""")


def test_sync_survives_task_failures():
    p = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=REPO)], capture_output=True, text=True,
                       timeout=900)
    line = [x for x in p.stdout.splitlines() if x.startswith("RESULT")]
    assert line, p.stdout[-2000:] + p.stderr[-3000:]
    assert line[0].split()[1:] == ["FULL", "1000", "INCREMENTAL", "500", "1500", "1500", "True"]
