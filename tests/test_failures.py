"""Writes survive failed task attempts (as when an executor is lost).

Runs in a child process whose master retries tasks (``local[2,3]``); a
test-only UDF fails the first attempt of some tasks in the middle of a write.
"""

import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent(
    """
    import sys, tempfile
    sys.path.insert(0, {root!r})
    from pyspark import TaskContext
    from pyspark.sql import SparkSession, functions as F, types as T
    from lakevault.session import scratch_path
    from lakevault.sources.versioned import VersionedTable

    spark = (SparkSession.builder.master("local[2,3]")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "4").getOrCreate())
    spark.sparkContext.setLogLevel("WARN")

    @F.udf(T.LongType())
    def flaky(x):  # test-only: the first attempt of every even partition dies mid-write
        ctx = TaskContext.get()
        if ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0 and x % 1000 == 999:
            raise RuntimeError("simulated lost executor")
        return x

    t = VersionedTable(spark, scratch_path(spark, "flaky"))
    df = spark.range(0, 20000, numPartitions=4).select(flaky("id").alias("id"))
    t.write(df, mode="overwrite")
    back = t.read()
    print("RESULT", back.count(), back.distinct().count(), t.last_num_rows)
    """
)


def test_versioned_write_survives_failed_attempts():
    code = SCRIPT.format(root=ROOT)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=600)
    lines = [ln for ln in out.stdout.splitlines() if ln.startswith("RESULT")]
    assert lines, out.stderr[-2000:]
    rows, distinct, observed = map(int, lines[0].split()[1:])
    assert rows == distinct == observed == 20000
    assert "simulated lost executor" in out.stderr  # the failures did happen and were retried


def test_streaming_hub_merge_resumes_after_a_failed_micro_batch(spark, tmp_root):
    from lakevault.operators.vault import hub_rows, insert_new_keys
    from lakevault.sources.versioned import VersionedTable

    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    src, ck = f"{tmp_root}/in", f"{tmp_root}/ck"
    ev.repartition(3).write.parquet(src)
    table = VersionedTable(spark, f"{tmp_root}/hub")
    crash = {"armed": True}

    def apply(batch, batch_id):
        hub, _ = hub_rows(batch, "user_id", "hk", "2024-02-01", "EVENTS")
        insert_new_keys(table, hub, "user_id", prefilter=True, load_id=f"batch/{batch_id}")
        if batch_id == 1 and crash["armed"]:  # dies after writing, before the batch commits
            crash["armed"] = False
            raise RuntimeError("simulated driver/executor loss")

    def run():
        q = (spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", "1").parquet(src)
             .writeStream.foreachBatch(apply).option("checkpointLocation", ck)
             .trigger(availableNow=True).start())
        q.awaitTermination()

    try:
        run()
    except Exception:
        pass
    assert not crash["armed"]
    run()  # restarts from the checkpoint and replays batch 1
    got = table.read()
    assert got.count() == got.select("hk").distinct().count() == ev.select("user_id").distinct().count()
