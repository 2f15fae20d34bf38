"""Session defaults and the shared scratch location.

Everything written by an operator (versioned tables, stream checkpoints,
landing areas) lives under the folder the cluster names in
``spark.checkpoint.dir``; iterative loads cut their lineage by writing and
re-reading such a table, never with a local checkpoint. That folder is shared by all executors, so a
retried task or a lost executor never depends on a machine-local path.
A private folder is created only when the setting is absent (tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # streaming state (watermark de-duplication) in RocksDB: bounded heap, spills to disk
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, **conf) -> SparkSession:
    """Session for tests and the bench; on a cluster the caller's session is used."""
    builder = SparkSession.builder.master(master).appName("lakevault")
    settings = dict(SESSION_DEFAULTS)
    settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update({k: str(v) for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_root(spark)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The cluster-wide checkpoint folder; set a private one only when unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # Spark Connect has no SparkContext
            root = None
    if not root:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: on a cluster it must name a shared folder "
                "(HDFS / object store) that every executor can reach"
            )
        # local mode only (tests). spark.checkpoint.dir is a core setting that
        # cannot change at run time; the context's checkpoint folder can.
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lakevault-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared root."""
    return f"{shared_root(spark)}/lakevault/{name}-{uuid.uuid4().hex[:12]}"
