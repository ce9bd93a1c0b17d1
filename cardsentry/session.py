"""Spark session helpers.

The library never changes settings of a session it is handed; ``get_session``
is only a convenience for scripts, tests and the bench.  Everything that is
computed is independent of the session time zone because batch plans run on
``TIMESTAMP_NTZ`` columns.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at scale.
# * No broadcast is planned from *estimated* sizes (static threshold -1).
#   AQE re-plans joins at runtime and turns a sort-merge join into a broadcast
#   join only when the *measured* shuffle output of one side is below the
#   adaptive threshold: a checked bound, with the sort-merge join beyond it.
# * AQE splits skewed partitions of a sort-merge join into several tasks and
#   coalesces small shuffle partitions towards the advisory size.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Many multi-stage queries in one application: keep their generated code
    # (the default of 100 entries makes Spark recompile on every rerun).
    "spark.sql.codegen.cache.maxEntries": "2000",
    "spark.ui.enabled": "false",
}


# Suggested sizing for a large cluster (100 TB input): start with many shuffle
# partitions and let AQE coalesce them to ~256 MB; read ~512 MB splits.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(512 * 1024 * 1024),
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "cardsentry", extra: dict | None = None) -> SparkSession:
    """Build (or fetch) a session with the settings above."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The configured checkpoint folder.  Only a local-mode session (tests, one
    machine) may do without one and gets a fresh scratch folder; on a cluster
    every machine would see its own, so that is an error."""
    found = checkpoint_dir(spark)
    if found:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(found)
        return found
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="cardsentry-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(local)
    return local
