"""Session helpers: one place for the settings every job here relies on."""
from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings the library assumes.  Timestamps are handled as TIMESTAMP_NTZ with
# tz-independent arithmetic, so the session zone only matters for LTZ output;
# it is still pinned to UTC so printed LTZ values agree with the oracle.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # partition sizes: AQE coalesces small shuffle partitions and splits
    # skewed ones toward this size; scans split files at the same size
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    # nested fields of the log array are pruned in scans (the default, stated)
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.timeType.enabled": "true",
    # keep generated code of many distinct plans (the default holds 100)
    "spark.sql.codegen.cache.maxEntries": "2000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "shardlake", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session.  On a cluster pass ``master=None`` and let
    spark-submit decide; tests and the bench pass ``local[N]``.

    ``shuffle_partitions`` is the starting number of shuffle partitions
    (AQE coalesces from there): on a cluster size it to about the shuffled
    bytes / 256 MB, e.g. tens of thousands at 100 TB, so range-partitioned
    numbering and sorts fit executor memory."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        # local mode runs every task in the driver JVM: give it room (a
        # cluster sizes executors through its own deployment settings)
        conf["spark.driver.memory"] = os.environ.get("SHARDLAKE_DRIVER_MEMORY", "8g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if master and master.startswith("local[") or spark.conf.get("spark.checkpoint.dir", None):
        ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must point at shared storage and is read as is
    (also used for ``Dataset.checkpoint``, which adds a folder per
    application).  Only when it is unset a folder is chosen here: the one
    given, or in local mode a folder of this machine; a cluster must name one."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = fallback or os.environ.get("SHARDLAKE_CHECKPOINT_DIR")
    if not base and sc.master.startswith("local["):
        base = "/tmp/shardlake-checkpoints"
    if not base:
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base


def workers_find_library(spark: SparkSession) -> None:
    """Python workers import this library wherever they start: data sources,
    table functions and stateful processors are pickled by name."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
