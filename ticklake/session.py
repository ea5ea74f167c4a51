"""SparkSession defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Dynamic overwrite: a replayed micro-batch replaces only its own directories.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Constraint inference doubles its set for every alias whose expression
    # occurs in a pushed-down filter; over derived tick frames (22 computed
    # columns under a NULL-drop filter) planning takes seconds. Turned off.
    "spark.sql.constraintPropagation.enabled": "false",
}

# Settings for a large cluster (100 TB of ticks, ~1000 executors). Shuffle
# partitions start high and AQE coalesces them to ~256 MB; a skewed shuffle
# partition (a hot symbol-day) is split by the skew-join rule; file splits of
# 256 MB keep scan tasks in memory; RocksDB keeps streaming state off-heap.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

def build_session(master: str | None = None, app: str = "ticklake",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None, cluster: bool = False) -> SparkSession:
    """Session with the defaults above; ``master`` only for local runs.

    ``cluster=True`` adds ``CLUSTER_CONF`` (sizing for a large cluster).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if cluster:
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (shared storage): unset, it is an error there
    and under Connect. Only in local runs a private folder is then created and
    registered.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        sc = None
    if sc is None:
        if not conf_dir:
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        return conf_dir
    current = sc.getCheckpointDir() or conf_dir
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not re.match(r"local($|\[)", sc.master):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    # unset (local runs only): a private folder on the SparkContext; the core
    # setting itself is not changed at runtime
    local = tempfile.mkdtemp(prefix="ticklake-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, its lineage cut."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint root for a job's intermediate table."""
    root = checkpoint_root(spark)
    if root.startswith("file:"):
        root = root[len("file:"):]
    return os.path.join(root, f"{name}-{os.urandom(6).hex()}")
