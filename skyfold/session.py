"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on.  They are the scale knobs: AQE re-plans joins
# and coalesces/splits shuffle partitions at runtime, skew-join splits hot keys,
# and the session zone is pinned so epoch <-> timestamp maths is stable.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Pandas-backed stateful processors talk to the JVM over a Unix socket
    # instead of a loopback TCP port.
    "spark.python.unix.domain.socket.enabled": "true",
}


# Settings for a large cluster (~1000 executors, ~100 TB of positions).  The
# initial shuffle width is generous and AQE coalesces to ~256 MB partitions,
# splits skewed ones, and turns joins into broadcasts when the measured side
# is small.  Scans read 512 MB splits.  Stateful streams keep state in RocksDB.
CLUSTER_CONF = {
    **DEFAULT_CONF,
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(512 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(256 * 1024 * 1024),
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
}


def cluster_conf(overrides: dict | None = None) -> dict:
    """Recommended settings for the large-cluster deployment (a dict to pass
    to ``SparkSession.builder.config`` or spark-submit ``--conf``)."""
    return {**CLUSTER_CONF, **(overrides or {})}


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "skyfold", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.ui.enabled"] = "false"
    conf.setdefault("spark.driver.memory", "12g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is.  Only a local master (one machine, as in tests) gets a scratch
    folder when it is unset; on a cluster that is an error, as every machine
    would write to its own disk.
    """
    cur = spark.conf.get("spark.checkpoint.dir", None)
    if not cur and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not cur:
        cur = tempfile.mkdtemp(prefix="skyfold-ckpt-")
        spark.conf.set("spark.checkpoint.dir", cur)
    spark.sparkContext.setCheckpointDir(cur)
    return cur


def shared_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    return os.path.join(ensure_checkpoint_dir(spark), name)


def materialized(df):
    """Write ``df`` once to the shared checkpoint folder and read it back
    (``checkpoint(eager=True)``): a small table used by several branches of
    one plan is computed once and its lineage is cut.  Never ``localCheckpoint``."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
