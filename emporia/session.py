"""Spark session settings used by tests, bench and the examples.

On a cluster the session normally exists already; ``get_spark`` then only
fills in settings that are unset. ``checkpoint_dir`` reads the shared folder
named by ``spark.checkpoint.dir`` and sets a local one only when nothing is
configured on one machine (tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins and coalesces partitions
# at runtime, splits skewed join partitions, and keeps broadcasts behind the
# size check of ``autoBroadcastJoinThreshold``.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Keeps only what changed in memory; map state and timers of the streaming cart need it.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int = 8, app: str = "emporia") -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    mem = os.environ.get("EMPORIA_DRIVER_MEMORY")
    if mem:
        builder = builder.config("spark.driver.memory", mem)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Uses ``spark.checkpoint.dir`` from the session. When it is unset, a folder
    under the system temp dir is set on a single machine (``local`` masters, as
    in tests); on a cluster that raises, since no executor would see it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if configured:
        if not current:
            sc.setCheckpointDir(configured)
        return configured
    if current:
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="emporia-ckpt-")
    sc.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    checkpoint_dir(spark)


# Folders written under the checkpoint dir by this process (id tables, stores).
_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint dir, remembered for ``drop_scratch``."""
    import uuid
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in whatever store it names (through Hadoop's FileSystem)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def drop_scratch(spark: SparkSession) -> int:
    """Delete the folders made by ``scratch_path`` (through Hadoop's FileSystem,
    so it works on any shared store). Call it after the DataFrames that read
    them have been consumed; returns how many folders were removed."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while _SCRATCH:
        p = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            fs.delete(p, True)
            n += 1
    return n
