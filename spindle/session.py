"""Session helpers: a local session for tests/bench and the shared scratch folder.

On a cluster the caller owns the session; the library only reads
``spark.checkpoint.dir`` from it.  A folder of our own is created only when that
setting is missing, which is the case for local tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "spindle",
                  driver_memory: str = "8g", extra: dict | None = None) -> SparkSession:
    """A local[cores] session configured the way the tests and bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
        # unload state stores of stopped queries soon (many short replays per session)
        .config("spark.sql.streaming.stateStore.maintenanceInterval", "5s")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_cores(spark: SparkSession) -> int:
    """Task slots of the cluster (``defaultParallelism``), or the shuffle setting
    for sessions without a SparkContext handle (e.g. Spark Connect)."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (or the context's checkpoint dir).

    When neither is set, a local master (tests) gets a fresh local folder, registered as
    the context's checkpoint dir so later calls agree; on a cluster that is an error,
    since executors could not see the driver's folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="spindle-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder path under the shared checkpoint root (not created here)."""
    return f"{checkpoint_root(spark)}/spindle/{name}-{uuid.uuid4().hex[:12]}"
