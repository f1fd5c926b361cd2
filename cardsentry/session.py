"""Session construction and the shared working folder.

Tables, checkpoints and file drops written by this library live under the
folder the cluster names in ``spark.checkpoint.dir`` (a shared file system on a
real cluster).  A private temporary folder is only used when that setting is
missing, which happens in unit tests and local sessions.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on.  Session time zone is pinned so that event
# times parsed from text and window boundaries do not depend on the machine.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Stateful operators (window counts, stream-stream joins) keep their
    # state in RocksDB: off-heap, spills to local disk, incremental
    # checkpoints through the changelog.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Sizing for a large cluster (about 1000 executors, 100 TB of input).  Batch
# jobs let AQE pick the number of shuffle partitions from the data (coalescing
# towards ~256 MB per partition, splitting skewed ones); file scans cut input
# into 256 MB splits.  Stateful streaming queries cannot re-plan their state
# partitions: ``spark.sql.shuffle.partitions`` at the first start of such a
# query fixes them for the life of its checkpoint, so it is set for the
# largest expected state (a few partitions per core).
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "32000",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.minBatchesToRetain": "20",
}

# Runtime SQL settings a query of this library needs even in a session it did
# not build (the defaults above that can still be changed after start-up).
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str | None = None, app_name: str = "cardsentry",
                  shuffle_partitions: int | None = None,
                  conf: dict[str, str] | None = None, cluster: bool = False) -> SparkSession:
    """Session with the library's settings; ``cluster=True`` adds the sizing
    of ``CLUSTER_CONF`` (explicit ``shuffle_partitions`` / ``conf`` win)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if cluster:
        settings.update(CLUSTER_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the queries depend on to an existing session."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    provider = "spark.sql.streaming.stateStore.providerClass"
    if not spark.conf.get(provider, None):
        spark.conf.set(provider, DEFAULT_CONF[provider])
    return spark


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Set one only where none is configured and the session is local (tests).
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        current = sc.getCheckpointDir()
        if current:
            return current.rstrip("/")
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="cardsentry-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def run_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder for one run (tables, checkpoints, file drops)."""
    return f"{shared_root(spark)}/cardsentry/{label}-{uuid.uuid4().hex[:12]}"
