"""Session helpers: building a session for local runs and finding the shared work folder.

On a cluster the session is given to us; we only read ``spark.checkpoint.dir`` from it and put
every file we write (changelog copies, stream checkpoints, logs) under that shared folder.  Only
when it is unset (tests, a bare local session) do we set one ourselves.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Settings for local runs and tests.  AQE stays on so joins re-plan from runtime sizes and skewed
# partitions are split; the UI stays off (no server).
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where an aggregate on the same key follows the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Broadcast only what was measured: static plan-time estimates never broadcast; AQE
    # converts a sort-merge join into a broadcast one when a finished stage is under 10 MB.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


# SQL settings recommended for batch work on a large cluster (all settable at runtime on a
# session).  Shuffle partitions follow the largest shuffle: about 150 MB each before AQE coalesces.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.shuffle.partitions": "300000",
    "spark.sql.session.timeZone": "UTC",
}

# For streaming sessions: every shuffle partition of a stateful operator is a state store, so their
# number follows the state and the micro-batch, not the whole table, and is fixed by the checkpoint.
STREAM_CONF = {
    **CLUSTER_CONF,
    "spark.sql.shuffle.partitions": "2000",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


# Keyed state (``transformWithState``) exists in RocksDB only; Spark's default store has none.
KEYED_STATE_CONF = {k: v for k, v in STREAM_CONF.items() if ".stateStore." in k}
_KEYED_STATE = threading.Lock()


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """A streaming query started inside has a state store for keyed state, whatever the session's
    is: a query takes over the settings at its start, and the session's own are put back."""
    with _KEYED_STATE:
        before = {key: spark.conf.get(key, None) for key in KEYED_STATE_CONF}
        apply_conf(spark, KEYED_STATE_CONF)
        try:
            yield
        finally:
            for key, value in before.items():
                spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def apply_conf(spark: SparkSession, conf: dict[str, str] = CLUSTER_CONF) -> None:
    """Apply runtime SQL settings to a session the cluster gave us."""
    for key, value in conf.items():
        spark.conf.set(key, value)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "deltaq") -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    for key, value in LOCAL_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _session_checkpoint_dir(spark: SparkSession) -> str | None:
    value = spark.conf.get(CHECKPOINT_CONF, None)
    if value:
        return value
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # Spark Connect has no SparkContext
        return None


def _is_local(spark: SparkSession) -> bool:
    try:
        master = spark.sparkContext.master
    except Exception:  # Spark Connect: a cluster as far as we can tell
        return False
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the session.  Only a single-machine session may do without one: there
    a temporary folder is as shared as any."""
    current = _session_checkpoint_dir(spark)
    if current:
        return current
    if not _is_local(spark):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="deltaq-ckpt-")
    spark.conf.set(CHECKPOINT_CONF, local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def _work_base(spark: SparkSession) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/deltaq/{spark.conf.get('spark.app.id', 'app')}"


def work_dir(spark: SparkSession, name: str) -> str:
    """The path of a fresh folder under the shared folder, for one run of one job.  Writers make it
    on the file system it is on."""
    return f"{_work_base(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def retire_work(spark: SparkSession) -> None:
    """Remove every work folder of this application, once its results are consumed."""
    from .sources.storage import remove

    remove(spark, _work_base(spark))
