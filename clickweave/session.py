"""Session set-up and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHECKPOINT_DIR = "spark.checkpoint.dir"
ADAPTIVE = "spark.sql.adaptive.enabled"

# Timestamps travel as UTC text, so everything is read and written in UTC. Streaming state goes
# to RocksDB: distinct ids of the open windows need not fit in executor heap.
CONF = {
    "spark.sql.session.timeZone": "UTC",
    ADAPTIVE: "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # A user with many events in a batch sends merged sessions through the shuffle, not events.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def create_session(
    app_name: str = "clickstream-analytics", master: str | None = None, **conf: str
) -> SparkSession:
    """Build a session; `conf` keys use `__` for dots and win over the defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**CONF, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def streaming_session(spark: SparkSession) -> SparkSession:
    """A sibling session with RocksDB state, leaving the caller's settings alone."""
    sibling = spark.newSession()
    for key in ("spark.sql.shuffle.partitions", "spark.sql.ansi.enabled"):
        sibling.conf.set(key, spark.conf.get(key))
    for key, value in CONF.items():
        sibling.conf.set(key, value)
    return sibling


@contextmanager
def adaptive(spark: SparkSession) -> Iterator[None]:
    """Adaptive execution for what a foreachBatch function does with its batch.

    A stream turns it off in its session, for its own plan. Without it the rebalancing before a
    write does nothing, and every shuffle partition writes a file into every folder.
    """
    before = spark.conf.get(ADAPTIVE)
    spark.conf.set(ADAPTIVE, "true")
    try:
        yield
    finally:
        spark.conf.set(ADAPTIVE, before)


# A store's writes reach its files when a batch is committed, so none waits in memory between batches,
# and what all stores of an executor hold meanwhile, and the blocks they read, share one allowance.
BOUNDED_STATE = {
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}


@contextmanager
def bounded_state(spark: SparkSession) -> Iterator[None]:
    """For the start of a query with state that grows without end: its memory does not.

    RocksDB keeps up to 64 MB of writes and 8 MB of blocks per store outside of the heap, and an
    executor has a store for every partition it ever held. A query keeps the settings it started with.
    """
    before = {key: spark.conf.get(key, None) for key in BOUNDED_STATE}
    for key, value in BOUNDED_STATE.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


#: Scratch folders named so far, by application.
_SCRATCH: dict[str, list[str]] = defaultdict(list)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder.

    Only a local session without that setting falls back to a temporary folder. The folder stays,
    as results may be read from it, until `delete_scratch`.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        base = tempfile.mkdtemp(prefix="clickweave-")
    path = f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    _SCRATCH[spark.sparkContext.applicationId].append(path)
    return path


def delete_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders this application has made; results that read them are gone then.

    Returns how many there were. Call it between jobs, when what they gave has been written.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = _SCRATCH.pop(spark.sparkContext.applicationId, [])
    deleted = 0
    for path in paths:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        deleted += folder.getFileSystem(conf).delete(folder, True)
    return deleted


def materialize(rows: DataFrame, purpose: str) -> DataFrame:
    """Write the rows to a table in the shared scratch folder and read them back.

    For results that several branches of a plan read: each branch would otherwise compute them
    again. The table survives lost executors.
    """
    path = scratch_dir(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
