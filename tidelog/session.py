"""Session settings this library is meant to run under, and its scratch space."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# RocksDB keeps state beyond the heap, and without counting its rows need not read
# before each write; the checksum pair makes Spark redo a whole
# stage when a re-run map task did not reproduce the rows it wrote the first time.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.orderIndependentChecksum.enabled": "true",
    "spark.sql.shuffle.orderIndependentChecksum.enableFullRetryOnMismatch": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}

_PARTITIONS = "spark.sql.shuffle.partitions"
_STATE = "spark.sql.streaming.stateStore."
# What a stateful query starts with where the session says nothing else. The instances of an executor share one bound of memory.
_STATE_STORE = {
    **{key: value for key, value in RECOMMENDED.items() if key.startswith(_STATE)},
    f"{_STATE}rocksdb.boundedMemoryUsage": "true",
}
_LEAST_STATE_PARTITIONS = 8
_STATEFUL = ("Aggregate", "Deduplicate", "DeduplicateWithinWatermark", "FlatMapGroupsInPandasWithState", "Join")


def configured(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Put the recommended settings on a session builder."""
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    return builder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name in the storage that all executors share.

    The cluster names that storage in ``spark.checkpoint.dir``. Only a local
    session, whose executors are this machine, may do without it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def holds_state(stream: DataFrame) -> bool:
    """Whether a step of the stream keeps state from one micro-batch to the next."""
    nodes = [stream._jdf.queryExecution().analyzed()]
    while nodes:
        node = nodes.pop()
        if not node.isStreaming():
            continue
        below = node.children()
        inputs = [below.apply(n) for n in range(below.size())]
        name = node.nodeName()
        if name in _STATEFUL and (name != "Join" or all(child.isStreaming() for child in inputs)):
            return True
        nodes += inputs
    return False


@contextmanager
def state_settings(stream: DataFrame) -> Iterator[None]:
    """Settings under which a stream is to be started: a query takes them over at its start, and its checkpoint keeps them.

    Every micro-batch visits every state partition, however few rows it has, and writes a file for each. So there are as many as
    the session has cores, unless it wants fewer, and RocksDB holds the state, unless the session names a store. A stream without state keeps
    the session's settings.
    """
    spark = stream.sparkSession
    if not holds_state(stream):
        yield
        return
    given = spark.conf.getAll
    most = max(_LEAST_STATE_PARTITIONS, spark.sparkContext.defaultParallelism)
    wanted = {_PARTITIONS: str(min(int(spark.conf.get(_PARTITIONS)), most))}
    if f"{_STATE}providerClass" not in given:
        wanted |= {key: value for key, value in _STATE_STORE.items() if key not in given}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in wanted:
            if key in given:
                spark.conf.set(key, given[key])
            else:
                spark.conf.unset(key)
