"""Reading back what a stream in update mode has published: the newest row of each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.payload import from_payload
from tidelog.sources.layout import LogFolder
from tidelog.sources.log import read_log

_SNAPSHOTS = "_snapshots"  # in the log's folder, where readers of the log do not look


def read_changes(spark: SparkSession, log: str, schema: T.StructType | str, keys: Sequence[str]) -> DataFrame:
    """The rows that a query in update mode has published to a log of its own, each key as it was published last.

    Payloads hold ``schema``. Micro-batches are ordered by their number; within one a key comes once. Rows are reduced on
    the map side, so a key that changed in every micro-batch is one row for each task.
    """
    rows = _changes(spark, log, schema)
    snapshot = _snapshot(spark, log)
    if snapshot is not None:
        upto, path = snapshot
        kind = T.StructType([*_fields(schema), T.StructField("__batch", T.LongType())])
        rows = rows.where(F.col("__batch") > upto).unionByName(spark.read.schema(kind).parquet(path))
    return _newest(rows, keys).drop("__batch")


def compact_changes(spark: SparkSession, log: str, schema: T.StructType | str, keys: Sequence[str]) -> int | None:
    """Put the newest rows of all complete micro-batches into a snapshot and delete these micro-batches.

    Gives the number of the last one, or None where there is nothing to do. The snapshot is complete before anything is deleted;
    what a crash leaves behind in between is read as part of the snapshot. Streams that read the log
    do not see snapshots: compact a log once they have read it.
    """
    folder = LogFolder(spark, log)
    publisher = _publisher(folder)
    done = folder.batches(publisher) if publisher else []
    old = _snapshot(spark, log)
    if not done or (old is not None and done[-1] <= old[0]):
        return None
    upto = done[-1]
    rows = _changes(spark, log, schema).where(F.col("__batch") <= upto)
    if old is not None:
        kind = T.StructType([*_fields(schema), T.StructField("__batch", T.LongType())])
        rows = rows.where(F.col("__batch") > old[0]).unionByName(spark.read.schema(kind).parquet(old[1]))
    staged = folder.staging_path("snapshot", upto)
    _newest(rows, keys).write.parquet(staged)
    folder.make(f"{folder.path}/{_SNAPSHOTS}")
    folder.move(staged, f"{folder.path}/{_SNAPSHOTS}/upto={upto}")
    for batch_id in done:
        folder.drop_batch(publisher, batch_id)
    if old is not None:
        folder.discard(old[1])
    return upto


def _publisher(folder: LogFolder) -> str | None:
    publishers = folder.publishers()
    if len(publishers) > 1:
        raise ValueError(f"{folder.path} holds the changes of {len(publishers)} queries; their micro-batches have no common order")
    return publishers[0] if publishers else None


def _snapshot(spark: SparkSession, log: str) -> tuple[int, str] | None:
    folder = LogFolder(spark, log)
    ends = [int(value) for value in folder.values(f"{folder.path}/{_SNAPSHOTS}", "upto")]
    return (max(ends), f"{folder.path}/{_SNAPSHOTS}/upto={max(ends)}") if ends else None


def _fields(schema: T.StructType | str) -> list[T.StructField]:
    return (schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)).fields


def _changes(spark: SparkSession, log: str, schema: T.StructType | str) -> DataFrame:
    _publisher(LogFolder(spark, log))
    return read_log(spark, log).select(from_payload("payload", schema).alias("row"), F.col("batch_id").alias("__batch")).select(
        "row.*", "__batch"
    )


def _newest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    others = [name for name in rows.columns if name not in keys]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), "__batch").alias("__row"))
    return newest.select(*[F.col(name) if name in keys else F.col(f"__row.{name}") for name in rows.columns])
