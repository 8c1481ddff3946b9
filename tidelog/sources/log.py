"""Reading a message log: as a stream, as a bounded slice, or its newest part."""

from __future__ import annotations

import json
from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.envelope import ENVELOPE, LOG_SCHEMA, METADATA, LogOptions
from tidelog.functions.topics import matches
from tidelog.sources.layout import LogFolder

# The file stream would leave out files this much older than the newest it has seen.
_ANY_AGE = "36500d"
_FENCE = "_session_start.json"  # in the checkpoint's folder


def subscribe(spark: SparkSession, options: LogOptions | Mapping[str, Any], after: int | None = None) -> DataFrame:
    """A stream of the messages under one topic filter.

    The position lives in the checkpoint of the query that uses the stream, so
    any number of subscriptions may share a log and a session. Files are read
    whatever their date. A batch limit by
    count makes each micro-batch one landed file, which ``append_batch`` kept
    within the limit, so the log must have been landed under such a limit and
    ``maxFilesPerTrigger`` cannot go with it; a limit by bytes alone is applied by
    the file stream, file by file. ``after`` leaves out messages up to an offset,
    and none that has no offset.

    A clean session begins at the end of the log: batches that are complete when it begins are left out, whatever
    times their messages carry, and all that is landed later arrives. Where it began is kept beside the position if ``checkpointLocation``
    names the checkpoint of the query; started again with it, the session goes on. Without it each subscription is a new session.
    """
    chosen = LogOptions.of(options)
    folder = LogFolder(spark, chosen.path)
    folder.create()
    if chosen.max_batch_messages and (chosen.max_files_per_trigger or 1) > 1:
        raise ValueError("maxBatchMessageNum takes one file for each batch: leave maxFilesPerTrigger out")
    if chosen.max_batch_messages:
        folder.keep_to_limit(chosen.max_batch_messages)
    if chosen.max_batch_bytes and chosen.max_files_per_trigger:
        raise ValueError("give maxBatchMessageSize or maxFilesPerTrigger, not both")
    reader = spark.readStream.schema(LOG_SCHEMA).option("maxFileAge", _ANY_AGE)
    if chosen.max_batch_messages:
        reader = reader.option("maxFilesPerTrigger", 1)
    elif chosen.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", chosen.max_files_per_trigger)
    elif chosen.max_batch_bytes:
        reader = reader.option("maxBytesPerTrigger", chosen.max_batch_bytes)
    if chosen.clean_source:
        reader = reader.option("cleanSource", chosen.clean_source)
    if chosen.archive_dir:
        reader = reader.option("sourceArchiveDir", chosen.archive_dir)
    stored = reader.parquet(chosen.path)
    if after is not None:
        stored = stored.where(F.col("offset").isNull() | (F.col("offset") > after))
    if chosen.clean_session and not chosen.start_timestamp:
        stored = stored.where(_beyond(session_start(spark, chosen)))
    return delivered(stored, chosen)


def session_start(spark: SparkSession, options: LogOptions) -> dict[str, int]:
    """The last batch of each publisher when the clean session began, kept with the checkpoint where one is named."""
    if options.checkpoint:
        kept = LogFolder(spark, options.checkpoint)
        if _FENCE in kept.names(kept.path):
            return json.loads(kept.read_text(f"{kept.path}/{_FENCE}"))
    folder = LogFolder(spark, options.path)
    done = {publisher: folder.batches(publisher) for publisher in folder.publishers()}
    fence = {publisher: batches[-1] for publisher, batches in done.items() if batches}
    if options.checkpoint:  # whole or not at all
        kept.make(kept.path)
        kept.write_text(f"{kept.path}/{_FENCE}.new", json.dumps(fence))
        kept.move(f"{kept.path}/{_FENCE}.new", f"{kept.path}/{_FENCE}")
    return fence


def _beyond(fence: dict[str, int]) -> Column:
    """A condition on the folders alone, so that files behind the fence are not opened."""
    behind = [(F.col("publisher") == publisher) & (F.col("batch_id") <= batch) for publisher, batch in fence.items()]
    return ~reduce(Column.__or__, behind, F.lit(False))


def read_messages(spark: SparkSession, options: LogOptions | Mapping[str, Any]) -> DataFrame:
    """The same messages as :func:`subscribe`, as a bounded frame."""
    chosen = LogOptions.of(options)
    stored = read_log(spark, chosen.path)
    if chosen.clean_session and not chosen.start_timestamp:
        stored = stored.where(_beyond(session_start(spark, chosen)))
    return delivered(stored, chosen)


def read_log(spark: SparkSession, log: str) -> DataFrame:
    """All stored columns of a log, with ``publisher`` and ``batch_id``."""
    return spark.read.schema(LOG_SCHEMA).parquet(log)


def read_slice(spark: SparkSession, log: str, end: int, start: int | None = None, numbered_later: bool = True) -> DataFrame:
    """Messages with ``start < offset <= end``; no start means from the beginning.

    All messages of the log must be numbered; those that are known to have come after the slice need not be, without ``numbered_later``. Only batches, and of those at the ends only files, that hold such offsets
    are listed and opened; the log's index tells which these are.
    """
    after = -1 if start is None else start
    if end < after:
        raise ValueError(f"the slice ends at {end}, before its start {after}")
    paths = LogFolder(spark, log).files_between(after, end, numbered_later)
    if not paths:
        return spark.createDataFrame([], LOG_SCHEMA)
    rows = spark.read.schema(LOG_SCHEMA).option("basePath", log).parquet(*paths)
    return rows.where((F.col("offset") > after) & (F.col("offset") <= end))


def read_newest(spark: SparkSession, log: str, keep: int = 1) -> DataFrame:
    """The last ``keep`` batches of every publisher; older folders are not opened."""
    paths = LogFolder(spark, log).newest_batches(keep)
    if not paths:
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).option("basePath", log).parquet(*paths)


def last_offset(spark: SparkSession, log: str) -> int:
    """The highest offset in the log, -1 before the first numbered message."""
    return LogFolder(spark, log).last_offset()


def delivered(stored: DataFrame, chosen: LogOptions) -> DataFrame:
    """The wanted messages of stored rows, as a subscription gives them."""
    wanted = stored.where(matches("topic", chosen.topic))
    if chosen.start_timestamp:
        wanted = wanted.where(F.col("timestamp") > F.lit(chosen.start_timestamp).cast("timestamp"))
    columns = [F.col(field.name) for field in ENVELOPE.fields]
    if chosen.metadata:
        capped = F.least(F.col("qos"), F.lit(chosen.qos)).alias("qos")
        columns += [capped if f.name == "qos" else F.col(f.name) for f in METADATA.fields]
    return wanted.select(*columns)
