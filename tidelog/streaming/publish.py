"""Writing messages to a log, one complete folder per batch."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from itertools import accumulate
from typing import Any
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidelog.envelope import LOG_ROW, sink_arguments
from tidelog.functions.payload import encode, from_payload
from tidelog.functions.topics import check_filter, matches
from tidelog.operators.landing import number_once
from tidelog.operators.offsets import number_rows
from tidelog.session import state_settings
from tidelog.sources.layout import LogFolder, Summary
from tidelog.sources.positions import expire

_LANDED = "landed"
_PUBLISHED = "published"
_TAG, _VALUE = "__tag", "value_"


def land(
    df: DataFrame,
    log: str,
    *,
    max_batch_messages: int | None = None,
    max_batch_bytes: int | None = None,
    partition_by: Sequence[str] = (),
    order_by: Sequence[str] = ("timestamp", "id"),
    num_partitions: int | None = None,
) -> int | None:
    """Append envelope rows as the log's next batch, with dense offsets.

    Gives the batch number, or None where there was nothing to land. Rows
    without a ``timestamp`` are stamped with the time of arrival.
    """
    folder = LogFolder(df.sparkSession, log)
    done = folder.batches(_LANDED)
    batch_id = done[-1] + 1 if done else 0
    landed = append_batch(
        df,
        log,
        _LANDED,
        batch_id,
        partition_by=partition_by,
        number=True,
        max_batch_messages=max_batch_messages,
        max_batch_bytes=max_batch_bytes,
        order_by=order_by,
        num_partitions=num_partitions,
    )
    return batch_id if landed else None


def publish(
    df: DataFrame,
    log: str | None = None,
    topic: str | None = None,
    *,
    options: Mapping[str, Any] | None = None,
    qos: int | None = None,
    publisher: str = _PUBLISHED,
    batch_id: int | None = None,
    partition_by: Sequence[str] = (),
    files: int | None = None,
) -> bool:
    """Publish a bounded frame. A batch number already in the log is skipped.

    ``options`` is the option map of a sink; an argument goes before an option.
    """
    chosen = _arguments(options, log=log, topic=topic, qos=qos)
    chosen.pop("checkpoint", None)  # of streams alone
    log = chosen.pop("log")
    messages = encode(df, chosen.pop("topic", None), chosen.pop("qos", None))
    if batch_id is None:
        done = LogFolder(df.sparkSession, log).batches(publisher)
        batch_id = done[-1] + 1 if done else 0
    return append_batch(messages, log, publisher, batch_id, partition_by=partition_by, files=files, **chosen)


def publish_stream(
    df: DataFrame,
    log: str | None = None,
    checkpoint: str | None = None,
    topic: str | None = None,
    *,
    options: Mapping[str, Any] | None = None,
    qos: int | None = None,
    output_mode: str = "append",
    partition_by: Sequence[str] = (),
    files: int | None = None,
    number: bool = False,
    max_batch_messages: int | None = None,
    max_batch_bytes: int | None = None,
    retain_batches: int | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Publish a stream; each micro-batch becomes one folder of the log.

    The folder is named after the query's id, which its checkpoint keeps, and
    the micro-batch. A micro-batch that runs again after a failure is found
    there and skipped. A new checkpoint is a new publisher and skips nothing.
    ``number`` lands the messages with dense offsets; a log then takes numbered
    messages from one running query only. ``files`` limits the files of a
    micro-batch that has no partition columns. ``retain_batches`` deletes the query's
    older batches, which complete mode makes worthless. ``transform`` may rework
    each micro-batch, with any batch operation. ``options`` is the option map of a sink, with ``checkpointLocation``;
    an argument goes before an option.
    """
    chosen = _arguments(
        options, log=log, checkpoint=checkpoint, topic=topic, qos=qos, max_batch_messages=max_batch_messages,
        max_batch_bytes=max_batch_bytes,
    )
    log, checkpoint, topic, qos = (chosen.get(name) for name in ("log", "checkpoint", "topic", "qos"))
    max_batch_messages, max_batch_bytes = chosen.get("max_batch_messages"), chosen.get("max_batch_bytes")
    if not checkpoint:
        raise ValueError("a stream's position needs a place: set `checkpointLocation`")
    if transform is None:
        encode(df, topic, qos)  # refuse a wrong schema before the stream starts

    def write(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        rows = transform(batch) if transform else batch
        if LogFolder(batch.sparkSession, log).is_complete(query_id, batch_id):
            run_through(rows)
            return
        append_batch(
            encode(rows, topic, qos),
            log,
            query_id,
            batch_id,
            partition_by=partition_by,
            files=files,
            number=number,
            max_batch_messages=max_batch_messages,
            max_batch_bytes=max_batch_bytes,
        )
        if retain_batches:
            expire(batch.sparkSession, log, retain_batches, query_id)

    writer = df.writeStream.foreachBatch(write).outputMode(output_mode)
    writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    with state_settings(df):
        return writer.trigger(**(trigger or {"availableNow": True})).start()


def _arguments(options: Mapping[str, Any] | None, **given: Any) -> dict[str, Any]:
    """Arguments that were given, over those that an option map holds."""
    chosen = sink_arguments(options) if options is not None else {}
    chosen.update({name: value for name, value in given.items() if value is not None})
    if not chosen.get("log"):
        raise ValueError("the log's location is missing: set `path` (or `brokerUrl`)")
    return chosen


def store_by_tag(
    df: DataFrame,
    out: str,
    checkpoint: str,
    formats: Mapping[str, tuple[str, T.StructType | str, str]],
    *,
    trigger: dict | None = None,
) -> StreamingQuery:
    """One table for each tag of a multiplexed stream: ``{table: (topic filter, schema, json or csv)}``.

    A micro-batch is read once and written once, whatever the number of tags: a message has a row for each tag it falls
    under, decoded for that tag alone, and the rows of a tag go to a folder of their own. These folders are
    then renamed into the tables, under ``<out>/<table>``, which :func:`read_tag` reads. There is no shuffle, so a tag
    with most of the messages stays spread over the tasks that read them.
    """
    for table, (topic_filter, _, _) in formats.items():
        check_filter(topic_filter)
        if not table or table.startswith(("_", ".")) or "/" in table:
            raise ValueError(f"{table!r} cannot be the folder of a table")

    def write(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        folders = {table: LogFolder(batch.sparkSession, f"{out}/{table}") for table in formats}
        missing = {table: folder for table, folder in folders.items() if not folder.is_complete(query_id, batch_id)}
        if not missing:
            run_through(batch)
            return
        staging = LogFolder(batch.sparkSession, out).staging_path(query_id, batch_id)
        tagged(batch, formats).write.partitionBy(_TAG).parquet(staging)
        for number, (table, folder) in enumerate(folders.items()):
            if table in missing:
                staged = f"{staging}/{_TAG}={number}"
                folder.make(staged)  # without a message there is none: an empty batch says that it was looked at
                folder.commit(staged, query_id, batch_id)
        folder.discard(staging)

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def tagged(messages: DataFrame, formats: Mapping[str, tuple[str, T.StructType | str, str]]) -> DataFrame:
    """A row for each message and tag: id, topic, timestamp, a column of values for each table, and the tag's number."""
    tags = [F.when(matches("topic", topic_filter), F.lit(number)) for number, (topic_filter, _, _) in enumerate(formats.values())]
    rows = messages.select("id", "topic", "timestamp", "payload", F.explode(F.array_compact(F.array(*tags))).alias(_TAG))
    values = [
        F.when(F.col(_TAG) == number, from_payload("payload", schema, format)).alias(f"{_VALUE}{number}")
        for number, (_, schema, format) in enumerate(formats.values())
    ]
    return rows.select("id", "topic", "timestamp", *values, _TAG)


def read_tag(
    spark: SparkSession, out: str, table: str, formats: Mapping[str, tuple[str, T.StructType | str, str]]
) -> DataFrame:
    """A table of :func:`store_by_tag`, with the formats it was stored by: id, topic, timestamp, value."""
    number = list(formats).index(table)
    _, schema, _ = formats[table]
    kind = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    fields = [field for field in LOG_ROW.fields if field.name in ("id", "topic", "timestamp")]
    stored = spark.read.schema(T.StructType([*fields, T.StructField(f"{_VALUE}{number}", kind)]))
    return stored.parquet(f"{out}/{table}").withColumnRenamed(f"{_VALUE}{number}", "value")


def run_through(rows: DataFrame) -> None:
    """Compute a skipped batch all the same: state that it updates must be committed again."""
    rows.write.format("noop").mode("overwrite").save()


def append_batch(
    messages: DataFrame,
    log: str,
    publisher: str,
    batch_id: int,
    *,
    partition_by: Sequence[str] = (),
    files: int | None = None,
    number: bool = False,
    max_batch_messages: int | None = None,
    max_batch_bytes: int | None = None,
    order_by: Sequence[str] = ("timestamp", "id"),
    num_partitions: int | None = None,
) -> bool:
    """Write one batch aside and rename it into the log; False where nothing was added.

    Readers see either none of a batch or all of it. A batch that is already in
    the log is left as it is: writing it again would make new files, which a
    stream that has read the old ones would read a second time.

    With a batch limit every file is one future micro-batch: it keeps to the
    limits and files are dated in arrival order. Where a reader has subscribed under a limit of messages, all later
    batches keep to it, whether they give one or not. Otherwise every task writes a
    file; ``files`` gathers the rows into that many first, for the small results
    of a state with many partitions.
    """
    if partition_by and (max_batch_messages or max_batch_bytes):
        raise ValueError("a batch limit and partition columns cannot be combined")
    folder = LogFolder(messages.sparkSession, log)
    if folder.is_complete(publisher, batch_id):
        return False
    folder.fix_layout(list(partition_by))
    kept = folder.limit()
    rows = _log_rows(messages, int(time.time() * 1_000_000))
    if number or max_batch_messages or max_batch_bytes:
        if kept and not partition_by:
            max_batch_messages = min(kept, max_batch_messages or kept)
        staging = folder.staging_path(publisher, batch_id)
        staged, summary, zones = f"{staging}/rows", None, []
        if partition_by:
            rows, count = number_rows(rows.drop("offset"), f"{staging}/numbered", order_by, folder.last_offset() + 1, num_partitions)
            if count:
                _write_rows(rows, staged, partition_by, files, kept)
                summary, zones = _checked(messages.sparkSession, staged, folder.last_offset() + 1, count, whole=False)
        else:
            limits = (max_batch_messages, max_batch_bytes)
            summary, zones = _write_numbered(folder, rows.drop("offset"), staging, order_by, num_partitions, limits)
        if summary is None:
            folder.discard(staging)
            return False
        folder.describe(staged, summary, zones)
    else:
        staging = folder.staging_path(publisher, batch_id)
        staged, summary = f"{staging}/rows", Summary(most=kept)
        _write_rows(rows, staged, partition_by, files, kept)
        folder.describe(staged, summary)
    folder.commit(staged, publisher, batch_id, summary)
    folder.discard(staging)
    return True


def _write_numbered(
    folder: LogFolder, rows: DataFrame, staging: str, order_by: Sequence[str], num_partitions: int | None,
    limits: tuple[int | None, int | None],
) -> tuple[Summary | None, list[dict]]:
    """Write rows with their offsets; None where there are no rows.

    Rows that do not come out the same when they are read again get wrong offsets, which is seen in the files.
    They are then stored as they were read, and written from there.
    """
    spark = rows.sparkSession
    start, started_ms = folder.last_offset() + 1, int(time.time() * 1000)
    limited = any(limits)
    for attempt in ("read", "stored"):
        if attempt == "stored":
            rows.write.parquet(f"{staging}/stored")
            rows = spark.read.schema(rows.schema).parquet(f"{staging}/stored")
        staged = f"{staging}/rows"
        landing = number_once(rows, f"{staging}/{attempt}", order_by, start, num_partitions, *limits)
        if not landing.count:
            return None, []
        stored = [field.name for field in LOG_ROW.fields]
        writer = landing.rows.select(*stored, *(["admission"] if limited else [])).write.mode("overwrite")
        (writer.partitionBy("admission") if limited else writer).parquet(staged)
        summary, zones = _checked(spark, staged, start, landing.count)
        if summary:
            break
    else:
        raise RuntimeError("rows that were stored got other offsets when they were read again")
    if limited:
        lifted = folder.flatten_in_order(staged, "admission", started_ms)
        zones = [{**zone, "file": lifted[zone["file"]]} for zone in zones]
    return summary, zones


def _checked(spark: SparkSession, staged: str, start: int, count: int, whole: bool = True) -> tuple[Summary | None, list[dict]]:
    """What the staged files hold, from a scan of their offsets alone; no summary where they are not the offsets planned.

    ``whole`` says that each file has all offsets from its first to its last.
    """
    offsets = spark.read.schema("offset BIGINT").option("recursiveFileLookup", "true").parquet(staged)
    found = offsets.groupBy(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes")).agg(
        F.count("offset").alias("rows"), F.min("offset").alias("first"), F.max("offset").alias("last")
    ).orderBy("first").collect()  # one row for each file
    zones = []
    for row in found:
        name = unquote(row["path"]).split(f"{staged.rsplit('/', 2)[-2]}/rows/", 1)[1]
        zones.append({"file": name, "rows": row["rows"], "bytes": row["bytes"], "first": row["first"], "last": row["last"]})
    right = sum(zone["rows"] for zone in zones) == count
    if whole:
        begins = list(accumulate((zone["rows"] for zone in zones), initial=start))
        right &= all(zone["first"] == begin for zone, begin in zip(zones, begins))
        right &= all(zone["last"] - zone["first"] + 1 == zone["rows"] for zone in zones)
    if not right:
        return None, []
    return Summary(count, start, start + count - 1, max(zone["rows"] for zone in zones)), zones


def _write_rows(rows: DataFrame, staged: str, partition_by: Sequence[str], files: int | None, most: int | None) -> None:
    rows = rows.select(*[field.name for field in LOG_ROW.fields])
    if files and not partition_by:
        rows = rows.repartition(files)
    for name in partition_by:  # a folder cannot be named by it, and would be read back as NULL
        empty = F.raise_error(F.lit(f"`{name}` is empty, and the log is partitioned by it"))
        rows = rows.withColumn(name, F.when(F.col(name).cast("string") == "", empty).otherwise(F.col(name)))
    writer = (_spread(rows, partition_by) if partition_by else rows).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if most:
        writer = writer.option("maxRecordsPerFile", most)
    writer.parquet(staged)


def _log_rows(messages: DataFrame, now_us: int) -> DataFrame:
    """All stored columns, those not given as NULL or, for the time, as now."""
    columns = []
    for field in LOG_ROW.fields:
        if field.name in messages.columns:
            columns.append(F.col(field.name).cast(field.dataType).alias(field.name))
        elif field.name == "timestamp":
            columns.append(F.timestamp_micros(F.lit(now_us)).alias("timestamp"))
        else:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
    return messages.select(*columns)


def _spread(rows: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring each partition value together, but a hot one in several tasks.

    Adaptive execution splits what is too large for one task. Stateful streams
    run without it; there each task writes its own rows, a file for each value it has.
    """
    if rows.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        return rows.hint("rebalance", *[F.col(name) for name in partition_by])
    return rows
