"""One query for each operator, over the whole of the given tables.

Payloads come out as text or as a digest and times without a zone, so that any
SQL engine can state the same result.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.envelope import ENVELOPE, LogOptions
from tidelog.functions.payload import (
    as_text, decoded, encode, from_payload, parse_rows, parse_with, tokens, with_dead_letters,
)
from tidelog.functions.topics import matches
from tidelog.operators import counts, dedupe, offsets, routing
from tidelog.operators.admission import batches_in_turn
from tidelog.plans.tables import (
    document_messages,
    event_messages,
    event_part,
    landed,
    packet_id,
    table,
)
from tidelog.session import scratch_path
from tidelog.sources.landed_text import read_landed_text, render_landed_lines
from tidelog.sources.layout import LogFolder
from tidelog.sources.log import (
    last_offset,
    read_log,
    read_messages,
    read_newest,
    read_slice,
    subscribe,
)
from tidelog.sources.positions import expire
from tidelog.streaming import backfill as tail
from tidelog.streaming import changes
from tidelog.streaming.publish import land, publish, publish_stream, read_tag, store_by_tag
from tidelog.streaming.results import keep, newest_result

Query = Callable[[SparkSession, str], DataFrame]

# Limits of one micro-batch in the queries that land under one.
_MOST_MESSAGES = 25_000
_MOST_BYTES = 256 << 10
_MOST_DOCUMENT_BYTES, _MOST_DOCUMENTS = 64 << 10, 25
_BACKLOG = 200
_SLICES = 8
_CLEAN_START = "2024-01-16 00:00:00"

ROUTES = [
    ("events/click", "clicks"),
    ("events/#", "all"),
    ("events/+", "all"),
    ("events/error", "alerts"),
    ("events/purchase", "alerts"),
    ("events/purchase", "sales"),
    ("docs/#", "texts"),
]


def _text(messages: DataFrame) -> DataFrame:
    return messages.select(
        "id", "topic", as_text("payload").alias("payload"), _time("timestamp").alias("timestamp")
    )


def _time(column: str):
    return F.col(column).cast("timestamp_ntz")


def _kept(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    out, checkpoint = scratch_path(spark, name), scratch_path(spark, f"{name}-position")
    keep(stream, out, checkpoint).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def _events(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    chosen = LogOptions(landed(spark, sf_dir, "events"), "events/#", **options)
    return subscribe(spark, chosen)


# Sources


def log_stream_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text(_kept(spark, _events(spark, sf_dir), "scan"))


def land_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = scratch_path(spark, "land")
    land(event_messages(spark, sf_dir), log)
    rows = read_log(spark, log)
    return rows.select("id", "topic", as_text().alias("payload"), _time("timestamp").alias("timestamp"), "offset")


def offset_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = landed(spark, sf_dir, "events")
    top = last_offset(spark, log)
    part = read_slice(spark, log, end=top * 3 // 4, start=top // 4)
    return part.select("id", "topic", as_text().alias("payload"), "offset")


def slice_mixed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A slice of a log of batches that were landed under different limits, and in part as a stream."""
    messages = event_messages(spark, sf_dir)
    log = scratch_path(spark, "mixed")
    land(event_part(messages, 0), log)
    land(event_part(messages, 1), log, max_batch_messages=_MOST_MESSAGES // 5)
    source = scratch_path(spark, "mixed-source")
    publish(event_part(messages, 2), source)
    stream = subscribe(spark, LogOptions(source, "events/#", metadata=True)).drop("offset")
    publish_stream(stream, log, scratch_path(spark, "mixed-position"), number=True).awaitTermination()
    land(event_part(messages, 3), log, max_batch_bytes=_MOST_BYTES)
    top = last_offset(spark, log)
    part = read_slice(spark, log, end=top * 7 // 8, start=top // 8)
    return part.select("id", "topic", as_text().alias("payload"), "offset")


def empty_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = landed(spark, sf_dir, "events")
    top = last_offset(spark, log)
    return _text(read_slice(spark, log, end=top, start=top))


def landed_text_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "text")
    render_landed_lines(event_messages(spark, sf_dir)).write.text(out)
    return _text(read_landed_text(spark, out))


def topic_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text(read_messages(spark, {"path": landed(spark, sf_dir, "all"), "topic": "events/click"}))


def topic_wildcards(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = read_log(spark, landed(spark, sf_dir, "all")).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
    filters = ["#", "+/click", "+/+", "docs/#", "docs/+", "events/error", "+"]
    named = F.explode(
        F.filter(
            F.array(*[F.when(matches("topic", f), F.lit(f)) for f in filters]), lambda f: f.isNotNull()
        )
    )
    return log.select(named.alias("filter"), "topic", F.col("n").alias("messages"))


def qos_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = {"path": landed(spark, sf_dir, "events"), "topic": "events/#", "QoS": "1", "metadata": "true"}
    return read_messages(spark, options).select("id", "qos", "retained", "duplicate")


def assign_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = scratch_path(spark, "numbered")
    return offsets.assign_offsets(
        event_messages(spark, sf_dir).select("id", "topic", "timestamp"), staging
    ).select("id", "topic", "offset")


def offset_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = landed(spark, sf_dir, "events")
    slice_ = offsets.slice_number("offset", -1, last_offset(spark, log), _SLICES)
    return read_log(spark, log).select("id", "offset", slice_.alias("slice"))


def batch_by_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = event_messages(spark, sf_dir)
    return _limited_batches(spark, messages, max_batch_messages=_MOST_MESSAGES)


def batch_by_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = event_messages(spark, sf_dir)
    return _limited_batches(spark, messages, max_batch_bytes=_MOST_BYTES)


def byte_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = read_log(spark, landed(spark, sf_dir, "documents")).select("offset", F.length("payload").alias("size"))
    return batches_in_turn(sized, scratch_path(spark, "byte-batches"), max_bytes=_MOST_DOCUMENT_BYTES)


def both_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = read_log(spark, landed(spark, sf_dir, "documents")).select("offset", F.length("payload").alias("size"))
    staging = scratch_path(spark, "both-batches")
    return batches_in_turn(sized, staging, _MOST_DOCUMENT_BYTES, _MOST_DOCUMENTS, rows_per_slice=1 << 9)


def _limited_batches(spark: SparkSession, messages: DataFrame, **limit: int) -> DataFrame:
    log, out = scratch_path(spark, "limited"), scratch_path(spark, "limited-out")
    land(messages, log, **limit)
    stream = subscribe(spark, LogOptions(log, "events/#", max_files_per_trigger=1))
    publish_stream(stream, out, scratch_path(spark, "limited-position")).awaitTermination()
    return read_log(spark, out).groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("messages"),
        F.sum(F.length("payload")).alias("bytes"),
        F.min(_time("timestamp")).alias("first_time"),
        F.max(_time("timestamp")).alias("last_time"),
    )


def resume_after_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = event_messages(spark, sf_dir)
    log, out, position = (scratch_path(spark, f"resume-{part}") for part in ("log", "out", "position"))
    for run in range(2):
        for part in (2 * run, 2 * run + 1):
            land(event_part(messages, part), log)
        # The second run is a new query on the same checkpoint.
        keep(subscribe(spark, LogOptions(log, "events/#")), out, position).awaitTermination()
    return _text(spark.read.parquet(out))


def replay_old_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches that come with files of years ago, after newer ones were read."""
    messages = event_messages(spark, sf_dir)
    log, out, position = (scratch_path(spark, f"old-{part}") for part in ("log", "out", "position"))
    for part in range(4):
        batch = land(event_part(messages, part), log)
        if part % 2 and batch is not None:
            LogFolder(spark, log).date_files("landed", batch, 1_000_000_000_000 + part)
        keep(subscribe(spark, LogOptions(log, "events/#")), out, position).awaitTermination()
    return _text(spark.read.schema(ENVELOPE).parquet(out))


def retention_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text(read_newest(spark, landed(spark, sf_dir, "parts"), keep=2))


def backfill_then_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = event_messages(spark, sf_dir)
    log, out, position = (scratch_path(spark, f"backfill-{part}") for part in ("log", "out", "position"))
    options = {"path": log, "topic": "events/#"}
    for part in (0, 1):
        land(event_part(messages, part), log)
    # The work is ended in the midst of the backfill; more is landed before it goes on.
    tail.backfill(spark, options, out, position, _SLICES, at_most=3)
    land(event_part(messages, 2), log)
    tail.backfill_then_tail(spark, options, out, position, _SLICES).awaitTermination()
    land(event_part(messages, 3), log)
    tail.backfill_then_tail(spark, options, out, position, _SLICES).awaitTermination()
    return _text(read_log(spark, out))


def retention_consumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of a log where one reader has read the first part and another one three."""
    messages = event_messages(spark, sf_dir)
    log = scratch_path(spark, "consumed")
    slow, quick = scratch_path(spark, "slow-position"), scratch_path(spark, "quick-position")
    for part in range(4):
        land(event_part(messages, part), log)
        readers = {0: [slow, quick], 1: [quick], 2: [quick], 3: []}[part]
        for position in readers:
            out = scratch_path(spark, "consumed-out")
            publish_stream(subscribe(spark, LogOptions(log, "events/#")), out, position).awaitTermination()
    expire(spark, log, 1, readers=[slow, quick])
    return _text(read_log(spark, log))


def clean_session_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A clean session gets what is landed after it began, though all of it carries older times."""
    messages = event_messages(spark, sf_dir)
    log, out, position = (scratch_path(spark, f"session-{part}") for part in ("log", "out", "position"))
    options = {"path": log, "topic": "events/#", "cleanSession": "true", "checkpointLocation": position}
    for part in (3, 2):
        land(event_part(messages, part), log)
    keep(subscribe(spark, options), out, position).awaitTermination()
    for part in (1, 0):  # each time the session is started again
        land(event_part(messages, part), log)
        keep(subscribe(spark, options), out, position).awaitTermination()
    return _text(spark.read.schema(ENVELOPE).parquet(out))


def clean_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = _events(spark, sf_dir, clean_session=True, start_timestamp=_CLEAN_START)
    return _text(_kept(spark, stream, "clean"))


def multi_subscribe(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = landed(spark, sf_dir, "all")
    running, outs = [], {}
    for topic in ("events/click", "events/+", "docs/#"):
        outs[topic] = scratch_path(spark, "multi")
        stream = subscribe(spark, {"path": log, "topic": topic})
        running.append(keep(stream, outs[topic], scratch_path(spark, "multi-position")))
    for query in running:
        query.awaitTermination()
    received = [
        spark.read.parquet(out).select(F.lit(topic).alias("subscription"), "id", "topic", _md5())
        for topic, out in outs.items()
    ]
    return routing.fan_in(*received)


def _md5():
    return F.md5("payload").alias("digest")


# Sinks


def encode_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        F.concat(F.lit("users/"), "user_id").alias("topic"), "event_id", "event_type", "props"
    )
    messages = encode(events)
    back = from_payload("payload", "event_id BIGINT, event_type STRING, props STRING")
    return messages.select("topic", back.alias("row")).select("topic", "row.*")


def encode_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = table(spark, sf_dir, "events").select("user_id")
    return encode(values, topic="users", qos=2).select(
        "topic", as_text("payload").alias("payload"), "qos"
    )


def publish_streaming(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, position = scratch_path(spark, "publish"), scratch_path(spark, "publish-position")
    publish_stream(_events(spark, sf_dir), out, position, partition_by=["topic"]).awaitTermination()
    return _text(read_log(spark, out))


def publish_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, position = scratch_path(spark, "again"), scratch_path(spark, "again-position")
    publish_stream(_events(spark, sf_dir), out, position).awaitTermination()
    # As after a crash between publishing and committing: the batch runs again.
    commits = LogFolder(spark, f"{position}/commits")
    for name in ("0", ".0.crc"):
        commits.discard(f"{position}/commits/{name}")
    publish_stream(_events(spark, sf_dir), out, position).awaitTermination()
    return _text(read_log(spark, out))


def publish_idempotent_stateful(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts go on from a state that is whole, though a micro-batch ran again after its result was published."""
    messages = event_messages(spark, sf_dir)
    log, out, position = (scratch_path(spark, f"stateful-{part}") for part in ("log", "out", "position"))
    for part in range(4):
        land(event_part(messages, part), log)
        for crash in (part % 2 == 0, False):
            stream = subscribe(spark, LogOptions(log, "events/#"))
            totals = stream.groupBy(F.col("topic").alias("source")).agg(F.count(F.lit(1)).alias("messages"))
            publish_stream(totals, out, position, "totals", output_mode="complete").awaitTermination()
            if not crash:
                break
            commits = LogFolder(spark, f"{position}/commits")
            last = max(int(name) for name in commits.names(commits.path) if name.isdigit())
            for name in (f"{last}", f".{last}.crc"):
                commits.discard(f"{commits.path}/{name}")
    back = from_payload("payload", "source STRING, messages BIGINT")
    return read_newest(spark, out).select("topic", back.alias("row")).select("topic", "row.*")


def publish_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "publish-batch")
    publish(event_messages(spark, sf_dir), out)
    return _text(read_log(spark, out))


def publish_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = landed(spark, sf_dir, "parts")
    out, position = scratch_path(spark, "complete"), scratch_path(spark, "complete-position")
    stream = subscribe(spark, LogOptions(log, "events/#", max_files_per_trigger=1))
    totals = stream.groupBy(F.col("topic").alias("source")).agg(F.count(F.lit(1)).alias("messages"))
    publish_stream(totals, out, position, "totals", output_mode="complete").awaitTermination()
    back = from_payload("payload", "source STRING, messages BIGINT")
    return read_newest(spark, out).select("topic", back.alias("row")).select("topic", "row.*")


# Decoding and text


def payload_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = read_log(spark, landed(spark, sf_dir, "documents"))
    return log.select("id", as_text("payload", strict=True).alias("payload"))


def decode_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = read_log(spark, landed(spark, sf_dir, "events"))
    return log.select("id", from_payload("payload", "k INT")["k"].alias("k"))


def decode_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "events").select(
        F.concat_ws(",", F.col("event_id").cast("string"), "event_type", F.col("user_id").cast("string"))
        .cast("binary")
        .alias("payload")
    )
    row = from_payload("payload", "event_id BIGINT, event_type STRING, user_id BIGINT", "csv")
    return lines.select(row.alias("row")).select("row.*")


def decode_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    def number_in(raw: bytes) -> int:
        return int(raw[raw.index(b":") + 1 : raw.rindex(b"}")])

    log = read_log(spark, landed(spark, sf_dir, "events"))
    return log.select("id", parse_with(number_in, "int").alias("k"))


def decode_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    def line_lengths(batch: pd.DataFrame) -> pd.DataFrame:
        lines = batch.assign(line=batch["payload"].map(lambda raw: bytes(raw).split(b"\n"))).explode("line")
        place = lines.groupby(level=0).cumcount().astype("int64")
        return pd.DataFrame({"id": lines["id"], "line": place, "bytes": lines["line"].map(len)})

    log = read_log(spark, landed(spark, sf_dir, "documents")).select("id", "payload")
    return parse_rows(log, line_lengths, "id INT, line BIGINT, bytes BIGINT")


def decode_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as JSON, some cut short and some as plain text; what cannot be decoded goes to a topic of its own."""
    whole = F.to_json(F.struct("doc_id", "n_chars"))
    cut = F.expr("left(whole, length(whole) - 1)")
    payload = F.when(F.col("doc_id") % 7 == 0, F.col("text")).when(F.col("doc_id") % 3 == 0, cut).otherwise(F.col("whole"))
    messages = table(spark, sf_dir, "documents").withColumn("whole", whole).select(
        packet_id("doc_id"), F.lit("docs").alias("topic"), payload.cast("binary").alias("payload")
    )
    out = scratch_path(spark, "dead-letters")
    routed = with_dead_letters(messages, decoded("payload", "doc_id BIGINT, n_chars BIGINT"), "docs/unread")
    publish(routed.select("id", "topic", "payload"), out)
    back = with_dead_letters(
        read_log(spark, out).select("id", "topic", "payload"), decoded("payload", "doc_id BIGINT, n_chars BIGINT"), "docs/unread"
    )
    return back.select("id", "topic", F.col("value.n_chars").alias("n_chars"), F.col("error").isNotNull().alias("bad"), _md5())


def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = read_log(spark, landed(spark, sf_dir, "documents"))
    found = tokens(as_text("payload"))
    return log.select("id", found.alias("words")).select(
        "id",
        F.size("words").cast("bigint").alias("words"),
        F.size(F.filter("words", lambda word: word == "")).cast("bigint").alias("empty_words"),
        F.md5(F.concat_ws("|", "words")).alias("digest"),
    )


# Aggregation


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = landed(spark, sf_dir, "documents")
    stream = counts.word_count(subscribe(spark, {"path": log, "topic": "docs/#"}))
    out, position = scratch_path(spark, "words"), scratch_path(spark, "words-position")
    keep(stream, out, position, "complete").awaitTermination()
    return newest_result(spark, out)


def word_count_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.word_count(document_messages(spark, sf_dir))


def word_count_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = landed(spark, sf_dir, "documents")
    out, position = scratch_path(spark, "word-log"), scratch_path(spark, "word-log-position")
    stream = counts.word_count(subscribe(spark, {"path": log, "topic": "docs/#"}))
    publish_stream(stream, out, position, "words", output_mode="complete").awaitTermination()
    back = from_payload("payload", "value STRING, count BIGINT")
    return read_newest(spark, out).select(back.alias("row")).select("row.*")


def window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, position = scratch_path(spark, "windows"), scratch_path(spark, "windows-position")
    keep(counts.window_counts(_events(spark, sf_dir), "1 hour"), out, position, "complete").awaitTermination()
    return _windows(newest_result(spark, out))


def window_counts_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only what changed is published, for parts of the log that do not come in order, and half of it is compacted."""
    messages = event_messages(spark, sf_dir)
    log, out, position = (scratch_path(spark, f"update-{part}") for part in ("log", "out", "position"))
    schema, keys = "start TIMESTAMP, end TIMESTAMP, of STRING, n BIGINT", ["start", "end", "of"]
    columns = ["start", "end", F.col("topic").alias("of"), "n"]  # a column `topic` would be the message's own
    for parts in ((2, 0), (3, 1)):
        for part in parts:
            for half in (0, 1):
                land(event_part(messages, part).where(F.pmod("id", F.lit(2)) == half), log)
        stream = subscribe(spark, LogOptions(log, "events/#", max_files_per_trigger=1))
        counted = counts.window_counts(stream, "1 hour").select(*columns)
        publish_stream(counted, out, position, "windows", output_mode="update").awaitTermination()
        if parts == (2, 0):
            changes.compact_changes(spark, out, schema, keys)
    return _windows(changes.read_changes(spark, out, schema, keys).withColumnRenamed("of", "topic"))


def window_counts_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = counts.window_counts(_events(spark, sf_dir), "1 hour", delay="2 hours")
    return _windows(_kept(spark, stream, "windows-append"))


def window_counts_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = read_log(spark, landed(spark, sf_dir, "events"))
    return _windows(counts.window_counts(log, "1 hour", "30 minutes"))


def _windows(frame: DataFrame) -> DataFrame:
    return frame.select(_time("start").alias("start"), _time("end").alias("end"), "topic", "n")


def _redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events, and every tenth of them once more, five minutes later."""
    messages = event_messages(spark, sf_dir)
    again = messages.where(F.pmod("id", F.lit(10)) == 0).withColumns(
        {"timestamp": F.col("timestamp") + F.expr("INTERVAL 5 MINUTES"), "duplicate": F.lit(True)}
    )
    return messages.unionByName(again)


def dedupe_redelivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = scratch_path(spark, "redelivered")
    messages = _redelivered(spark, sf_dir)
    land(messages, log, max_batch_messages=2 * _MOST_MESSAGES)
    stream = subscribe(spark, LogOptions(log, "events/#", max_files_per_trigger=1))
    once = dedupe.dedupe_stream(stream, "1 hour")
    # Which copy of one micro-batch is kept is open, and so is its time.
    return _text(_kept(spark, once, "deduped")).drop("timestamp")


def dedupe_out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies are dropped and unique messages kept though the batches do not come in the order of their times."""
    messages = _redelivered(spark, sf_dir)
    log = scratch_path(spark, "unordered")
    for part in (3, 1, 0, 2):
        land(event_part(messages, part), log)
    stream = subscribe(spark, LogOptions(log, "events/#", max_files_per_trigger=1))
    return _text(_kept(spark, dedupe.dedupe_stream(stream, "1 hour"), "unordered-out")).drop("timestamp")


def dedupe_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text(dedupe.dedupe(_redelivered(spark, sf_dir)))


def _often_redelivered(spark: SparkSession, sf_dir: str) -> str:
    """A log of four batches: the events, some once more five minutes later and some a day later."""
    messages = event_messages(spark, sf_dir)
    parts = [messages]
    for left, later in ((0, "5 MINUTES"), (5, "1 DAY")):
        again = messages.where(F.pmod("id", F.lit(10)) == left)
        parts.append(again.withColumn("timestamp", F.col("timestamp") + F.expr(f"INTERVAL {later}")))
    log = scratch_path(spark, "often-redelivered")
    everything = routing.fan_in(*parts)
    starts = [f"timestamp'2024-01-{day:02d} 00:00:00'" for day in (9, 17, 25)]
    bounds = ["timestamp'1970-01-01 00:00:00'", *starts, "timestamp'2100-01-01 00:00:00'"]
    for low, high in zip(bounds, bounds[1:]):
        land(everything.where(f"timestamp >= {low} AND timestamp < {high}"), log)
    return log


def dedupe_last_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = read_log(spark, _often_redelivered(spark, sf_dir))
    return _text(dedupe.dedupe_last(log, _BACKLOG))


def dedupe_last_n_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _often_redelivered(spark, sf_dir)
    stream = subscribe(spark, LogOptions(log, "events/#", metadata=True, max_files_per_trigger=1))
    return _text(_kept(spark, dedupe.dedupe_last_stream(stream, _BACKLOG, buckets=_SLICES), "last-n"))


def topic_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = counts.topic_stats(read_log(spark, landed(spark, sf_dir, "events")))
    return stats.withColumns({"first_time": _time("first_time"), "last_time": _time("last_time")})


def gap_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = read_log(spark, landed(spark, sf_dir, "events"))
    clicks = log.where(matches("topic", "events/click"))
    return routing.fan_in(
        offsets.gap_check(log).withColumn("part", F.lit("all")),
        offsets.gap_check(clicks).withColumn("part", F.lit("clicks")),
    )


def gap_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = read_log(spark, landed(spark, sf_dir, "events"))
    return offsets.gap_ranges(log, by=["publisher", "topic"])


# Routing


def fan_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = routing.fan_in(
        read_log(spark, landed(spark, sf_dir, "events")), read_log(spark, landed(spark, sf_dir, "documents"))
    )
    return both.select("id", "topic", _time("timestamp").alias("timestamp"), _md5())


def _routes(spark: SparkSession) -> DataFrame:
    filters, destinations = zip(*ROUTES)
    return spark.createDataFrame(pa.table({"filter": filters, "destination": destinations}))


def route_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    routes = _routes(spark)
    out, position = scratch_path(spark, "routed"), scratch_path(spark, "routed-position")
    stream = subscribe(spark, {"path": landed(spark, sf_dir, "all"), "topic": "#"})
    publish_stream(
        routing.fan_out_table(stream, routes).drop("source_topic"), out, position
    ).awaitTermination()
    return read_log(spark, out).select("topic", "id", _md5())


def route_fanout_by_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    routes = _routes(spark)
    log = read_log(spark, landed(spark, sf_dir, "all"))
    return routing.fan_out_table(log, routes).select("topic", "id", _md5())


def route_fanout_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    routes: dict[str, list[str]] = {}
    for topic, destination in ROUTES:
        routes.setdefault(topic, []).append(destination)
    log = read_log(spark, landed(spark, sf_dir, "all"))
    return routing.fan_out(log, routes).select("topic", "id", _md5())


def demux_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = read_log(spark, landed(spark, sf_dir, "all"))
    decoded = routing.demux(log, {"event": ("events/#", "k INT", "json")})
    is_doc = matches("topic", "docs/#")
    return decoded.select(
        "id",
        "topic",
        F.col("event.k").alias("k"),
        F.when(is_doc, F.size(tokens(as_text("payload")))).cast("bigint").alias("words"),
    )


def demux_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, position = scratch_path(spark, "tagged"), scratch_path(spark, "tagged-position")
    formats = {
        "clicks": ("events/click", "k INT", "json"),
        "events": ("events/#", "k INT", "json"),
        "texts": ("docs/#", "first_field STRING", "csv"),
    }
    stream = subscribe(spark, {"path": landed(spark, sf_dir, "all"), "topic": "#"})
    store_by_tag(stream, out, position, formats).awaitTermination()
    tables = []
    for name, number in (("clicks", "value.k"), ("events", "value.k"), ("texts", "NULL")):
        stored = read_tag(spark, out, name, formats)
        tables.append(stored.selectExpr(f"'{name}' AS tag", "id", "topic", f"CAST({number} AS INT) AS k"))
    return routing.fan_in(*tables)


def store_by_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "by-topic")
    publish(read_log(spark, landed(spark, sf_dir, "all")), out, partition_by=["topic"])
    return read_log(spark, out).groupBy("topic").agg(
        F.count(F.lit(1)).alias("messages"), F.sum(F.length("payload")).alias("bytes")
    )


_QUERIES: list[Query] = [
    log_stream_scan,
    land_log,
    offset_slice,
    slice_mixed_log,
    empty_slice,
    landed_text_import,
    topic_filter,
    topic_wildcards,
    qos_cap,
    assign_offsets,
    offset_slices,
    batch_by_count,
    batch_by_bytes,
    byte_batches,
    both_batches,
    resume_after_restart,
    replay_old_files,
    retention_window,
    retention_consumed,
    backfill_then_tail,
    clean_session,
    clean_session_late,
    multi_subscribe,
    encode_payload,
    encode_single,
    publish_streaming,
    publish_idempotent,
    publish_idempotent_stateful,
    publish_batch,
    publish_complete,
    payload_text,
    decode_json,
    decode_csv,
    decode_custom,
    decode_rows,
    decode_dead_letters,
    tokenize,
    word_count,
    word_count_batch,
    word_count_publish,
    window_counts,
    window_counts_update,
    window_counts_append,
    window_counts_sliding,
    dedupe_redelivery,
    dedupe_out_of_order,
    dedupe_batch,
    dedupe_last_n,
    dedupe_last_n_stream,
    topic_stats,
    gap_check,
    gap_ranges,
    fan_in,
    route_fanout,
    route_fanout_by_topic,
    route_fanout_fixed,
    demux_decode,
    demux_tables,
    store_by_topic,
]


def registered() -> dict[str, Query]:
    named = {query.__name__: query for query in _QUERIES}
    named["publish_stream"] = named.pop("publish_streaming")
    return named
