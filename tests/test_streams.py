"""Landing, subscribing, publishing, restarting: the scenarios a broker would give."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import payloads
from tidelog import (
    ENVELOPE,
    LogOptions,
    append_batch,
    dedupe,
    dedupe_stream,
    expire,
    gap_check,
    land,
    parse_landed_lines,
    publish,
    publish_stream,
    read_log,
    read_messages,
    read_newest,
    scratch_path,
    subscribe,
    window_counts,
    word_count,
)
from tidelog.sources.layout import LogFolder
from tidelog.streaming.results import keep, newest_result

# Fixed value: the text that the known scenarios send.
TEXT = "Pressure is stable at the north gate."


def received(spark, path, log, topic="test", **options):
    out = path("received")
    keep(subscribe(spark, LogOptions(log, topic, **options)), out, path("position")).awaitTermination()
    return spark.read.schema(ENVELOPE).parquet(out)


@pytest.mark.parametrize("count", [1, 50])
def test_messages_arrive(spark, path, messages, count):
    log = path("log")
    land(messages([(i, "test", TEXT) for i in range(count)]), log)
    got = received(spark, path, log)
    assert got.schema == ENVELOPE
    assert payloads(got) == [TEXT] * count


@pytest.mark.parametrize("sent", [["first reading", TEXT], [f"reading {n}" for n in range(100)]])
def test_messages_are_published(spark, path, messages, sent):
    log, out = path("log"), path("published")
    land(messages([(i, "in", text) for i, text in enumerate(sent)]), log)
    lines = subscribe(spark, {"path": log, "topic": "in"}).selectExpr("CAST(payload AS STRING) AS value")
    publish_stream(lines, out, path("position"), "test", qos=2).awaitTermination()
    assert payloads(read_messages(spark, {"path": out, "topic": "test"})) == sorted(sent)
    rows = read_log(spark, out).select("topic", "qos", "retained").distinct().collect()
    assert [tuple(r) for r in rows] == [("test", 2, False)]


def big_messages(spark, count):
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    whole, rest = divmod(500 * 1024, 26)
    payload = F.concat(F.repeat(F.lit(letters), whole), F.lit(letters[:rest])).cast("binary")
    return spark.range(count).select(
        F.col("id").cast("int").alias("id"),
        F.lit("test").alias("topic"),
        payload.alias("payload"),
        F.timestamp_seconds("id").alias("timestamp"),
    )


def test_large_messages_arrive(spark, path):
    log = path("log")
    land(big_messages(spark, 204), log)
    got = received(spark, path, log).agg(
        F.count(F.lit(1)), F.min(F.length("payload")), F.max(F.length("payload"))
    )
    assert tuple(got.first()) == (204, 512_000, 512_000)


def test_large_messages_from_five_publishers_at_once(spark, path):
    source, out = path("source"), path("published")
    land(big_messages(spark, 40), source)

    def run(number):
        stream = subscribe(spark, {"path": source, "topic": "test"}).select("payload")
        publish_stream(stream, out, path(f"position{number}"), "test").awaitTermination()

    with ThreadPoolExecutor(5) as pool:
        list(pool.map(run, range(5)))
    assert read_log(spark, out).where(F.length("payload") == 512_000).count() == 200


def test_payloads_that_text_would_break(spark, path, messages):
    log = path("log")
    sent = [b"a\nb", b"a##b", b"\xff\x00", b"", b"##"]
    land(messages([(i, "test", raw) for i, raw in enumerate(sent)]), log)
    got = received(spark, path, log)
    assert sorted(bytes(r["payload"]) for r in got.collect()) == sorted(sent)


def test_nothing_to_read_is_no_batch(spark, path):
    log = path("log")
    query = keep(subscribe(spark, LogOptions(log, "test")), path("out"), path("position"))
    query.awaitTermination()
    assert [p for p in query.recentProgress if p.numInputRows] == []


def test_metadata_and_qos_cap(spark, path, messages):
    log = path("log")
    land(messages([(i, "test", "x") for i in range(3)]).withColumn("qos", F.col("id")), log)
    stream = subscribe(spark, {"path": log, "topic": "test", "metadata": "true"})
    assert stream.columns == ["id", "topic", "payload", "timestamp", "qos", "retained", "duplicate", "offset"]
    rows = read_messages(spark, LogOptions(log, "test", metadata=True)).orderBy("offset").collect()
    assert [r["qos"] for r in rows] == [0, 1, 1]


@pytest.mark.parametrize("files", [1, 2, 8])
def test_stream_equals_batch_for_any_batch_size(spark, path, messages, files):
    log, out = path("log"), path("counts")
    texts = ["a b", "b  c ", "   ", "", "c c"] * 8
    land(messages([(i, "test", t) for i, t in enumerate(texts)]), log, max_batch_messages=10)
    counted = word_count(subscribe(spark, LogOptions(log, "test", max_files_per_trigger=files)))
    query = keep(counted, out, path("position"), "complete")
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p.numInputRows]) == -(-4 // files)
    assert sorted(newest_result(spark, out).collect()) == sorted(word_count(read_log(spark, log)).collect())


def test_micro_batches_follow_arrival_order(spark, path, messages):
    log, out = path("log"), path("out")
    rows = messages([(i, "test", str(i)) for i in range(95)])
    land(rows, log, max_batch_messages=10)
    publish_stream(
        subscribe(spark, {"path": log, "topic": "test", "maxBatchMessageNum": "10"}), out, path("position")
    ).awaitTermination()
    batches = read_log(spark, out).groupBy("batch_id").agg(F.min("id"), F.max("id")).orderBy("batch_id").collect()
    assert [tuple(b) for b in batches] == [(k, 10 * k, min(10 * k + 9, 94)) for k in range(10)]


def test_file_dates_rise_over_batches(spark, path, messages):
    log = path("log")
    for _ in range(2):
        land(messages([(i, "test", str(i)) for i in range(30)]), log, max_batch_messages=10)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "*.parquet"
    ).load(log).select("path", "modificationTime").collect()
    by_date = [f["path"].split("batch_id=")[1] for f in sorted(files, key=lambda f: f["modificationTime"])]
    assert by_date == sorted(by_date) and len(by_date) == 6
    assert len({f["modificationTime"] for f in files}) == 6


def test_byte_limit_of_the_reader_takes_at_least_one_file(spark, path, messages):
    log = path("log")
    for part in range(3):
        publish(messages([(part, "test", "x" * 100)]), log)
    assert received(spark, path, log, max_batch_bytes=1).count() == 3


def test_restart_goes_on_where_it_stopped(spark, path, messages):
    log, out, position = path("log"), path("out"), path("position")
    for start in (0, 10):
        publish(messages([(i, "test", str(i)) for i in range(start, start + 10)]), log)
        query = keep(subscribe(spark, LogOptions(log, "test")), out, position)
        query.awaitTermination()
        assert sum(p.numInputRows for p in query.recentProgress) == 10
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == list(range(20))


def test_replayed_batch_is_skipped(spark, path, messages):
    log, out, position = path("log"), path("out"), path("position")
    publish(messages([(i, "test", str(i)) for i in range(10)]), log)

    def run():
        publish_stream(subscribe(spark, LogOptions(log, "test")), out, position).awaitTermination()

    run()
    files = sorted(read_log(spark, out).inputFiles())
    for name in ("0", ".0.crc"):
        LogFolder(spark, position).discard(f"{position}/commits/{name}")
    run()
    assert sorted(read_log(spark, out).inputFiles()) == files
    # A reader that came by between the two runs sees each message once.
    assert received(spark, path, out).count() == 10


@settings(max_examples=3, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=6))
def test_any_order_of_replays_adds_each_batch_once(spark, batch_ids):
    log = scratch_path(spark, "replays")
    first_time = set()
    for batch_id in batch_ids:
        rows = spark.range(batch_id + 1).selectExpr("'t' AS topic", "CAST(id AS STRING) AS payload")
        assert append_batch(rows, log, "p", batch_id) == (batch_id not in first_time)
        first_time.add(batch_id)
    held = read_log(spark, log).groupBy("batch_id").count().collect()
    assert {r["batch_id"]: r["count"] for r in held} == {b: b + 1 for b in first_time}


def test_half_written_batch_is_not_seen_and_written_anew(spark, path, messages):
    log = path("log")
    folder = LogFolder(spark, log)
    messages([(9, "test", "torn")]).write.parquet(folder.staging_path("published", 0) + "/rows")
    assert publish(messages([(1, "test", "whole")]), log)
    assert payloads(read_log(spark, log)) == ["whole"]


def test_batch_number_makes_batch_publish_idempotent(spark, path, messages):
    log = path("log")
    rows = messages([(1, "test", "x")])
    assert publish(rows, log, batch_id=4) and not publish(rows, log, batch_id=4)
    assert publish(rows, log)
    assert sorted(r["batch_id"] for r in read_log(spark, log).collect()) == [4, 5]


def test_wrong_schema_fails_before_the_stream_starts(spark, path, messages):
    log = path("log")
    publish(messages([(1, "test", "x")]), log)
    stream = subscribe(spark, LogOptions(log, "test")).select("payload")
    with pytest.raises(ValueError):
        publish_stream(stream, path("out"), path("position"))


def test_complete_mode_newest_batch_holds_all(spark, path, messages):
    log, out = path("log"), path("out")
    for part in range(2):
        publish(messages([(part, "test", "a b")]), log)
    counted = word_count(subscribe(spark, LogOptions(log, "test", max_files_per_trigger=1)))
    publish_stream(counted, out, path("position"), "counts", output_mode="complete").awaitTermination()
    assert payloads(read_newest(spark, out)) == ['{"value":"a","count":2}', '{"value":"b","count":2}']
    assert read_log(spark, out).count() == 4


def test_old_results_are_dropped(spark, path, messages):
    log, out, kept, position = path("log"), path("out"), path("kept"), path("position")
    for part in range(4):
        publish(messages([(part, "test", "a")]), log)
    counted = word_count(subscribe(spark, LogOptions(log, "test", max_files_per_trigger=1)))
    publish_stream(
        counted, out, position, "counts", output_mode="complete", retain_batches=1
    ).awaitTermination()
    assert payloads(read_log(spark, out)) == ['{"value":"a","count":4}']
    keep(counted, kept, path("position"), "complete").awaitTermination()
    assert LogFolder(spark, kept).batches("results") == [2, 3]
    assert [tuple(r) for r in newest_result(spark, kept).collect()] == [("a", 4)]


def test_landing_by_topic(spark, path, messages):
    log = path("log")
    for _ in range(2):
        land(messages([(1, "a/b", "x"), (2, "c", "y")]), log, partition_by=["topic"])
    rows = read_log(spark, log).orderBy("offset").select("offset", "topic").collect()
    assert [tuple(r) for r in rows] == [(0, "a/b"), (1, "c"), (2, "a/b"), (3, "c")]
    assert received(spark, path, log, topic="c").count() == 2


def test_update_mode_publishes_what_changed(spark, path, messages):
    log, out = path("log"), path("out")
    for text in ("a b", "b c"):
        publish(messages([(0, "test", text)]), log)
    counted = word_count(subscribe(spark, LogOptions(log, "test", max_files_per_trigger=1)))
    publish_stream(counted, out, path("position"), "counts", output_mode="update", files=1).awaitTermination()
    assert len(read_log(spark, out).inputFiles()) == 2
    assert payloads(read_newest(spark, out)) == ['{"value":"b","count":2}', '{"value":"c","count":1}']


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_hot_topic_is_written_by_several_tasks(spark, path, adaptive):
    rows = spark.range(0, 40_000, 1, 8).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("t"), F.col("id") % 7)).alias("topic"),
        F.sha2(F.col("id").cast("string"), 512).alias("payload"),
    )
    log = path("log")
    changed = {"spark.sql.adaptive.enabled": adaptive, "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k"}
    before = {key: spark.conf.get(key) for key in changed}
    try:
        for key, value in changed.items():
            spark.conf.set(key, value)
        publish(rows, log, partition_by=["topic"])
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    stored = read_log(spark, log)
    assert stored.count() == 40_000
    hot = stored.where("topic = 'hot'").groupBy(F.input_file_name()).count().collect()
    assert len(hot) > 1


def test_numbered_stream_landing(spark, path, messages):
    source, log = path("source"), path("log")
    for part in range(2):
        publish(messages([(i, "test", str(i)) for i in range(5)]), source)
    stream = subscribe(spark, LogOptions(source, "test", max_files_per_trigger=1))
    publish_stream(stream, log, path("position"), number=True).awaitTermination()
    row = gap_check(read_log(spark, log)).first()
    assert (row["first_offset"], row["last_offset"], row["missing"], row["repeated"]) == (0, 9, 0, 0)


def test_landing_stamps_the_time_of_arrival(spark, path):
    log = path("log")
    before = spark.sql("SELECT current_timestamp()").first()[0]
    land(spark.createDataFrame([(1, "test", bytearray(b"x"))], "id INT, topic STRING, payload BINARY"), log)
    assert read_log(spark, log).first()["timestamp"] >= before


def test_limited_stream_landing(spark, path, messages):
    source, log = path("source"), path("log")
    for part in range(2):
        publish(messages([(i, "test", "xx") for i in range(5)]), source)
    stream = subscribe(spark, LogOptions(source, "test", max_files_per_trigger=1))
    publish_stream(
        stream, log, path("position"), max_batch_messages=3, max_batch_bytes=4
    ).awaitTermination()
    held = read_log(spark, log).groupBy(F.input_file_name()).agg(F.min("offset"), F.max("offset"))
    # Five messages of two bytes: each batch is filled until the next message would break a limit.
    first = [(0, 1), (2, 3), (4, 4)]
    second = [(low + 5, high + 5) for low, high in first]
    assert sorted(tuple(r)[1:] for r in held.collect()) == first + second


def test_expired_batches_are_gone(spark, path, messages):
    log = path("log")
    for part in range(4):
        publish(messages([(part, "test", "x")]), log)
    assert len(expire(spark, log, 2)) == 2
    assert sorted(r["id"] for r in read_log(spark, log).collect()) == [2, 3]
    assert sorted(r["id"] for r in read_newest(spark, log).collect()) == [3]
    with pytest.raises(ValueError):
        expire(spark, log, 0)


def test_offsets_go_on_after_expiry(spark, path, messages):
    log = path("log")
    for part in range(2):
        land(messages([(part, "test", "x")]), log)
    expire(spark, log, 1)
    land(messages([(9, "test", "x")]), log)
    assert sorted(r["offset"] for r in read_log(spark, log).collect()) == [1, 2]


def test_reader_archives_what_it_has_read(spark, path, messages):
    log, archive = path("log"), path("archive")
    for part in range(3):
        publish(messages([(part, "test", "x")]), log)
    got = received(
        spark, path, log, max_files_per_trigger=1, clean_source="archive", archive_dir=archive
    )
    assert got.count() == 3
    assert read_log(spark, log).count() < 3


def test_clean_session_skips_what_came_before(spark, path, messages):
    log = path("log")
    publish(messages([(i, "test", "x") for i in range(4)]), log)
    assert received(spark, path, log, clean_session=True).count() == 0
    since = "2024-01-01 00:00:01"
    assert received(spark, path, log, clean_session=True, start_timestamp=since).count() == 2


@pytest.mark.parametrize("salts", [1, 16])
def test_watermarked_dedupe_over_batches(spark, path, messages, salts):
    log, out = path("log"), path("out")
    rows = [(i % 40, "test", f"p{i % 40}") for i in range(120)]
    land(messages(rows), log, max_batch_messages=30)
    stream = subscribe(spark, LogOptions(log, "test", max_files_per_trigger=1, metadata=True))
    keep(dedupe_stream(stream, "1 hour", salts), out, path("position")).awaitTermination()
    got = spark.read.parquet(out)
    assert sorted(r["id"] for r in got.collect()) == list(range(40))
    # A copy from the first micro-batch that held one is kept.
    assert got.agg(F.max("offset")).first()[0] < 60


def test_dedupe_keeps_unique_messages_whatever_their_time(spark, path, messages):
    log, out = path("log"), path("out")
    older = messages([(i, "test", f"p{i}") for i in range(20, 60)]).withColumn("timestamp", F.col("timestamp") - F.expr("INTERVAL 1 DAY"))
    for rows in (messages([(i, "test", f"p{i}") for i in range(40)]), older):
        land(rows, log)
    stream = subscribe(spark, LogOptions(log, "test", max_files_per_trigger=1))
    keep(dedupe_stream(stream, "1 hour"), out, path("position")).awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == list(range(60))


def test_same_id_is_not_a_copy(messages):
    rows = messages([(1, "a", "x"), (1, "a", "y"), (1, "b", "x"), (1, "a", "x")])
    kept = dedupe(rows)
    assert kept.count() == 3
    assert kept.where("topic = 'a' AND payload = X'78'").first()["timestamp"].second == 0


def test_append_windows_wait_for_the_watermark(spark, path, messages):
    log, out = path("log"), path("out")
    rows = messages([(i, "test", "x") for i in range(180)])
    publish(rows, log)
    stream = window_counts(subscribe(spark, LogOptions(log, "test")), "1 minute", delay="30 seconds")
    keep(stream, out, path("position")).awaitTermination()
    assert [(r["n"]) for r in spark.read.parquet(out).collect()] == [60, 60]


def test_landed_lines_as_a_stream(spark, path):
    lines, out = path("lines"), path("out")
    spark.createDataFrame([("7##a/b##1700000000123##x##y",)], "value STRING").write.text(lines)
    keep(parse_landed_lines(spark.readStream.text(lines)), out, path("position")).awaitTermination()
    row = spark.read.parquet(out).first()
    assert (row["id"], row["topic"], bytes(row["payload"])) == (7, "a/b", b"x##y")
    assert row["timestamp"].isoformat().endswith("13:20.123000")


@pytest.mark.parametrize("line", ["no separators", "x##a##1##p", "1##a##late##p"])
def test_torn_lines_fail(spark, path, line):
    frame = spark.createDataFrame([(line,)], "value STRING")
    with pytest.raises(Exception):
        parse_landed_lines(frame).collect()
