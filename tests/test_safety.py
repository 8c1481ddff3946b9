"""Nothing is lost or changed without a word: old files, replays, layouts, encoding, copies, retention."""

from __future__ import annotations

from datetime import datetime

import pytest
from conftest import payloads
from pyspark.sql import functions as F

from tidelog import (
    LogOptions, dedupe, dedupe_stream, encode, expire, gap_check, land, publish, publish_stream, read_log, read_slice,
    subscribe, word_count,
)
from tidelog.sources.layout import LogFolder
from tidelog.streaming.results import keep


def date_back(spark, log, days):
    """Give all files of the log's newest batches an older date."""
    folder = LogFolder(spark, log)
    for batch in folder.newest_batches():
        for status in folder._fs.listStatus(folder._path(batch)):
            if status.getPath().getName().startswith("part-"):
                folder._fs.setTimes(status.getPath(), status.getModificationTime() - days * 86_400_000, -1)


@pytest.mark.parametrize("days", [8, 365])
def test_files_with_old_dates_are_read(spark, path, messages, days):
    log, out, position = path("log"), path("out"), path("position")
    stream = lambda: subscribe(spark, {"path": log, "topic": "#"})
    land(messages([(n, "a", f"new {n}") for n in range(5)]), log)
    keep(stream(), out, position).awaitTermination()
    land(messages([(n, "a", f"old {n}") for n in range(7)]), log)
    date_back(spark, log, days)
    keep(stream(), out, position).awaitTermination()
    assert payloads(spark.read.parquet(out)) == sorted([f"new {n}" for n in range(5)] + [f"old {n}" for n in range(7)])


def stateful(spark, log, kind):
    stream = subscribe(spark, {"path": log, "topic": "#"})
    if kind == "count":
        return word_count(stream), {"topic": "counts", "output_mode": "complete"}
    return dedupe_stream(stream, "1 hour"), {}


@pytest.mark.parametrize("kind", ["count", "dedupe"])
def test_a_stateful_batch_that_runs_again_is_skipped_and_its_state_kept(spark, path, messages, kind):
    log, out, position = path("log"), path("out"), path("position")
    land(messages([(1, "a", "x y x"), (2, "a", "y")]), log)

    def run():
        frame, options = stateful(spark, log, kind)
        publish_stream(frame, out, position, **options).awaitTermination()

    run()
    first = payloads(read_log(spark, out))
    last = read_log(spark, out).agg(F.max("batch_id")).first()[0] if kind == "count" else 1  # dedupe ends without data
    for name in (f"{last}", f".{last}.crc"):  # as after a crash before the commit
        LogFolder(spark, position).discard(f"{position}/commits/{name}")
    run()
    assert payloads(read_log(spark, out)) == first
    land(messages([(3, "a", "z x")]), log)
    run()
    published = payloads(read_log(spark, out).where(F.col("batch_id") > last))
    wanted = ['{"value":"x","count":3}', '{"value":"y","count":2}', '{"value":"z","count":1}'] if kind == "count" else ["z x"]
    assert published == wanted


def test_completeness_does_not_hang_on_hadoops_marker(spark, path, messages):
    log = path("log")
    spark.sparkContext._jsc.hadoopConfiguration().set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        frame = messages([(1, "a", "x")])
        assert publish(frame, log, batch_id=0) and not publish(frame, log, batch_id=0)
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert read_log(spark, log).count() == 1


def test_a_log_keeps_its_layout(spark, path, messages):
    log = path("log")
    publish(messages([(1, "a", "x"), (2, "b", "y")]), log, partition_by=["topic"])
    with pytest.raises(ValueError, match="partitioned by topic"):
        publish(messages([(3, "a", "z")]), log)
    assert read_log(spark, log).count() == 2
    with pytest.raises(Exception, match="is empty"):
        publish(messages([(4, "", "z")]), log, partition_by=["topic"])


def test_offsets_are_asked_of_numbered_logs_only(spark, path, messages):
    log = path("log")
    publish(messages([(1, "a", "x")]), log)
    with pytest.raises(ValueError, match="no offsets"):
        read_slice(spark, log, 5)
    numbered = path("numbered")
    land(messages([(1, "a", "x")]), numbered)
    assert gap_check(read_slice(spark, numbered, 5)).first()["messages"] == 1


def test_limits_hold_or_are_refused(spark, path, messages):
    log = path("log")
    land(messages([(n, "a", "x") for n in range(20)]), log)
    with pytest.raises(ValueError, match="max_batch_messages"):
        subscribe(spark, LogOptions(log, "#", max_batch_messages=5))
    limited = path("limited")
    land(messages([(n, "a", "x") for n in range(20)]), limited, max_batch_messages=5)
    subscribe(spark, LogOptions(limited, "#", max_batch_messages=5))
    with pytest.raises(ValueError):
        subscribe(spark, LogOptions(limited, "#", max_batch_messages=5, max_files_per_trigger=3))
    with pytest.raises(ValueError, match="maxbatchmesagenum"):
        subscribe(spark, {"path": log, "topic": "#", "maxBatchMesageNum": 5})


def test_encoding_loses_nothing(spark):
    at = datetime(2024, 1, 2, 3, 4, 5, 123456)
    rows = encode(spark.createDataFrame([(1, at)], "n INT, at TIMESTAMP_NTZ"), "t").first()
    assert bytes(rows["payload"]).decode() == '{"n":1,"at":"2024-01-02T03:04:05.123456"}'
    assert (rows["qos"], rows["retained"], rows["duplicate"]) == (1, False, False)
    with pytest.raises(ValueError, match="user"):
        encode(spark.createDataFrame([("t", "p", 7)], "topic STRING, payload STRING, user INT"))


def test_dedupe_keeps_the_columns_of_the_first_copy(spark):
    rows = [(1, "t", b"x", datetime(2024, 1, n), n, n == 1) for n in (3, 1, 2)]
    frame = spark.createDataFrame(rows, "id INT, topic STRING, payload BINARY, timestamp TIMESTAMP, qos INT, retained BOOLEAN")
    kept = dedupe(frame)
    assert kept.columns == frame.columns and [(r["qos"], r["retained"]) for r in kept.collect()] == [(1, True)]


def test_what_a_slow_reader_has_not_read_stays(spark, path, messages):
    log = path("log")
    for batch in range(3):
        land(messages([(n, "a", f"{batch}-{n}") for n in range(10)]), log)
    assert expire(spark, log, 1, consumed=9) == [LogFolder(spark, log).batch_path("landed", 0)]
    assert read_log(spark, log).count() == 20
