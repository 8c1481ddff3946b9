"""The log's index: slices, limits, sessions and retention over all batches, and landing with one exchange."""

from __future__ import annotations

import random

import pytest
from conftest import START, payloads
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog import (
    ENVELOPE, LogOptions, batches_in_turn, consumed_files, expire, gap_check, gap_ranges, land, last_offset, publish, publish_stream,
    read_log, read_slice, subscribe,
)
from tidelog.operators import landing
from tidelog.sources.layout import LogFolder, Summary
from tidelog.streaming.results import keep


def numbers(first, count, text="x"):
    return [(n, "a", f"{text}{n}") for n in range(first, first + count)]


def offsets(frame):
    return sorted(row["offset"] for row in frame.collect())


# --- nothing is lost without a word --------------------------------------------------


def test_a_slice_of_a_log_that_is_numbered_in_part_is_refused(spark, path, messages):
    log = path("log")
    publish(messages(numbers(0, 50)), log)
    land(messages(numbers(50, 50)), log)
    with pytest.raises(ValueError, match="no offsets"):
        read_slice(spark, log, end=1000)
    row = gap_check(read_log(spark, log)).first()
    assert (row["messages"], row["missing"], row["repeated"], row["unnumbered"]) == (100, 0, 0, 50)


def test_a_limit_holds_for_every_batch(spark, path, messages):
    log = path("log")
    land(messages(numbers(0, 100)), log, num_partitions=1)
    land(messages(numbers(100, 20)), log, max_batch_messages=10)
    with pytest.raises(ValueError, match="batch_id=0"):
        subscribe(spark, {"path": log, "topic": "#", "maxBatchMessageNum": "10"})


def test_batches_landed_after_a_reader_subscribed_keep_to_its_limit(spark, path, messages):
    log, out = path("log"), path("out")
    stream = subscribe(spark, {"path": log, "topic": "#", "maxBatchMessageNum": "10"})
    land(messages(numbers(0, 25)), log)  # no limit of its own
    land(messages(numbers(25, 25)), log, max_batch_messages=100)  # and a wider one
    publish(messages(numbers(50, 25)), log)
    publish_stream(stream, out, path("position")).awaitTermination()
    sizes = [row["count"] for row in read_log(spark, out).groupBy("batch_id").count().collect()]
    assert sum(sizes) == 75 and max(sizes) <= 10


def test_a_clean_session_gets_what_is_landed_after_it_began(spark, path, messages):
    log, out, position = path("log"), path("out"), path("position")
    options = {"path": log, "topic": "#", "cleanSession": "true", "checkpointLocation": position}
    land(messages(numbers(0, 10)), log)
    subscribe(spark, options)  # the session begins, whether it is run or not
    land(messages(numbers(10, 10)), log)  # of January 2024, long before the session
    keep(subscribe(spark, options), out, position).awaitTermination()
    land(messages(numbers(20, 10)), log)  # while it is stopped
    publish(messages(numbers(30, 10)), log, publisher="another")
    keep(subscribe(spark, options), out, position).awaitTermination()
    assert sorted(row["id"] for row in spark.read.parquet(out).collect()) == list(range(10, 40))
    fresh = {**options, "checkpointLocation": path("fresh")}
    keep(subscribe(spark, fresh), path("none"), fresh["checkpointLocation"]).awaitTermination()
    plan = subscribe(spark, options)._jdf.queryExecution().toString()
    assert "batch_id" in plan


# --- index ---------------------------------------------------------------------------


def test_slices_open_only_the_files_they_need(spark, path, messages):
    log = path("log")
    for part in range(4):
        land(messages(numbers(40 * part, 40)), log, max_batch_messages=10)
    folder = LogFolder(spark, log)
    batch = folder.batch_path("landed", 1)
    inside = folder.files_between(44, 64)
    assert len(inside) == 3 and all(name.startswith(batch) for name in inside)
    assert folder.files_between(39, 79) == [batch]
    assert folder.files_between(159, 500) == []
    assert offsets(read_slice(spark, log, end=64, start=44)) == list(range(45, 65))
    files = read_slice(spark, log, end=64, start=44).inputFiles()
    assert len(files) == 3


def test_the_index_is_made_good_from_the_batches(spark, path, messages):
    log = path("log")
    for part in range(3):
        land(messages(numbers(5 * part, 5)), log)
    folder = LogFolder(spark, log)
    folder.discard(f"{log}/_index")  # as after a crash before it was written, and more
    assert folder.summaries()["landed", 2] == Summary(5, 10, 14, 5)
    assert offsets(read_slice(spark, log, end=11, start=8)) == [9, 10, 11]
    expire(spark, log, 1)
    assert list(folder.summaries()) == [("landed", 2)] and last_offset(spark, log) == 14


def test_two_landings_at_once_do_not_share_a_folder(spark, path, messages):
    log = path("log")
    folder = LogFolder(spark, log)
    assert folder.staging_path("landed", 0) != folder.staging_path("landed", 0)
    land(messages(numbers(0, 5)), log)
    staged = folder.staging_path("landed", 0) + "/rows"
    messages(numbers(9, 1)).write.parquet(staged)
    with pytest.raises(RuntimeError, match="another job"):
        folder.commit(staged, "landed", 0)
    assert read_log(spark, log).count() == 5


# --- landing -------------------------------------------------------------------------


def test_landing_exchanges_payloads_once(spark, path, messages):
    rows = messages(numbers(0, 300)).repartition(3)
    plan = landing.number_once(rows, path("keys"), ["timestamp", "id"], 0, 4).rows._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.split("Initial Plan")[-1].split("\n") if "Exchange" in line]
    assert len([line for line in exchanges if "Broadcast" not in line]) == 2  # the repartition above, and the ranges


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 2)), st.sampled_from(["x", "yy"])), min_size=1, max_size=60),
       st.integers(1, 7))
def test_offsets_are_dense_and_ordered_whatever_ties(spark, path, rows, ranges):
    log = path("log")
    filled = [(id_, "a", bytearray(text.encode()), START.replace(second=second)) for second, id_, text in rows]
    land(spark.createDataFrame(filled, ENVELOPE).repartition(3), log, num_partitions=ranges)
    stored = read_log(spark, log).orderBy("offset").collect()
    assert [row["offset"] for row in stored] == list(range(len(rows)))
    order = [(row["timestamp"], -1 if row["id"] is None else row["id"]) for row in stored]
    assert order == sorted(order)
    assert sorted(bytes(row["payload"]).decode() for row in stored) == sorted(text for _, _, text in rows)


def test_rows_that_change_when_read_again_still_get_dense_offsets(spark, path):
    @F.udf(T.LongType())
    def other_each_time():
        return random.SystemRandom().randrange(10**9)

    rows = spark.range(500, numPartitions=4).select(
        F.col("id").cast("int").alias("id"), F.lit("a").alias("topic"), F.lit("x").cast("binary").alias("payload"),
        F.timestamp_seconds(other_each_time.asNondeterministic()()).alias("timestamp"),
    )
    log = path("log")
    land(rows, log, num_partitions=5)
    stored = read_log(spark, log).orderBy("offset").collect()
    assert [row["offset"] for row in stored] == list(range(500))
    assert [row["timestamp"] for row in stored] == sorted(row["timestamp"] for row in stored)


def test_a_hot_message_is_landed_by_several_tasks(spark, path):
    rows = spark.range(40_000, numPartitions=8).select(
        F.lit(1).alias("id"), F.lit("a").alias("topic"), F.lit("x").cast("binary").alias("payload"),
        F.timestamp_seconds(F.lit(0)).alias("timestamp"),
    )
    log = path("log")
    land(rows, log, num_partitions=8)
    files = read_log(spark, log).groupBy(F.input_file_name()).count().collect()
    assert len(files) == 8 and max(row["count"] for row in files) == 5_000
    land(rows, log, max_batch_messages=1_500)
    held = read_log(spark, log).where("batch_id = 1").groupBy(F.input_file_name()).agg(F.count("*").alias("n"), F.min("offset").alias("low"))
    rows = sorted((row["low"], row["n"]) for row in held.collect())
    assert [n for _, n in rows] == [1_500] * 26 + [1_000] and rows[0][0] == 40_000


# --- batches filled in turn ----------------------------------------------------------


def in_turn(sizes, most_bytes, most_messages):
    batches = []
    for size in sizes:
        full = not batches or sum(batches[-1]) + size > (most_bytes or 1 << 60) or len(batches[-1]) >= (most_messages or 1 << 60)
        if full:
            batches.append([])
        batches[-1].append(size)
    return batches


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 12), min_size=1, max_size=60), st.one_of(st.none(), st.integers(1, 30)),
       st.one_of(st.none(), st.integers(1, 9)), st.sampled_from([2, 8, 64]), st.integers(0, 10**12))
def test_batches_are_filled_in_turn(spark, path, sizes, most_bytes, most_messages, width, start):
    frame = spark.createDataFrame([(start + n, size) for n, size in enumerate(sizes)], "offset BIGINT, size INT").repartition(3)
    found = batches_in_turn(frame, path("batches"), most_bytes, most_messages, rows_per_slice=width).orderBy("number").collect()
    wanted = in_turn(sizes, most_bytes, most_messages)
    assert [row["number"] for row in found] == list(range(len(wanted)))
    assert [row["high"] - row["low"] + 1 for row in found] == [len(batch) for batch in wanted]
    assert [row["bytes"] for row in found] == [sum(batch) for batch in wanted]
    assert found[0]["low"] == start


def test_twenty_messages_of_sixty_bytes_fill_ten_batches(spark, path, messages):
    log = path("log")
    land(messages([(n, "a", "x" * 60) for n in range(20)]), log, max_batch_bytes=130)
    files = read_log(spark, log).groupBy(F.input_file_name()).count().collect()
    assert [row["count"] for row in files] == [2] * 10


# --- retention -----------------------------------------------------------------------


def test_unread_batches_are_never_expired(spark, path, messages):
    log, slow, quick = path("log"), path("slow"), path("quick")

    def read(position):
        publish_stream(subscribe(spark, {"path": log, "topic": "#"}), path("out"), position).awaitTermination()

    def left():
        return sorted(batch for _, batch in LogFolder(spark, log).summaries())

    land(messages(numbers(0, 3)), log)
    read(slow)
    for part in range(1, 14):  # past the source's compaction of its log
        land(messages(numbers(3 * part, 3)), log, partition_by=[])
        read(quick)
    land(messages(numbers(90, 3)), log)
    assert expire(spark, log, 1, readers=[path("never-started")]) == []
    assert consumed_files(spark, slow, log).count() == len(LogFolder(spark, log).data_files("landed", 0))
    expire(spark, log, 1, readers=[slow, quick])
    assert left() == list(range(1, 15))
    read(slow)
    expire(spark, log, 1, readers=[slow, quick])
    assert left() == [14]  # retained; the quick reader has not read it either
    land(messages(numbers(99, 3)), log)
    expire(spark, log, 1, readers=[slow, quick])
    assert left() == [14, 15]


def test_a_reader_stopped_between_planning_and_commit_has_read_nothing(spark, path, messages):
    log, position = path("log"), path("position")
    for part in range(2):
        land(messages(numbers(part, 1)), log)
    publish_stream(subscribe(spark, LogOptions(log, "#", max_files_per_trigger=1)), path("out"), position).awaitTermination()
    land(messages(numbers(5, 1)), log)
    for name in ("1", ".1.crc"):
        LogFolder(spark, position).discard(f"{position}/commits/{name}")
    assert [name.split("/")[1] for name in payload_files(spark, position, log)] == ["batch_id=0"]
    expire(spark, log, 1, readers=[position])
    assert sorted(batch for _, batch in LogFolder(spark, log).summaries()) == [1, 2]


def payload_files(spark, position, log):
    return [row["file"] for row in consumed_files(spark, position, log).collect()]


def test_readers_of_odd_paths_and_other_logs(spark, path, messages):
    log, other, position = path("log") + "/a+b c%20ü", path("other") + "/a+b c%20ü", path("position")
    for target in (log, other):
        land(messages(numbers(0, 2)), target)
    both = subscribe(spark, {"path": log, "topic": "#"}).unionByName(subscribe(spark, {"path": other, "topic": "#"}))
    publish_stream(both, path("out"), position).awaitTermination()
    for target in (log, other):
        assert payload_files(spark, position, target) == LogFolder(spark, target).data_files("landed", 0)
    twice = path("twice")
    union = subscribe(spark, {"path": log, "topic": "a"}).unionByName(subscribe(spark, {"path": log, "topic": "b"}))
    publish_stream(union, path("out"), twice).awaitTermination()
    assert payload_files(spark, twice, log) == LogFolder(spark, log).data_files("landed", 0)


# --- gaps ----------------------------------------------------------------------------


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ab"), st.one_of(st.integers(-200, 200), st.integers(2**19, 2**21), st.integers(2**33, 2**35))), max_size=40))
def test_gap_ranges(spark, pairs):
    frame = spark.createDataFrame([*pairs, ("a", None)], "publisher STRING, offset BIGINT")
    wanted = []
    for publisher in "ab":
        own = sorted({offset for name, offset in pairs if name == publisher})
        wanted += [(publisher, low + 1, high - 1) for low, high in zip(own, own[1:]) if high - low > 1]
    assert sorted(map(tuple, gap_ranges(frame, by=["publisher"]).collect())) == sorted(wanted)
    every = sorted({offset for _, offset in pairs})
    assert sorted(map(tuple, gap_ranges(frame).collect())) == [(a + 1, b - 1) for a, b in zip(every, every[1:]) if b - a > 1]


def test_payloads_survive_landing(spark, path, messages):
    log = path("log")
    land(messages([(1, "a", b"\xff\x00"), (2, "a", None), (3, None, b"")]), log)
    stored = read_log(spark, log).orderBy("id").collect()
    assert [row["payload"] for row in stored] == [bytearray(b"\xff\x00"), None, bytearray(b"")]
    assert payloads(read_log(spark, log).where("id = 3")) == [""]


# --- ranges of a landing -------------------------------------------------------------


@pytest.mark.parametrize("limit", [None, 10])
def test_ranges_hold_even_bytes_where_large_messages_come_at_once(spark, path, messages, limit):
    rows = [(n, "a", "x" * (5_000 if 100 <= n < 200 else 1)) for n in range(2_000)]
    log = path("log")
    land(messages(rows), log, num_partitions=8, max_batch_messages=limit)
    stored = read_log(spark, log).withColumn("file", F.input_file_name())
    assert sorted(row["offset"] for row in stored.collect()) == list(range(2_000))
    if limit is None:
        most = stored.groupBy("file").agg(F.sum(F.length("payload")).alias("bytes")).agg(F.max("bytes")).first()[0]
        assert most <= 2 * 500_000 / 8
    else:
        assert {row["count"] for row in stored.groupBy("file").count().collect()} == {10}


def test_one_heavy_block_is_cut_in_smaller_ones(spark, path):
    sizes = [(n, 1 << 20 if 5_000 <= n < 5_008 else 0) for n in range(100_000)]
    numbered = spark.createDataFrame(sizes, "offset BIGINT, size BIGINT")
    cuts = landing._even_cuts(numbered, 0, 100_000, 8 << 20, 4, 1)
    bounds = [0, *cuts, 100_000]
    weights = [sum(size + 64 for _, size in sizes[low:high]) for low, high in zip(bounds, bounds[1:])]
    assert len(weights) <= 4 and max(weights) <= sum(weights) / 4 + (1 << 20) + (1 << 16)
    assert landing._even_cuts(numbered, 0, 100_000, 8 << 20, 1, 10) == []


def test_a_landing_of_few_bytes_is_one_file_and_one_micro_batch(spark, path):
    rows = spark.range(60_000).selectExpr(
        "int(id) AS id", "'a' AS topic", "binary(string(id)) AS payload", "timestamp_seconds(id) AS timestamp"
    )
    log = path("log")
    land(rows, log)
    files = read_log(spark, log).select(F.input_file_name()).distinct().count()
    assert (files, read_log(spark, log).count()) == (1, 60_000)
    limited = path("limited")
    land(rows, limited, max_batch_messages=25_000)
    assert read_log(spark, limited).select(F.input_file_name()).distinct().count() == 3
