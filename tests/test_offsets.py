from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
import pytest

from tidelog import (
    admission_by_bytes,
    append_batch,
    assign_offsets,
    gap_check,
    land,
    last_offset,
    read_log,
    read_slice,
    running_bytes,
    slice_bounds,
    slice_number,
)


def test_offsets_are_dense_and_in_order(spark, path):
    rows = spark.range(5000).select(
        F.pmod(F.xxhash64("id"), F.lit(1000)).cast("int").alias("id"),
        F.timestamp_seconds(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(300))).alias("timestamp"),
    )
    numbered = assign_offsets(rows, path("dense"), start=10, num_partitions=7).collect()
    ordered = sorted(numbered, key=lambda r: r["offset"])
    assert [r["offset"] for r in ordered] == list(range(10, 5010))
    keys = [(r["timestamp"], r["id"]) for r in ordered]
    assert keys == sorted(keys)


def test_copies_at_one_instant_are_spread_and_kept(spark, path):
    """Two thirds of the rows are exact copies of one message."""
    rows = spark.range(0, 6000, 1, 6).select(
        F.when(F.col("id") % 3 > 0, F.lit(1)).otherwise(F.col("id")).cast("int").alias("id"),
        F.timestamp_seconds(F.when(F.col("id") % 3 > 0, F.lit(500)).otherwise(F.col("id"))).alias("timestamp"),
    )
    staging = path("copies")
    numbered = assign_offsets(rows, staging, num_partitions=6)
    assert sorted(r["offset"] for r in numbered.select("offset").collect()) == list(range(6000))
    hottest = (
        spark.read.parquet(staging).groupBy(F.shiftright("__rank", 33)).count().agg(F.max("count")).first()[0]
    )
    assert hottest < 3000


def test_empty_input_lands_nothing(spark, path, messages):
    log = path("empty")
    assert land(messages([(1, "a", "x")]).limit(0), log) is None
    assert last_offset(spark, log) == -1
    assert land(messages([(1, "a", "x")]), log) == 0
    assert last_offset(spark, log) == 0


def test_landing_goes_on_from_the_last_offset(spark, path, messages):
    log = path("goes-on")
    for _ in range(3):
        land(messages([(1, "a", "x"), (2, "a", "y")]), log)
    rows = read_log(spark, log).orderBy("offset").select("offset", "batch_id").collect()
    assert [tuple(r) for r in rows] == [(0, 0), (1, 0), (2, 1), (3, 1), (4, 2), (5, 2)]


def test_slices_of_a_log(spark, path, messages):
    log = path("slices")
    land(messages([(i, "a", str(i)) for i in range(8)]), log)

    def offsets(**bounds):
        return sorted(r["offset"] for r in read_slice(spark, log, **bounds).collect())

    assert offsets(end=7) == list(range(8))
    assert offsets(end=4, start=1) == [2, 3, 4]
    assert offsets(end=4, start=4) == []
    assert read_slice(spark, log, end=4, start=4).columns[:4] == ["id", "topic", "payload", "timestamp"]
    with pytest.raises(ValueError):
        read_slice(spark, log, end=1, start=2)


@given(st.integers(-1, 10**12), st.integers(0, 10**6), st.integers(1, 64))
def test_slice_bounds_cover_and_are_disjoint(start, size, n):
    bounds = slice_bounds(start, start + size, n)
    assert len(bounds) == n and bounds[0][0] == start and bounds[-1][1] == start + size
    assert all(left[1] == right[0] for left, right in zip(bounds, bounds[1:]))
    sizes = [high - low for low, high in bounds]
    assert max(sizes) - min(sizes) <= 1


@settings(max_examples=6, deadline=None)
@given(st.integers(-1, 10**15), st.integers(0, 300), st.integers(1, 20))
def test_slice_numbers_agree_with_bounds(spark, start, size, n):
    frame = spark.range(start - 2, start + size + 3).select(
        F.col("id").alias("offset"), slice_number("id", start, start + size, n).alias("slice")
    )
    bounds = slice_bounds(start, start + size, n)
    for row in frame.collect():
        holders = [i for i, (low, high) in enumerate(bounds) if low < row["offset"] <= high]
        assert holders == ([] if row["slice"] is None else [row["slice"]])


def test_slices_by_example(spark):
    assert slice_bounds(-1, 7, 4) == [(-1, 1), (1, 3), (3, 5), (5, 7)]
    assert [high - low for low, high in slice_bounds(-1, 1036, 4)] == [260, 259, 259, 259]
    assert slice_bounds(4, 5, 4)[-1] == (4, 5) or sum(h - l for l, h in slice_bounds(4, 5, 4)) == 1


sizes = st.lists(st.integers(0, 12), min_size=1, max_size=60)


@settings(max_examples=6, deadline=None)
@given(sizes, st.integers(1, 20))
def test_byte_batches_keep_to_the_limit(spark, sizes, limit):
    frame = spark.createDataFrame(list(enumerate(sizes)), "offset BIGINT, size INT")
    placed = running_bytes(frame, rows_per_slice=4).select(
        "offset", "size", "bytes_before", admission_by_bytes("bytes_before", F.col("size"), limit).alias("batch")
    )
    rows = sorted(placed.collect())
    assert [r["bytes_before"] for r in rows] == [sum(sizes[:i]) for i in range(len(sizes))]
    batches: dict[int, list[int]] = {}
    for row in rows:
        batches.setdefault(row["batch"], []).append(row["size"])
    assert [r["batch"] for r in rows] == sorted(r["batch"] for r in rows)
    for held in batches.values():
        assert sum(held) <= limit or len([s for s in held if s]) == 1


def test_stored_batches_keep_to_both_limits(spark, path):
    rows = spark.range(3000).select(
        F.col("id").cast("int").alias("id"),
        F.lit("a").alias("topic"),
        F.expr("repeat('x', int(pmod(xxhash64(id), 90)))").cast("binary").alias("payload"),
        F.timestamp_seconds("id").alias("timestamp"),
    )
    log = path("both-limits")
    land(rows, log, max_batch_messages=100, max_batch_bytes=2000)
    files = (
        read_log(spark, log)
        .groupBy(F.input_file_name().alias("file"))
        .agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.length("payload")).alias("bytes"),
            F.min("offset").alias("low"), F.max("offset").alias("high"),
        )
        .orderBy("file")
        .collect()
    )
    assert all(f["n"] <= 100 and f["bytes"] <= 2000 for f in files)
    assert sum(f["n"] for f in files) == 3000
    assert all(f["high"] - f["low"] + 1 == f["n"] for f in files)
    assert [f["low"] for f in files] == sorted(f["low"] for f in files)


def test_message_above_the_limit_is_its_own_batch(spark, path, messages):
    log = path("oversized")
    land(messages([(0, "a", "x" * 50), (1, "a", "y"), (2, "a", "z")]), log, max_batch_bytes=10)
    files = read_log(spark, log).groupBy(F.input_file_name()).agg(F.collect_list("id").alias("ids")).collect()
    assert sorted(sorted(f["ids"]) for f in files) == [[0], [1, 2]]


def test_limits_and_partition_columns_do_not_mix(path, messages):
    with pytest.raises(ValueError):
        append_batch(messages([(1, "a", "x")]), path("mix"), "p", 0, partition_by=["topic"], max_batch_bytes=1)


def test_gaps_and_repeats_are_counted(spark):
    given_offsets = [0, 1, 2, 2, 5, 40_000, 40_000, 70_001]
    frame = spark.createDataFrame([(o,) for o in given_offsets], "offset BIGINT")
    row = gap_check(frame).first()
    assert tuple(row) == (0, 70_001, 8, 70_002 - 6, 2, 0)
    none = gap_check(frame.limit(0)).first()
    assert (none["messages"], none["missing"], none["repeated"]) == (0, 0, 0)
