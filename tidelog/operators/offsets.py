"""Dense offsets, even slices of an offset interval, batch limits, gaps."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators.admission import batches_in_turn

_RANK_BITS = 33  # monotonically_increasing_id keeps the row's rank in its low 33 bits
_FIRST_OFFSETS = pa.schema([("__range", pa.int64()), ("before", pa.int64())])
_BROADCAST_ROWS = 250_000  # of four numbers each, at most three times over: under 100 MB


def assign_offsets(
    df: DataFrame,
    staging: str,
    order_by: Sequence[str] = ("timestamp", "id"),
    start: int = 0,
    num_partitions: int | None = None,
) -> DataFrame:
    """Number the rows ``start, start+1, …`` in arrival order, without a gap.

    One range shuffle sorts the rows; each keeps its rank within its partition,
    and the ranges are written to ``staging`` because their bounds come from a
    sample and would differ if they were computed again. One count for each
    range, all that the driver sees, then gives every range its first offset.
    Rows that tie on the order are told apart by a hash, and exact copies by
    the task they come from, which is the same when a task runs again. So an
    instant or a message with a third of all rows is spread over ranges too.
    """
    return number_rows(df, staging, order_by, start, num_partitions)[0]


def number_rows(
    df: DataFrame,
    staging: str,
    order_by: Sequence[str] = ("timestamp", "id"),
    start: int = 0,
    num_partitions: int | None = None,
) -> tuple[DataFrame, int]:
    """:func:`assign_offsets` together with how many rows were numbered."""
    return number_and_sum(df, staging, order_by, None, start, num_partitions)[:2]


def number_and_sum(
    df: DataFrame,
    staging: str,
    order_by: Sequence[str],
    summed: str | None,
    start: int = 0,
    num_partitions: int | None = None,
) -> tuple[DataFrame, int, int]:
    """:func:`number_rows` with the sum of one column as well."""
    spark = df.sparkSession
    tie, place = "__tie", "__place"
    keys = [*order_by, tie, place]
    hashed = [df[f"`{f.name}`"] for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    tied = df.withColumn(tie, F.xxhash64(*hashed)).withColumn(place, F.spark_partition_id())
    ranged = (
        tied.repartitionByRange(num_partitions, *keys) if num_partitions else tied.repartitionByRange(*keys)
    )
    ranked = ranged.sortWithinPartitions(*keys).drop(tie, place).withColumn(
        "__rank", F.monotonically_increasing_id()
    )
    ranked.write.mode("overwrite").parquet(staging)

    schema = T.StructType([*df.schema.fields, T.StructField("__rank", T.LongType())])
    staged = spark.read.schema(schema).parquet(staging).withColumn(
        "__range", F.shiftright("__rank", _RANK_BITS)
    )
    total = F.coalesce(F.sum(summed), F.lit(0)) if summed else F.lit(0)
    sizes = sorted(staged.groupBy("__range").agg(F.count(F.lit(1)).alias("n"), total.alias("total")).collect())
    before = list(accumulate((row["n"] for row in sizes), initial=start))
    columns = {"__range": [row["__range"] for row in sizes], "before": before[:-1]}
    first = spark.createDataFrame(pa.table(columns, schema=_FIRST_OFFSETS))
    rank = F.col("__rank").bitwiseAND(F.lit((1 << _RANK_BITS) - 1))
    numbered = (
        staged.join(F.broadcast(first), "__range")
        .withColumn("offset", F.col("before") + rank)
        .drop("__range", "__rank", "before")
    )
    return numbered, before[-1] - start, sum(row["total"] for row in sizes)


def _running_before(totals: DataFrame, key: str, value: str) -> DataFrame:
    """For each key, the sum over all smaller keys.

    ``totals`` has one row for each slice of a million messages, so this
    single-task window and the broadcast of its result stay small.
    """
    before = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(key, F.coalesce(F.sum(value).over(before), F.lit(0)).alias("before"))


def slice_number(offset: Column | str, start: int, end: int, slices: int) -> Column:
    """Which of ``slices`` near-equal parts of ``start < offset <= end`` a row is in."""
    if slices < 1:
        raise ValueError("there must be at least one slice")
    if end < start:
        raise ValueError(f"the interval ends at {end}, before its start {start}")
    column = F.col(offset) if isinstance(offset, str) else offset
    if end == start:
        return F.lit(None).cast("long")
    size = F.lit(end - start).cast("long")
    position = column - F.lit(start + 1).cast("long")
    inside = (column > start) & (column <= end)
    scaled = position * F.lit(slices).cast("long")
    return F.when(inside, _div(scaled, size))


def slice_bounds(start: int, end: int, slices: int) -> list[tuple[int, int]]:
    """The same parts as half-open intervals ``(after, upto]`` for ``read_slice``."""
    if slices < 1:
        raise ValueError("there must be at least one slice")
    if end < start:
        raise ValueError(f"the interval ends at {end}, before its start {start}")
    cuts = [start - (-(end - start) * i // slices) for i in range(slices + 1)]
    return list(zip(cuts[:-1], cuts[1:]))


def running_bytes(
    numbered: DataFrame, offset: str = "offset", size: str = "size", rows_per_slice: int = 1 << 20
) -> DataFrame:
    """Add ``bytes_before``: the sum of ``size`` over all messages with a smaller offset.

    Offsets are dense, so slices of equal width hold equal numbers of rows and
    no slice is hot. Sums run inside the slices in parallel; the slice totals,
    one row for each slice, are then summed and added.
    """
    bytes_ = F.col(size).cast("long")
    sliced = numbered.withColumn("__slice", F.shiftright(offset, _log2(rows_per_slice)))
    totals = sliced.groupBy("__slice").agg(F.sum(bytes_).alias("bytes"))
    inside = Window.partitionBy("__slice").orderBy(offset).rowsBetween(Window.unboundedPreceding, -1)
    return (
        sliced.withColumn("__inside", F.coalesce(F.sum(bytes_).over(inside), F.lit(0)))
        .join(F.broadcast(_running_before(totals, "__slice", "bytes")), "__slice")
        .withColumn("bytes_before", F.col("before") + F.col("__inside"))
        .drop("__slice", "__inside", "before")
    )


def admission_by_count(offset: Column | str, limit: int, start: int = 0) -> Column:
    """Batch number where each batch takes the next ``limit`` offsets."""
    column = F.col(offset) if isinstance(offset, str) else offset
    return _div(column - F.lit(start).cast("long"), F.lit(limit).cast("long"))


def admission_by_bytes(bytes_before: Column | str, size: Column, limit: int) -> Column:
    """Batch number where no batch holds more than ``limit`` payload bytes.

    The byte stream is cut at every multiple of the limit. Messages that lie
    between two cuts make one batch; a message that lies across a cut is a batch
    of its own, and so is a message above the limit. Unlike filling one batch
    after the other this needs no knowledge of the batch before, so it runs in
    parallel; batches stay in arrival order and their numbers may have gaps.
    """
    before = F.col(bytes_before) if isinstance(bytes_before, str) else bytes_before
    width = F.lit(limit).cast("long")
    last = before + F.greatest(size.cast("long") - 1, F.lit(0).cast("long"))
    cell = _div(before, width)
    return cell * 2 + (_div(last, width) > cell).cast("long")


def with_byte_admission(
    numbered: DataFrame, staging: str, limit: int, max_messages: int | None = None
) -> DataFrame:
    """Add ``admission``, the first offset of a message's batch, where each batch is filled up to the limits in turn.

    ``numbered`` must be stored, with dense offsets. Only offsets and lengths are looked at to find the batches.
    """
    sized = numbered.select("offset", F.coalesce(F.length("payload"), F.lit(0)).alias("size"))
    batches = batches_in_turn(sized, staging, limit, max_messages)
    return with_batches(numbered, batches.select(F.col("low").alias("admission"), "low", "high"))


def with_batches(numbered: DataFrame, bounds: DataFrame) -> DataFrame:
    """Add ``admission`` to the messages from bounds ``admission, low, high``, one row for each batch.

    They meet over blocks of about one batch's length, where a message has two candidates
    on average whatever the sizes. Payloads are not shuffled for it unless the batches are too many to send around.
    """
    shape = bounds.agg(F.count(F.lit(1)).alias("batches"), F.sum(F.expr("high - low + 1")).alias("rows")).first()
    if not shape["batches"]:
        return numbered.withColumn("admission", F.lit(None).cast("long"))
    bits = max(1, shape["rows"] // shape["batches"]).bit_length() - 1
    blocks = bounds.withColumn(
        "__block", F.explode(F.sequence(F.shiftright("low", bits), F.shiftright("high", bits)))
    )
    few = shape["batches"] <= _BROADCAST_ROWS
    inside = (F.col("offset") >= F.col("low")) & (F.col("offset") <= F.col("high"))
    keyed = numbered.withColumn("__block", F.shiftright("offset", bits))
    placed = keyed.join(F.broadcast(blocks) if few else blocks, "__block").where(inside).drop("__block", "low", "high")
    # a batch is bounded by its limit, so no group of this shuffle is hot
    return placed if few else placed.repartition("admission")


def gap_check(df: DataFrame, offset: str = "offset") -> DataFrame:
    """One row: how many messages there are, and how many are missing, repeated, or without an offset.

    Distinct offsets are counted exactly, 64 to a bit mask. Masks are merged on
    the map side, and as a log's files hold runs of offsets, about one row is
    shuffled for 64 messages.
    """
    number = F.col(offset)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), number.bitwiseAND(F.lit(63)).cast("int"))
    masks = (
        df.groupBy(F.shiftright(number, 6).alias("__block"))
        .agg(
            F.bit_or(bit).alias("mask"),
            F.count(F.lit(1)).alias("n"),
            F.min(number).alias("low"),
            F.max(number).alias("high"),
        )
    )
    numbered = F.col("__block").isNotNull()
    summed = masks.agg(
        F.min("low").alias("first_offset"),
        F.max("high").alias("last_offset"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("messages"),
        F.coalesce(F.sum(F.when(~numbered, F.col("n"))), F.lit(0)).cast("long").alias("unnumbered"),
        F.coalesce(F.sum(F.bit_count("mask")), F.lit(0)).cast("long").alias("present"),
    )
    span = F.coalesce(F.col("last_offset") - F.col("first_offset") + 1, F.lit(0))
    return summed.select(
        "first_offset",
        "last_offset",
        "messages",
        (span - F.col("present")).cast("long").alias("missing"),
        (F.col("messages") - F.col("unnumbered") - F.col("present")).cast("long").alias("repeated"),
        "unnumbered",
    )


def gap_ranges(df: DataFrame, offset: str = "offset", by: Sequence[str] = ()) -> DataFrame:
    """Runs of missing offsets, one row each: the columns of ``by``, ``from`` and ``to``, both missing.

    Looked for between the first and the last offset there is, for each value of ``by``. Offsets are gathered into
    bit masks of 64, on the map side first, and gaps within a mask are read off its bits. For gaps between masks only the offset
    before a mask's first is wanted. A mask sees the one before it within a group of 2^14 neighbours; groups, with their
    first and last offset, see each other in groups of 2^14 in the same way, and the last level has one row
    for 2^34 offsets. Rows without an offset are left out; a repeated offset is no gap.
    """
    number = F.col(offset)
    keys = [F.col(name) for name in by]
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), number.bitwiseAND(F.lit(63)).cast("int"))
    masks = (
        df.where(number.isNotNull())
        .groupBy(*keys, F.shiftright(number, 6).alias("__block"))
        .agg(F.bit_or(bit).alias("__mask"), F.min(number).alias("__low"), F.max(number).alias("__high"))
    )
    holed = masks.where(F.col("__high") - F.col("__low") + 1 > F.bit_count("__mask"))
    bits = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda place: F.getbit("__mask", place) == 1)
    present = holed.select(*by, F.transform(bits, lambda place: F.col("__block") * 64 + place).alias("__present"))
    steps = F.zip_with(
        F.slice("__present", 1, F.size("__present") - 1),
        F.slice("__present", 2, F.size("__present") - 1),
        lambda before, after: F.struct(before.alias("before"), after.alias("after")),
    )
    between = [present.select(*by, F.inline(steps).alias("before", "after"))]
    level = masks.select(*by, "__block", "__low", "__high")
    for last in (False, False, True):
        grouped = level if last else level.withColumn("__group", F.shiftright("__block", 14))
        group = [] if last else ["__group"]
        before = F.lag("__high").over(Window.partitionBy(*by, *group).orderBy("__block"))
        between.append(grouped.select(*by, before.alias("before"), F.col("__low").alias("after")))
        if not last:
            level = grouped.groupBy(*by, F.col("__group").alias("__block")).agg(
                F.min("__low").alias("__low"), F.max("__high").alias("__high")
            )
    pairs = reduce(DataFrame.unionByName, between).where(F.col("after") - F.col("before") > 1)
    return pairs.select(*by, (F.col("before") + 1).alias("from"), (F.col("after") - 1).alias("to"))


def _div(number: Column, by: Column) -> Column:
    """Whole-number division; `/` would go through a double and round."""
    return F.call_function("div", number, by)


def _log2(number: int) -> int:
    if number < 1 or number & (number - 1):
        raise ValueError("rows_per_slice must be a power of two")
    return number.bit_length() - 1
