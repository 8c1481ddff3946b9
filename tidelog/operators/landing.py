"""Numbering rows with one exchange of the payloads and none of them written aside.

First the keys alone, with the lengths of the payloads, are sorted and numbered. That tells the batches, and
ranges of rows whose first offsets are known exactly. Then the rows themselves go once to the range of their key; sorted there, a
row's offset is the range's first one plus its rank, and its batch follows from the offset.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators.admission import batches_in_turn
from tidelog.operators.offsets import number_and_sum, with_batches

_TIE, _PLACE, _RANGE = "__row_hash", "__read_by", "__range"  # other names than those of number_rows
_RANK = (1 << 33) - 1  # monotonically_increasing_id keeps the row's rank in its low 33 bits
# Range bounds are part of the plan: one key for each range. Beyond that ranges get larger.
_MOST_RANGES = 1 << 13
_BYTES_IN_RANGE = 64 << 20
# Up to the session's cores there are more ranges, but none has both fewer rows and fewer bytes of payload than these.
# Without a limit each is a file, and often a micro-batch of its own, which costs a reader seconds whatever is in it;
# under a limit files follow from it, and a small range is work for one more core.
_ROWS_IN_RANGE, _PAYLOAD_IN_RANGE = 1_000_000, 8 << 20
_ROWS_IN_LIMITED_RANGE = 20_000
_ROW_BYTES = 64  # of a message besides its payload
_BLOCKS_IN_RANGE = 16


@dataclass
class Landing:
    """Rows with ``offset`` and, under a limit, ``admission``: the first offset of the row's batch."""

    rows: DataFrame
    count: int
    start: int


def number_once(
    rows: DataFrame, staging: str, order_by: Sequence[str], start: int, num_partitions: int | None = None,
    max_messages: int | None = None, max_bytes: int | None = None,
) -> Landing:
    """Plan dense offsets from ``start`` for rows in the order of ``order_by``, and batches within the limits.

    ``rows`` are read twice, the first time without an exchange of payloads, so they must come out
    the same both times, which whoever writes them has to check. Rows that tie on the order are told apart by a hash, and exact copies by the task they come
    from. Ranges begin at a batch, and never between two rows that nothing tells apart.
    """
    keyed = rows.withColumns({_TIE: F.xxhash64(*_hashable(rows)), _PLACE: F.spark_partition_id()})
    keys = {f"__key{n}": _comparable(rows, name) for n, name in enumerate(order_by)}
    keyed = keyed.withColumns(keys)
    names = [*keys, _TIE, _PLACE]
    size = F.coalesce(F.length("payload").cast("long"), F.lit(0))
    numbered, count, bytes_ = number_and_sum(keyed.select(*names, size.alias("size")), f"{staging}/keys", names, "size", start)
    if not count:
        return Landing(rows, 0, start)
    wanted = num_partitions or _ranges(rows, count, bytes_, bool(max_messages or max_bytes))
    batches = None
    if max_bytes:
        batches = batches_in_turn(numbered.select("offset", "size"), f"{staging}/batches", max_bytes, max_messages, span=(start, start + count - 1))
        step = -(-batches.count() // wanted)
        cuts = [row["low"] for row in batches.where((F.col("number") % step == 0) & (F.col("number") > 0)).collect()]
    else:
        cuts = _even_cuts(numbered, start, count, bytes_, wanted, max_messages or 1)
    bounds = _bounds(numbered, names, sorted(cuts), start, movable=not (max_bytes or max_messages))
    firsts = [start, *[offset for offset, _ in bounds]]

    types = [keyed.schema[name].dataType for name in names]
    number = _range_number(names, types, [key for _, key in bounds])
    ranged = keyed.withColumn(_RANGE, number).repartitionById(len(firsts), F.col(_RANGE))
    ranked = ranged.sortWithinPartitions(*names).withColumn("__rank", F.monotonically_increasing_id().bitwiseAND(F.lit(_RANK)))
    first = F.get(F.array(*[F.lit(offset).cast("long") for offset in firsts]), F.col(_RANGE))
    placed = ranked.withColumn("offset", first + F.col("__rank")).drop(*names, _RANGE, "__rank")
    if batches is not None:
        placed = with_batches(placed, batches.select(F.col("low").alias("admission"), "low", "high"))
    elif max_messages:
        turn = F.call_function("div", F.col("offset") - F.lit(start).cast("long"), F.lit(max_messages).cast("long"))
        placed = placed.withColumn("admission", turn * max_messages + start)
    return Landing(placed, count, start)


def _ranges(rows: DataFrame, count: int, bytes_: int, limited: bool) -> int:
    """As many as the messages fill at a range's size, and at least work for all cores if there is enough of it."""
    filled = count // _ROWS_IN_LIMITED_RANGE if limited else max(count // _ROWS_IN_RANGE, bytes_ // _PAYLOAD_IN_RANGE)
    busy = min(rows.sparkSession.sparkContext.defaultParallelism, filled)
    return max(1, busy, min(_MOST_RANGES, -(-(bytes_ + _ROW_BYTES * count) // _BYTES_IN_RANGE)))


def _even_cuts(numbered: DataFrame, start: int, count: int, bytes_: int, wanted: int, unit: int) -> list[int]:
    """First offsets of all ranges but the first: whole batches of ``unit`` messages in each, and about as many bytes in one as in the other.

    Bytes are summed for blocks of offsets, a few for each range; a block that outweighs a range is looked at in smaller blocks.
    The driver sees one sum for each block.
    """
    total = bytes_ + _ROW_BYTES * count
    target = -(-total // wanted)
    bits = max(0, (count // (unit * wanted * _BLOCKS_IN_RANGE)).bit_length() - 1)
    place = F.col("offset") - F.lit(start).cast("long")
    weight = F.sum(F.col("size") + F.lit(_ROW_BYTES)).alias("weight")

    def weights(rows: DataFrame, width: int) -> list[tuple[int, int]]:
        block = F.call_function("div", place, F.lit(width).cast("long"))
        return [(row["block"] * width, row["weight"]) for row in rows.groupBy(block.alias("block")).agg(weight).collect()]

    blocks, done = weights(numbered, unit << bits), []
    while bits:
        heavy = [first for first, bytes_in in blocks if bytes_in > target]
        done += [block for block in blocks if block[1] <= target]
        if not heavy:
            break
        wide = unit << bits
        inside = F.call_function("div", place, F.lit(wide).cast("long")).isin([first // wide for first in heavy])
        bits = max(0, bits - 6)
        blocks = weights(numbered.where(inside), unit << bits)
    else:
        done += blocks
    done.sort()
    before = list(accumulate((bytes_in for _, bytes_in in done), initial=0))
    turns = [at // target for at in before]
    return [start + done[n][0] for n in range(1, len(done)) if turns[n] != turns[n - 1]]


def _hashable(rows: DataFrame) -> list[Column]:
    return [F.col(f"`{field.name}`") for field in rows.schema.fields if not isinstance(field.dataType, T.MapType)]


def _comparable(rows: DataFrame, name: str) -> Column:
    """Times as numbers: as values of a plan they would pass through the driver's time zone."""
    if isinstance(rows.schema[name].dataType, T.TimestampType):
        return F.unix_micros(F.col(f"`{name}`"))
    return F.col(f"`{name}`")


def _bounds(numbered: DataFrame, names: list[str], cuts: list[int], start: int, movable: bool) -> list[tuple[int, tuple]]:
    """Offset and key of the rows at the cuts, without cuts between rows of one key; ``movable`` ones go to the first of these rows."""
    if not cuts:
        return []
    around = pa.table({"offset": pa.array(sorted({*cuts, *[cut - 1 for cut in cuts]}), pa.int64())})
    spark = numbered.sparkSession
    found = numbered.join(F.broadcast(spark.createDataFrame(around)), "offset").select("offset", *names).collect()
    keys = {row["offset"]: tuple(row)[1:] for row in found}
    bounds = {cut: keys[cut] for cut in cuts if keys[cut] != keys[cut - 1]}
    within = [cut for cut in cuts if cut not in bounds]
    if within and movable:
        at = spark.createDataFrame(pa.table({"offset": pa.array(within, pa.int64())}))
        tied = numbered.join(F.broadcast(at), "offset").select(*[F.col(name).alias(f"{name}_") for name in names]).distinct()
        same = [F.col(name).eqNullSafe(F.col(f"{name}_")) for name in names]
        firsts = numbered.join(F.broadcast(tied), same).groupBy(*names).agg(F.min("offset").alias("offset"))
        bounds |= {row["offset"]: tuple(row)[1:] for row in firsts.select("offset", *names).collect() if row["offset"] > start}
    return sorted(bounds.items())


def _range_number(names: list[str], types: list[T.DataType], bounds: list[tuple]) -> Column:
    """How many of the ascending bounds are not above a row's key, by binary search."""
    if not bounds:
        return F.lit(0)
    literals = [F.struct(*[F.lit(v).cast(t).alias(n) for v, t, n in zip(bound, types, names)]) for bound in bounds]
    cuts, key = F.array(*literals), F.struct(*names)
    widths = [1 << bit for bit in reversed(range(len(bounds).bit_length()))]

    def narrowed(found: Column, width: Column) -> Column:
        reached = F.coalesce(F.get(cuts, found + width - 1) <= key, F.lit(False))
        return F.when(reached, found + width).otherwise(found)

    return F.aggregate(F.array(*[F.lit(width) for width in widths]), F.lit(0), narrowed)
