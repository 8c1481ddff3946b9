"""Batches filled in turn under a limit of bytes, of messages, or both, computed in parallel.

Where a batch begins depends on where the one before began, and so on back to the first message. Offsets are
dense, so they are cut into slices of equal width. All that a slice needs to know of what came
before it is how many bytes and messages the batch open at its beginning holds. In a slice, each message at
which a batch might begin points at the first message beyond that batch, found by binary search
in the sums of sizes; doubling these pointers gives, for every message at once, how many batches
begin from there on and what the last of them holds at the slice's end. For entries that come to the same, one row stands.
These few rows are walked once, slice by slice; then every slice, knowing its entry, marks its own batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# No limit: more than all sizes add up to, and still no overflow in a sum.
_ENDLESS = 1 << 61
_BROADCAST_SLICES = 250_000
_STEPS = "slice BIGINT, upto BIGINT, above BIGINT, bytes BIGINT, messages BIGINT, starts BIGINT"
_ENTRIES = "slice BIGINT, open_bytes BIGINT, open_messages BIGINT, before BIGINT"
_PARTS = "number BIGINT, low BIGINT, high BIGINT, bytes BIGINT"


def batches_in_turn(
    sized: DataFrame, staging: str, max_bytes: int | None = None, max_messages: int | None = None,
    rows_per_slice: int = 1 << 20, span: tuple[int, int] | None = None,
) -> DataFrame:
    """One row for each batch, stored: ``number`` from 0, ``low`` and ``high`` (first and last offset), ``bytes``.

    ``sized`` has dense ``offset`` and ``size``. A batch takes message after message until
    the next would break a limit; a message above the limit of bytes is a batch by itself. ``span`` is the first and
    last offset, where they are known. A task gets whole slices and holds one at a time.
    """
    spark = sized.sparkSession
    bits = rows_per_slice.bit_length() - 1
    limits = (max_bytes or _ENDLESS, max_messages or _ENDLESS)
    first, last = span or tuple(sized.agg(F.min("offset"), F.max("offset")).first())
    if first is None:
        spark.createDataFrame([], _PARTS).write.mode("overwrite").parquet(staging)
        return spark.read.schema(_PARTS).parquet(staging)
    slices = (last >> bits) - (first >> bits) + 1
    tasks = min(slices, int(spark.conf.get("spark.sql.shuffle.partitions")))
    sliced = sized.select(F.shiftright("offset", bits).alias("slice"), "offset", F.col("size").cast("long").alias("size"))

    def steps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for slice_, rows in _whole_slices(batches):
            yield _Slice(rows, *limits).steps(slice_)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _walk(batches, *limits)

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, rows in _whole_slices(batches):
            entry = [int(rows[name].iloc[0]) for name in ("open_bytes", "open_messages", "before")]
            yield _Slice(rows, *limits).parts(*entry)

    # a few rows for each slice, in one task that holds one slice's at a time
    ordered = _by_slice(sliced, tasks).mapInPandas(steps, _STEPS).repartition(1).sortWithinPartitions("slice", "upto")
    entries = ordered.mapInPandas(walk, _ENTRIES)
    # one row of four numbers for each slice
    known = sliced.join(F.broadcast(entries) if slices <= _BROADCAST_SLICES else entries, "slice")
    found = _by_slice(known, tasks).mapInPandas(parts, _PARTS)
    whole = found.groupBy("number").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("bytes").alias("bytes")
    )
    whole.coalesce(tasks).write.mode("overwrite").parquet(staging)
    return spark.read.schema(_PARTS).parquet(staging)


def _by_slice(rows: DataFrame, tasks: int) -> DataFrame:
    placed = rows.repartitionById(tasks, F.pmod("slice", F.lit(tasks)).cast("int"))
    return placed.sortWithinPartitions("slice", "offset")


def _whole_slices(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, pd.DataFrame]]:
    """Rows that come in the order of their slices, one slice after the other."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        for slice_, rows in batch.groupby("slice", sort=False):
            if held and held[0]["slice"].iloc[0] != slice_:
                yield int(held[0]["slice"].iloc[0]), pd.concat(held)
                held = []
            held.append(rows)
    if held:
        yield int(held[0]["slice"].iloc[0]), pd.concat(held)


class _Slice:
    """One slice's messages, which come in order: sums of sizes and pointers beyond each message's batch."""

    def __init__(self, rows: pd.DataFrame, max_bytes: int, max_messages: int):
        self.offsets = rows["offset"].to_numpy()
        self.sizes = rows["size"].to_numpy()
        self.max_bytes, self.max_messages = max_bytes, max_messages
        self.count = len(rows)
        self.before = np.concatenate([[0], np.cumsum(self.sizes)])
        places = np.arange(self.count)
        beyond = np.searchsorted(self.before, self.before[:-1] + max_bytes, "right") - 1
        self.beyond = np.minimum(np.maximum(beyond, places + 1), places + min(max_messages, self.count))
        self.beyond = np.minimum(self.beyond, self.count)

    def steps(self, slice_: int) -> pd.DataFrame:
        """What becomes of the slice, by the message at which the open batch is closed.

        Rows are ordered by that message: ``upto`` is the last message that a row stands for, and ``above`` the open
        bytes beyond which the open batch is closed there or before. The last row is for a batch that stays open.
        """
        count = self.count
        starts = np.ones(count + 1, np.int64)
        starts[count] = 0
        last = np.arange(count)
        jump = np.append(self.beyond, count)
        while (jump[:-1] < count).any():
            ahead = jump[:-1]
            last = np.where(ahead < count, last[np.minimum(ahead, count - 1)], last)
            starts = starts + np.where(jump < count, starts[jump], 0)
            jump = jump[jump]
        change = np.flatnonzero((last[1:] != last[:-1]) | (starts[1:-1] != starts[:-2]))
        upto = np.append(change, count - 1)
        return pd.DataFrame(
            {
                "slice": slice_,
                "upto": np.append(upto, count),
                "above": np.append(self.max_bytes - self.before[upto + 1], 0),
                "bytes": np.append(self.before[count] - self.before[last[upto]], self.before[count]),
                "messages": np.append(count - last[upto], count),
                "starts": np.append(starts[upto], 0),
            }
        )

    def parts(self, open_bytes: int, open_messages: int, before: int) -> pd.DataFrame:
        """The pieces of batches in this slice; the first may go on with the open batch."""
        closed = int(np.searchsorted(self.before[1:], self.max_bytes - open_bytes, "right"))
        place = min(closed, max(0, self.max_messages - open_messages), self.count)
        lows, numbers = ([0], [before - 1]) if place else ([], [])
        while place < self.count:
            lows.append(place)
            numbers.append(before)
            before += 1
            place = int(self.beyond[place])
        edges = np.append(lows, self.count)
        return pd.DataFrame(
            {
                "number": numbers,
                "low": self.offsets[edges[:-1]],
                "high": self.offsets[edges[1:] - 1],
                "bytes": self.before[edges[1:]] - self.before[edges[:-1]],
            }
        )


def _walk(batches: Iterator[pd.DataFrame], max_bytes: int, max_messages: int) -> Iterator[pd.DataFrame]:
    """From slice to slice what the open batch holds, and how many batches have begun."""
    # before the first message no batch is open: as if one were full
    open_bytes, open_messages, before = max_bytes + 1, max_messages, 0
    current, chosen, entries = None, None, []
    for batch in batches:
        for slice_, upto, above, bytes_, messages, starts in batch.itertuples(index=False, name=None):
            if slice_ != current:
                if current is not None:
                    open_bytes, open_messages, before = chosen
                current, chosen = slice_, None
                entries.append((slice_, open_bytes, open_messages, before))
            if chosen is not None:
                continue
            if starts and (open_bytes > above or max_messages - open_messages <= upto):
                chosen = (bytes_, messages, before + starts)
            elif not starts:
                chosen = (open_bytes + bytes_, open_messages + messages, before)
        if entries:
            yield pd.DataFrame(entries, columns=["slice", "open_bytes", "open_messages", "before"])
            entries = []
