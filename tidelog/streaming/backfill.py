"""All of a log, the old part in bounded slices and what comes later as a stream."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidelog.envelope import LogOptions
from tidelog.operators.offsets import slice_bounds
from tidelog.sources.layout import LogFolder
from tidelog.sources.log import delivered, read_slice, subscribe
from tidelog.streaming.publish import publish, publish_stream

_HAND_OVER = "_hand_over."  # its offset follows
_BACKFILL = "backfill"


def hand_over_offset(spark: SparkSession, log: str, checkpoint: str) -> int:
    """The last offset that is read by slices: the log's end when this was first asked for, kept with the checkpoint."""
    folder = LogFolder(spark, checkpoint)
    kept = [name for name in folder.names(folder.path) if name.startswith(_HAND_OVER)]
    if kept:
        return int(kept[0][len(_HAND_OVER):])
    source = LogFolder(spark, log)
    last = source.last_offset()
    source.files_between(-1, last)  # refuses a log with messages that no slice would find
    folder.mark(f"{_HAND_OVER}{last}")
    return last


def backfill(
    spark: SparkSession, options: LogOptions | Mapping[str, Any], out: str, checkpoint: str, slices: int,
    transform: Callable[[DataFrame], DataFrame] | None = None, at_most: int | None = None, **publishing: Any,
) -> int:
    """Publish what the log held at the hand-over, slice by slice; gives the offset of the hand-over.

    A slice is a batch of its own in ``out``, so slices that are there already are skipped: a backfill that was broken off goes on where it stopped.
    All messages up to the hand-over must be numbered. ``slices`` must not change in between. ``at_most`` ends this run after so many slices, the skipped ones included.
    """
    chosen = LogOptions.of(options)
    last = hand_over_offset(spark, chosen.path, checkpoint)
    for number, (after, upto) in list(enumerate(slice_bounds(-1, last, slices)))[:at_most]:
        # all was numbered at the hand-over: what is not came later, and is the tail's
        rows = delivered(read_slice(spark, chosen.path, upto, after, numbered_later=False), chosen)
        publish(transform(rows) if transform else rows, out, publisher=_BACKFILL, batch_id=number, **publishing)
    return last


def backfill_then_tail(
    spark: SparkSession, options: LogOptions | Mapping[str, Any], out: str, checkpoint: str, slices: int = 8,
    transform: Callable[[DataFrame], DataFrame] | None = None, trigger: dict | None = None, **publishing: Any,
) -> StreamingQuery:
    """Publish each message of the log once: first :func:`backfill`, then a stream of the messages beyond the hand-over.

    Both parts are told apart by the offset alone, so nothing is missed or read twice at the seam, whenever the
    work is broken off and started again with the same checkpoint. ``transform`` must work row by row.
    """
    chosen = LogOptions.of(options)
    last = backfill(spark, chosen, out, checkpoint, slices, transform, **publishing)
    tail = subscribe(spark, chosen, after=last)
    return publish_stream(transform(tail) if transform else tail, out, checkpoint, trigger=trigger, **publishing)
