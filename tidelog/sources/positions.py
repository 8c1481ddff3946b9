"""How far the streams that read a log have come, from their checkpoints, and what may go from the log."""

from __future__ import annotations

import json
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.sources.layout import LogFolder

_ENTRY = "path STRING, timestamp BIGINT, batchId BIGINT"
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def committed_positions(spark: SparkSession, checkpoint: str) -> dict[int, int | None]:
    """For each file source of a query the last entry of its own log that a committed micro-batch has read.

    None stands for a source of which no committed micro-batch has read anything, whatever its kind.
    """
    folder = LogFolder(spark, checkpoint)
    commits = [int(name) for name in folder.names(f"{folder.path}/commits") if name.isdigit()]
    if not commits:
        return {}
    text = folder.read_text(f"{folder.path}/offsets/{max(commits)}")
    positions: dict[int, int | None] = {}
    for source, line in enumerate(text.strip().split("\n")[2:]):  # after a version and the settings
        position = json.loads(line) if line.startswith("{") else None
        if line == "-":
            positions[source] = None
        elif isinstance(position, dict) and "logOffset" in position:
            positions[source] = int(position["logOffset"])
    return positions


def consumed_files(spark: SparkSession, checkpoint: str, log: str) -> DataFrame:
    """Column ``file``: those files of a log, from its folder down, that the committed micro-batches of a query have read.

    A file source keeps what it has taken in a log of its own, which it compacts from time to
    time. Entries of a micro-batch that is planned but not committed do not count. Where a query
    reads the log by several sources, a file counts once all of them have read it.
    """
    positions = committed_positions(spark, checkpoint)
    none = spark.createDataFrame([], "file STRING")
    if None in positions.values():
        return none
    folder = LogFolder(spark, checkpoint)
    top = LogFolder(spark, log).absolute() + "/"
    # paths are stored as URIs, in which a plus stands for itself
    stored = F.url_decode(F.replace("entry.path", F.lit("+"), F.lit("%2B")))
    path = F.regexp_replace(stored, _SCHEME, "")
    found = []
    for source, position in positions.items():
        own = f"{folder.path}/sources/{source}"
        lines = spark.read.text([f"{own}/{name}" for name in _entries_upto(folder.names(own), position)])
        entries = lines.where(F.col("value").startswith("{")).select(F.from_json("value", _ENTRY).alias("entry"))
        paths = entries.where(F.col("entry.batchId") <= position).select(path.alias("path"))
        below = F.substring("path", F.lit(len(top) + 1), F.length("path"))
        found.append(paths.where(F.col("path").startswith(top)).select(below.alias("file"), F.lit(source).alias("source")).distinct())
    if not found:
        return none
    every = reduce(DataFrame.unionByName, found)
    readers = every.select("source").distinct().count() if len(found) > 1 else 1  # others read other logs
    return every.groupBy("file").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == readers).select("file")


def _entries_upto(names: Iterable[str], position: int) -> list[str]:
    """The files of a source's log that hold all entries up to a position: the last compacted one and what came after.

    Where a compacted file goes beyond the position, it may have taken the place of older ones.
    """
    plain = [int(name) for name in names if name.isdigit()]
    compacted = sorted(int(name.split(".")[0]) for name in names if name.endswith(".compact"))
    whole = max((number for number in compacted if number <= position), default=-1)
    beyond = [number for number in compacted if number > position][:1]
    wanted = [f"{number}.compact" for number in [whole, *beyond] if number >= 0]
    return wanted + [str(number) for number in plain if whole < number <= position]


def expire(
    spark: SparkSession, log: str, retain_batches: int, publisher: str | None = None, consumed: int | None = None,
    readers: Iterable[str] | None = None,
) -> list[str]:
    """Delete whole batches, all but the last ``retain_batches`` of each publisher, or of one.

    ``readers`` are the checkpoints of the streams that read the log: a batch stays while one of them has a file of it
    that no committed micro-batch has read. ``consumed`` is an offset that all other readers have reached;
    a batch with a message beyond it, or without offsets, then stays. With neither, unread messages may go.
    """
    if retain_batches < 1:
        raise ValueError("at least one batch must be retained")
    folder = LogFolder(spark, log)
    summaries = folder.summaries() if consumed is not None else {}
    old = []
    for name in [publisher] if publisher else folder.publishers():
        for batch_id in folder.batches(name)[:-retain_batches]:
            last = summaries[name, batch_id].last if consumed is not None else None
            if consumed is None or (last is not None and last <= consumed):
                old.append((name, batch_id))
    if readers is not None and old:
        unread = _unread(spark, folder, old, readers)
        old = [batch for batch in old if batch not in unread]
    return [folder.drop_batch(name, batch_id) for name, batch_id in old]


def _unread(
    spark: SparkSession, folder: LogFolder, batches: list[tuple[str, int]], readers: Iterable[str]
) -> set[tuple[str, int]]:
    """Batches with a file that one of the readers has not consumed. The driver sees the names of files only."""
    rows = [(name, batch_id, path) for name, batch_id in batches for path in folder.data_files(name, batch_id)]
    files = spark.createDataFrame(rows, "publisher STRING, batch_id BIGINT, file STRING")
    unread: set[tuple[str, int]] = set()
    for reader in readers:
        left = files.join(consumed_files(spark, reader, folder.path), "file", "left_anti")
        unread |= {tuple(row) for row in left.select("publisher", "batch_id").distinct().collect()}
    return unread
