"""Document fingerprints by context-triggered piecewise hashing.

A hash over the last seven bytes marks the end of a chunk wherever it is one of the values for the block
size; each chunk gives one character of a signature. The block size follows the length of the text, and
a fingerprint holds the signatures for it and for twice of it, so that texts up to
about twice as long can be compared: by edit distance of the signatures for the same block size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import partitions

WINDOW = 7
LONGEST_SIGNATURE = 64
# A chunk ends after this many block sizes at the latest, so that texts which repeat
# themselves and never trigger are told apart too.
_LONGEST_CHUNK = 8
_EXPECTED_CHUNKS = 48
# Of equal characters in a row so many are kept; more say no more.
_MOST_REPEATS = 3
_ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
_BYTES_AT_ONCE = 1 << 20
_ROWS_AT_ONCE = 512
_KEYS_FOR_RANGE = 32


def _triggers(data: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the hash of the last WINDOW bytes triggers at this block size, and the hash there.

    Bytes before the first are zeros. A long text is gone through a part at a time.
    """
    places, hashes = [], []
    for first in range(0, len(data), _BYTES_AT_ONCE):
        part = data[first : first + _BYTES_AT_ONCE]
        before = data[max(0, first - WINDOW + 1) : first]
        padded = np.concatenate([np.zeros(WINDOW - 1 - len(before), np.uint8), before, part]).astype(np.uint32)
        mixed = np.zeros(len(part), np.uint32)
        for back in range(WINDOW):
            mixed = (mixed + padded[back : back + len(part)] + np.uint32(1)) * np.uint32(2654435761)
            mixed ^= mixed >> np.uint32(15)
        there = np.flatnonzero((mixed & np.uint32(block - 1)) == block - 1)
        places.append(there + first)
        hashes.append(mixed[there])
    return np.concatenate(places), np.concatenate(hashes)


_powers = np.multiply.accumulate(np.concatenate([[1], np.full((1 << 16) - 1, 6364136223846793005)]).astype(np.uint64))


def _signature(data: np.ndarray, ends: np.ndarray, block: int) -> str:
    """One character for each chunk; the last chunk may have no trigger at its end."""
    starts = np.unique(np.concatenate([[0], ends + 1]))
    starts = starts[starts < len(data)]
    # cut what is too long at equal distances
    lengths = np.diff(np.append(starts, len(data)))
    longest = _LONGEST_CHUNK * block
    cuts = (lengths - 1) // longest
    within = np.arange(len(starts) + cuts.sum()) - np.repeat(np.cumsum(cuts + 1) - cuts - 1, cuts + 1)
    starts = np.repeat(starts, cuts + 1) + within * longest
    sums = np.zeros(len(starts), np.uint64)
    for first in range(0, len(data), _BYTES_AT_ONCE):
        part = data[first : first + _BYTES_AT_ONCE]
        a, b = np.searchsorted(starts, first, "right") - 1, np.searchsorted(starts, first + len(part), "left")
        inside = np.maximum(starts[a:b], first) - first
        place = np.arange(first, first + len(part)) - np.repeat(starts[a:b], np.diff(np.append(inside, len(part))))
        sums[a:b] += np.add.reduceat((part.astype(np.uint64) + np.uint64(1)) * _powers[place & 0xFFFF], inside)
    sums = (sums ^ (sums >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    marks = _ALPHABET[(sums >> np.uint64(58)).astype(np.int64)]
    repeats = np.zeros(len(marks), bool)
    if len(marks) > _MOST_REPEATS:
        windows = np.lib.stride_tricks.sliding_window_view(marks, _MOST_REPEATS + 1)
        repeats[_MOST_REPEATS:] = (windows == windows[:, :1]).all(axis=1)
    return marks[~repeats].tobytes().decode()


def fingerprint(text: str) -> str:
    """``block size:signature:signature for twice the size`` of the text in UTF-8.

    The block size is a power of two that gives about _EXPECTED_CHUNKS chunks or half as
    many, or the next one whose signature has at most LONGEST_SIGNATURE characters. An empty text has
    empty signatures.
    """
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    block = 1
    if not len(data):
        return f"{block}::"
    while block * _EXPECTED_CHUNKS < len(data):
        block *= 2
    ends, marks = _triggers(data, block)  # a trigger for a size is one for each smaller size too
    own = _signature(data, ends, block)
    while True:
        inside = (marks & np.uint32(2 * block - 1)) == 2 * block - 1
        ends, marks = ends[inside], marks[inside]
        wider = _signature(data, ends, 2 * block)
        if len(own) <= LONGEST_SIGNATURE:
            return f"{block}:{own}:{wider}"
        own, block = wider, 2 * block


def _parse(mark: str) -> tuple[int, str, str]:
    block, own, wider = mark.split(":")
    return int(block), own, wider


def likeness(left: list[str], right: list[str]) -> np.ndarray:
    """For each pair of fingerprints 0 to 1: one less the edit distance by the longer signature.

    Equal fingerprints are alike by 1. Of the block sizes both have, the best counts; without
    one, or where one text is empty, it is 0.
    """
    best = np.array([float(a == b) for a, b in zip(left, right)])
    firsts: list[str] = []
    seconds: list[str] = []
    owners: list[int] = []
    for owner, (a, b) in enumerate(zip(left, right)):
        if a == b:
            continue
        (size_a, own_a, wide_a), (size_b, own_b, wide_b) = _parse(a), _parse(b)
        if size_a == size_b:
            both = [(own_a, own_b), (wide_a, wide_b)]
        elif size_a == 2 * size_b:
            both = [(own_a, wide_b)]
        elif size_b == 2 * size_a:
            both = [(wide_a, own_b)]
        else:
            continue
        for x, y in both:
            if x and y:
                firsts.append(x)
                seconds.append(y)
                owners.append(owner)
    if owners:
        longest = np.maximum([len(x) for x in firsts], [len(y) for y in seconds])
        np.maximum.at(best, owners, 1 - edit_distances(firsts, seconds) / longest)
    return best


def edit_distances(left: list[str], right: list[str]) -> np.ndarray:
    """Levenshtein distances of pairs of words of 1 to 64 characters, all pairs at once.

    Bit-parallel: a column of the table of distances is two bit vectors of
    differences (Myers 1999), here one 64-bit number for each pair.
    """
    rows = len(left)
    one = np.uint64(1)
    a, b = _as_matrix(left), _as_matrix(right)
    lengths_a, lengths_b = np.array([len(x) for x in left]), np.array([len(x) for x in right])
    last = one << (lengths_a - 1).astype(np.uint64)
    bits = one << np.arange(a.shape[1], dtype=np.uint64)
    plus, minus = np.full(rows, ~np.uint64(0)), np.zeros(rows, np.uint64)
    distance = lengths_a.copy()
    for column in range(b.shape[1]):
        equal = np.where(a == b[:, column, None], bits, np.uint64(0)).sum(axis=1, dtype=np.uint64)
        across = (((equal & plus) + plus) ^ plus) | equal
        down = equal | minus
        up_plus = minus | ~(across | plus)
        up_minus = plus & across
        running = column < lengths_b
        distance += np.where(running & ((up_plus & last) != 0), 1, 0) - np.where(running & ((up_minus & last) != 0), 1, 0)
        up_plus = (up_plus << one) | one
        up_minus = up_minus << one
        plus, minus = up_minus | ~(down | up_plus), up_plus & down
    return distance


def _as_matrix(words: list[str]) -> np.ndarray:
    width = max(map(len, words))
    return np.frombuffer("".join(word.ljust(width, "\0") for word in words).encode(), np.uint8).reshape(len(words), width)


def compare_with_next(docs: DataFrame, edit, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document against an edited text and against the document that follows it.

    ``edit(text, next text)`` makes the edited text. Documents follow each other by id,
    nulls first, rows that repeat an id by their text, and the last is followed by the first. Gives
    id, text, edited_text, fingerprint, edited_fingerprint, near_edited, near_next.
    Null texts are empty. An empty table gives no rows; a single document follows itself.

    Documents are dealt to ranges of ids at sampled splitters and run through in
    order; of each range only the first document is also sent to the range before it.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ranges = partitions(docs.sparkSession)
    ids = docs.select(F.col(id_col).cast("long").alias("id")).where("id IS NOT NULL")
    # the least hashes of all are a fair sample, and the same one in each run
    drawn = ids.orderBy(F.xxhash64("id"), "id").limit(_KEYS_FOR_RANGE * ranges).collect()
    held = sorted({row["id"] for row in drawn})
    splitters = sorted({held[i * len(held) // ranges] for i in range(1, ranges)}) if held else []
    at = range_of(F.col("id"), splitters)
    # the first of each range: an id and a text by their digest, one row for each range
    start = F.min(F.struct(F.col("id"), F.sha2("text", 256).alias("digest")))
    least = rows.groupBy(at.alias("range")).agg(F.min("id").alias("id")).collect()
    by_range = sorted(((row["range"], row["id"]) for row in least))
    if not by_range:
        return rows.select(
            F.col("id").alias(id_col), "text", F.col("text").alias("edited_text"), F.lit("").alias("fingerprint"),
            F.lit("").alias("edited_fingerprint"), F.lit(0.0).alias("near_edited"), F.lit(0.0).alias("near_next"),
        )
    first_ids = [first for _, first in by_range]
    begins = rows.where(F.col("id").isin([i for i in first_ids if i is not None]) | (F.col("id").isNull() if None in first_ids else F.lit(False)))
    heads = begins.groupBy(at.alias("range")).agg(start.alias("head"), F.min_by("text", F.struct("id", F.sha2("text", 256))).alias("text"))
    before = {own: by_range[place - 1][0] for place, (own, _) in enumerate(by_range)}
    to = F.element_at(F.create_map(*[F.lit(x) for pair in before.items() for x in pair]), F.col("range"))
    heads = heads.select(to.alias("range"), F.lit(1).alias("ahead"), F.col("head.id").alias("id"), "text")
    dealt = rows.select(at.alias("range"), F.lit(0).alias("ahead"), "id", "text").unionByName(heads)
    placed = dealt.repartitionById(len(splitters) + 1, F.col("range"))
    ordered = placed.withColumn("digest", F.sha2("text", 256)).sortWithinPartitions("range", "ahead", "id", "digest")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: tuple | None = None  # the document before, still without the one that follows
        done: list[tuple] = []
        for batch in batches:
            for first in range(0, batch.num_rows, _ROWS_AT_ONCE):
                some = batch.slice(first, _ROWS_AT_ONCE)
                for owner, text in zip(some.column("id").to_pylist(), some.column("text").to_pylist()):
                    own = fingerprint(text) if waiting is None or waiting[1] != text else waiting[2]
                    if waiting is not None:
                        edited = edit(waiting[1], text)
                        done.append((*waiting[:2], edited, waiting[2], fingerprint(edited), own))
                    waiting = (owner, text, own)
                if done:
                    yield _compared(done)
                    done = []

    names = "id long, text string, edited_text string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return ordered.select("id", "text").mapInArrow(compare, names).withColumnRenamed("id", id_col)


def _compared(rows: list[tuple]) -> pa.RecordBatch:
    ids, texts, edited, own, changed, following = (list(column) for column in zip(*rows))
    arrays = [pa.array(ids, pa.int64()), *[pa.array(x, pa.string()) for x in (texts, edited, own, changed)]]
    arrays += [pa.array(likeness(own, changed)), pa.array(likeness(own, following))]
    names = ["id", "text", "edited_text", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return pa.RecordBatch.from_arrays(arrays, names)


def range_of(value: Column, splitters: list[int]) -> Column:
    """How many of the sorted splitters are not above the value; null is below all."""
    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value < splitters[middle], search(low, middle)).otherwise(search(middle + 1, high))

    return F.when(value.isNull(), F.lit(0)).otherwise(search(0, len(splitters)))
