"""Hard negatives: rows of another label that come close to an anchor's nearest rows of its own.

Scores are inner products of whole numbers, by Kronecker-packed products: a component of
several thousand candidates, made positive by a bias, lies in separate fields of one wide
integer. That integer is multiplied once by the anchor's component; after the last component
each field holds the score of one candidate, exactly, which is unpacked by cutting the integer's
bytes into fields.

Anchors are taken in blocks of bounded size, and every block meets all rows where they are read: once for
the positives, once for the negatives in the band below each positive. Only the best few of each task are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.vectors import by_length, finite, scaled
from tidelog.operators.offsets import number_rows
from tidelog.session import scratch_path

SCALE = 256
# Whole components of this size or more are not scored, as if they were not finite.
LARGEST = 1 << 24
# So many components of anchors are sent to the tasks at once, 8 MB.
BLOCK_VALUES = 1 << 20
_CHUNK = 4096  # candidates in one integer


@dataclass
class Anchors:
    """A block of anchors, with their positives once these are known."""

    numbers: list[int]
    ids: list[int]
    labels: list[int]
    vectors: list[list[int]]
    positives: dict[int, list[tuple[int, int]]] = field(default_factory=dict)  # by number: score, id

    def widest(self) -> int:
        return max((sum(map(abs, vector)) for vector in self.vectors), default=0)


class Packed:
    """Candidates side by side in one integer for each component."""

    def __init__(self, candidates: np.ndarray, widest: int):
        """``widest`` bounds the sum of the sizes of an anchor's components."""
        self.count = len(candidates)
        self.bias = int(np.abs(candidates).max(initial=0))
        self.room = 2 * self.bias * widest  # no score with its biases is larger in size
        if self.room >= 1 << 62:
            raise ValueError("the vectors are too long for exact scores of 64 bits")
        self.kind = np.dtype("<u4" if self.room < 1 << 31 else "<u8")
        self.columns = [self._joined(column + self.bias) for column in candidates.T]
        self.positive = self._joined(np.full(self.count, self.room))

    def _joined(self, fields: np.ndarray) -> int:
        return int.from_bytes(fields.astype(self.kind).tobytes(), "little")

    def scores(self, anchor: list[int]) -> np.ndarray:
        """Of all candidates; a vector shorter than the other counts as followed by zeros."""
        total, biases = self.positive, self.room
        for component, packed in zip(anchor, self.columns):
            if component:
                total += component * packed
                biases += component * self.bias
        fields = np.frombuffer(total.to_bytes(self.count * self.kind.itemsize, "little"), self.kind)
        return fields.astype(np.int64) - biases


def best(scores: np.ndarray, ids: np.ndarray, count: int) -> list[tuple[int, int]]:
    """The first rows by falling score, then by id, as (-score, id)."""
    if len(scores) > 4 * count:
        least = np.partition(scores, len(scores) - count)[len(scores) - count]
        near = scores >= least
        scores, ids = scores[near], ids[near]
    order = np.lexsort((ids, -scores))[:count]
    return list(zip((-scores[order]).tolist(), ids[order].tolist()))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, labels and whole vectors of candidates, all of a length."""
    for batch in batches:
        for at in range(0, batch.num_rows, _CHUNK):
            part = batch.slice(at, _CHUNK)
            ids, labels = (part.column(name).to_numpy(zero_copy_only=False) for name in ("id", "label"))
            for places, entries in by_length(part.column("vector")):
                yield ids[places], labels[places], scaled(entries, 1)


def nearest_of_own_label(batches: Iterator[pa.RecordBatch], anchors: Anchors, count: int) -> dict[int, list[tuple[int, int]]]:
    """For each anchor's number the best (-score, id) among rows of its label and another id."""
    by_label: dict[int, list[int]] = {}
    for place, label in enumerate(anchors.labels):
        by_label.setdefault(label, []).append(place)
    widest = anchors.widest()
    found: dict[int, list[tuple[int, int]]] = {}
    for ids, labels, vectors in _chunks(batches):
        for label in np.unique(labels).tolist():
            if label not in by_label:
                continue
            own = labels == label
            packed, own_ids = Packed(vectors[own], widest), ids[own]
            for place in by_label[label]:
                scores = packed.scores(anchors.vectors[place])
                kept = found.setdefault(anchors.numbers[place], [])
                others = own_ids != anchors.ids[place]
                if len(kept) == count:
                    others &= scores >= -kept[-1][0]
                if others.any():
                    kept += best(scores[others], own_ids[others], count)
                    kept.sort()
                    del kept[count:]
    return found


def within_bands(
    batches: Iterator[pa.RecordBatch], anchors: Anchors, count: int, least: int, most: int
) -> dict[tuple[int, int], list[tuple[int, int]]]:
    """For each anchor's number and positive the best (-score, id) of another label between the two percentages of its score."""
    widest = anchors.widest()
    found: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for ids, labels, vectors in _chunks(batches):
        packed = Packed(vectors, widest)
        for number, label, vector in zip(anchors.numbers, anchors.labels, anchors.vectors):
            positives = anchors.positives.get(number, [])
            if not positives:
                continue
            scores = packed.scores(vector)
            hundredfold = scores * 100
            low = min(least * score for score, _ in positives)
            high = max(most * score for score, _ in positives)
            near = np.flatnonzero((hundredfold >= low) & (hundredfold <= high) & (labels != label))
            if not len(near):
                continue
            for place, (score, _) in enumerate(positives):
                kept = found.setdefault((number, place), [])
                inside = (hundredfold[near] >= least * score) & (hundredfold[near] <= most * score)
                if len(kept) == count:
                    inside &= scores[near] >= -kept[-1][0]
                own = near[inside]
                if len(own):
                    kept += best(scores[own], ids[own], count)
                    kept.sort()
                    del kept[count:]
    return found


def mine(
    rows: DataFrame, anchors: Column, id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding",
    positives: int = 5, negatives: int = 5, least_percent: int = 80, most_percent: int = 100, scale: int = SCALE,
) -> DataFrame:
    """For each anchor and each of its positives the first negatives in the band below the positive's score.

    Returns anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score. ``anchors`` is a
    condition on the rows. Components are the largest whole numbers not above ``scale`` times the vector's. Positives
    are the first rows of the anchor's label and another id, negatives the first rows of any other
    label whose score is from ``least_percent`` to ``most_percent`` of the positive's. Higher scores
    come first, ties by smaller id; a band of a negative score is empty, so its positive has no row.

    Ids and labels are whole numbers. Rows with a null id, label or vector, or with a component that is null, not finite or,
    scaled, not below LARGEST in size, take no part. A vector shorter than the other counts as followed by zeros. Each
    row that repeats an id is a row of its own: as an anchor it has its rows once more, as a positive or
    negative it takes a place of its own. An empty table, or one without anchors, gives no rows; extra columns are not read.
    """
    spark = rows.sparkSession
    whole = F.transform(vec_col, lambda entry: F.floor(entry.cast("double") * scale).cast("double"))
    taken = rows.where(
        F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & finite(F.col(vec_col), LARGEST / scale)
    )
    fields = [F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), whole.alias("vector")]
    candidates = taken.select(*fields)
    numbered, count = number_rows(
        taken.where(anchors).select(*fields), scratch_path(spark, "anchors"), order_by=("id", "label")
    )
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not count:
        return spark.createDataFrame([], schema)
    longest = numbered.agg(F.max(F.size("vector"))).first()[0]
    at_once = max(1, BLOCK_VALUES // max(1, longest))
    out = scratch_path(spark, "hard-negatives")
    for number, start in enumerate(range(0, count, at_once)):
        block = numbered.where(F.col("offset").between(start, start + at_once - 1)).toArrow().to_pydict()
        vectors = [list(map(int, vector)) for vector in block["vector"]]
        own = Anchors(block["offset"], block["id"], block["label"], vectors)
        _with_positives(candidates, own, positives)
        _negatives(candidates, own, negatives, least_percent, most_percent).write.parquet(f"{out}/block={number}")
    return spark.read.schema(f"{schema}, block int").parquet(out).drop("block")


def _with_positives(candidates: DataFrame, anchors: Anchors, count: int) -> None:
    """Give the anchors their positives, gathered from the best of each task."""
    shared = candidates.sparkSession.sparkContext.broadcast(anchors)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = nearest_of_own_label(batches, shared.value, count)
        flat = [(number, -score, id_) for number, kept in found.items() for score, id_ in kept]
        columns = [pa.array(column, pa.int64()) for column in (zip(*flat) if flat else ([], [], []))]
        yield pa.RecordBatch.from_arrays(columns, ["anchor", "score", "id"])

    best_first = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    near = candidates.mapInArrow(nearest, "anchor long, score long, id long")
    kept = near.withColumn("place", F.row_number().over(best_first)).where(F.col("place") <= count)
    gathered = kept.orderBy("anchor", "place").select("anchor", "score", "id").toArrow().to_pydict()  # ``count`` for each anchor of a block
    for number, score, id_ in zip(gathered["anchor"], gathered["score"], gathered["id"]):
        anchors.positives.setdefault(number, []).append((score, id_))


def _negatives(candidates: DataFrame, anchors: Anchors, count: int, least: int, most: int) -> DataFrame:
    shared = candidates.sparkSession.sparkContext.broadcast(anchors)

    def banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = shared.value
        anchor_ids = dict(zip(anchors.numbers, anchors.ids))
        flat = [
            (number, place, anchor_ids[number], *reversed(anchors.positives[number][place]), id_, -score)
            for (number, place), kept in within_bands(batches, anchors, count, least, most).items()
            for score, id_ in kept
        ]
        columns = [pa.array(column, pa.int64()) for column in (zip(*flat) if flat else [[]] * 7)]
        yield pa.RecordBatch.from_arrays(columns, names)

    names = ["anchor", "place", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
    near = candidates.mapInArrow(banded, ", ".join(f"{name} long" for name in names))
    best_first = Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), "negative_id")
    kept = near.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= count)
    return kept.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
