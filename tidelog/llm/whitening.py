"""Whitening of embeddings: components of equal variance that do not correlate.

The vectors, as whole numbers, are first made distinct; that fit list is stored. Its sums are exact
whole numbers. A second pass takes the covariance of the centred vectors, summed in the tasks before
anything is shuffled. The driver, which sees one matrix and no vectors, makes it
tridiagonal, bisects for its leading eigenvalues and finds the components by inverse iteration.
They are sent to the tasks, which project every vector that is left.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import stored
from tidelog.llm.eigen import leading
from tidelog.llm.vectors import by_length, finite, scaled

COMPONENTS = 16
SCALE = 64
SHIFT = 1_000_000
# Entries of this size or more cannot be summed exactly; such a vector is left out like a non-finite one.
LARGEST = 1 << 48
# An eigenvalue below this share of the largest is rounding, not a direction that the vectors have.
LEAST_SHARE = 1e-10
_LOW = (1 << 32) - 1
_MOST_LONG = (1 << 63) - 1
_WIDTHS = ((1 << 15, "<i2"), (1 << 31, "<i4"), (1 << 63, "<i8"))


@dataclass
class Whitening:
    """The fit list's size, exact sums and mean, and the components."""

    n: int
    sums: list[int]  # of x, for each dimension
    scale: int
    shift: int
    centre: np.ndarray  # the whole part of the mean of x - shift
    rest: np.ndarray  # and what is left of it
    values: np.ndarray  # eigenvalues, falling
    components: np.ndarray  # their unit vectors, as columns
    trace: float
    identity_error: float = 0.0

    @property
    def dims(self) -> int:
        return len(self.sums)

    def centred(self, lattice: np.ndarray) -> np.ndarray:
        """x - S/n of rows of ``x - shift``; whole numbers are taken off first, so that nothing is rounded away."""
        return (lattice - self.centre) - self.rest

    def whiten(self, lattice: np.ndarray) -> np.ndarray:
        return self.centred(lattice) @ (self.components / np.sqrt(self.values))

    def deviations(self, lattice: np.ndarray) -> list[int | None]:
        """The sum over dimensions of (n*x - S)^2 of each row; null where no long can hold it."""
        rest = np.array([total - self.n * (int(whole) + self.shift) for total, whole in zip(self.sums, self.centre)], object)
        away = lattice - self.centre
        largest = self.n * (int(np.abs(away).max(initial=0)) + 1)
        if largest * largest * max(1, self.dims) <= _MOST_LONG:
            off = self.n * away - rest.astype(np.int64)
            return (off * off).sum(axis=1).tolist()
        off = away.astype(object) * self.n - rest
        return [total if total <= _MOST_LONG else None for total in (off * off).sum(axis=1).tolist()]


def fit_list(vectors: DataFrame, vec_col: str, scale: int = SCALE) -> DataFrame:
    """Each distinct vector once, as bytes: ``dims`` and whole numbers of the narrowest width that holds them all."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, entries in by_length(batch.column(0)):
                lattice = scaled(entries, scale)
                largest = np.abs(lattice).max(axis=1, initial=0)
                below = 0
                for limit, kind in _WIDTHS:
                    own = lattice[(largest >= below) & (largest < limit)].astype(kind)
                    below = limit
                    if len(own):
                        vectors = pa.array([row.tobytes() for row in own], pa.binary())
                        dims = pa.array(np.full(len(own), lattice.shape[1], np.int32))
                        yield pa.RecordBatch.from_arrays([dims, vectors], ["dims", "vector"])

    return vectors.select(vec_col).mapInArrow(packed, "dims int, vector binary").distinct()


def unpacked(vectors: pa.Array, dims: int) -> Iterator[np.ndarray]:
    """Rows of a fit list as matrices, one for each width."""
    widths: dict[int, list[bytes]] = {}
    for vector in vectors.to_pylist():
        widths.setdefault(len(vector) // max(1, dims), []).append(vector)
    for width, own in widths.items():
        kind = f"<i{width}" if width else "<i2"
        yield np.frombuffer(b"".join(own), kind).astype(np.int64).reshape(len(own), dims)


def _sums(fitted: DataFrame, dims: int) -> tuple[int, list[int]]:
    """How many vectors there are and the sum of each dimension, in whole numbers throughout."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums = 0, [0] * dims
        for batch in batches:
            for lattice in unpacked(batch.column(0), dims):
                count += len(lattice)
                sums = [total + int(more) for total, more in zip(sums, lattice.sum(axis=0))]
        columns = [range(dims), [count] * dims, [total >> 32 for total in sums], [total & _LOW for total in sums]]
        yield pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in columns], ["dim", "n", "high", "low"])

    parts = fitted.mapInArrow(summed, "dim long, n long, high long, low long")
    totals = parts.groupBy("dim").agg(*[F.sum(name).alias(name) for name in ("n", "high", "low")]).orderBy("dim").collect()
    return totals[0]["n"], [(row["high"] << 32) + row["low"] for row in totals]


def _products(fitted: DataFrame, model: Whitening, whitened: bool) -> tuple[np.ndarray, np.ndarray]:
    """The sum of the products of each two columns of the centred (or whitened) fit list, and of each column."""
    shared = fitted.sparkSession.sparkContext.broadcast(model)
    size = len(model.values) if whitened else model.dims

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, sums = shared.value, np.zeros((size + 1, size))
        for batch in batches:
            for lattice in unpacked(batch.column(0), model.dims):
                rows = model.whiten(lattice) if whitened else model.centred(lattice)
                sums[:-1] += rows.T @ rows
                sums[-1] += rows.sum(axis=0)
        cells = np.arange(sums.size)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(sums.ravel())], ["cell", "value"])

    parts = fitted.mapInArrow(multiplied, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    found = parts.toArrow()
    sums = np.zeros((size + 1) * size)
    sums[found["cell"].to_numpy()] = found["value"].to_numpy()
    sums = sums.reshape(size + 1, size)
    return (sums[:-1] + sums[:-1].T) / 2, sums[-1]


def fit(vectors: DataFrame, vec_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> Whitening | None:
    """Components of the distinct vectors, or None where there is no vector.

    The driver holds a matrix of ``dims`` times ``dims``. Vectors that are null, or have
    an entry that is null, not finite or not below LARGEST / scale in size, are left out; of vectors of
    several lengths only the most frequent length is fitted, of equally frequent ones the longer. There are
    fewer components than asked for where the vectors lie in fewer directions; vectors that are all equal have none.
    """
    usable = vectors.where(finite(F.col(vec_col), LARGEST / scale)).select(F.col(vec_col).cast("array<double>").alias(vec_col))
    fitted = stored(fit_list(usable, vec_col, scale), "whitening-fit")
    lengths = fitted.groupBy("dims").count().orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()
    if not lengths or not lengths[0]["dims"]:
        return None
    dims = lengths[0]["dims"]
    own = fitted.where(F.col("dims") == dims).select("vector")
    n, sums = _sums(own, dims)
    centre = np.array([total // n for total in sums], np.int64)
    rest = np.array([(total % n) / n for total in sums])
    model = Whitening(n, [total + n * shift for total in sums], scale, shift, centre, rest, np.zeros(0), np.zeros((dims, 0)), 0.0)
    covariance = _products(own, model, whitened=False)[0] / n
    model.trace = float(np.trace(covariance))
    values, found = leading(covariance, components)
    real = (values > LEAST_SHARE * values.max(initial=0)) & (values > 0)
    model.values, model.components = values[real], found[:, real]
    if len(model.values):
        products, totals = _products(own, model, whitened=True)
        mean = totals / n
        away = products / n - np.outer(mean, mean) - np.eye(len(model.values))
        model.identity_error = float(np.abs(away).max())
    return model


def whiten(
    vectors: DataFrame, model: Whitening | None, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """One row for each vector and component: id, component, n, deviation, whitened, explained, identity_error.

    A vector that :func:`fit` would leave out has no row. A null id is kept; rows that repeat an id, or equal each other, are
    projected one by one; an empty table gives no rows; extra columns are not read.
    ``deviation`` is exact; it is null where it is beyond a long.
    """
    read = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vector"))
    id_type = read.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)
    shared = vectors.sparkSession.sparkContext.broadcast(model)
    usable = read.where(finite(F.col("vector"), LARGEST / model.scale) & (F.size("vector") == model.dims))

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        count = len(model.values)
        for batch in batches:
            for places, entries in by_length(batch.column("vector")):
                lattice = scaled(entries, model.scale)
                size = len(lattice)
                row = pa.array(np.repeat(np.arange(size), count))
                columns = [
                    batch.column("id").take(pa.array(places)).take(row),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), size)),
                    pa.array(np.full(size * count, model.n)),
                    pa.array(model.deviations(lattice), pa.int64()).take(row),
                    pa.array(model.whiten(lattice).ravel()),
                    pa.array(np.tile(model.values / model.trace, size) if count else np.zeros(0)),
                    pa.array(np.full(size * count, model.identity_error)),
                ]
                names = ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return usable.mapInArrow(projected, schema).withColumnRenamed("id", id_col)
