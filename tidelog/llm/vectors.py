"""Embedding columns as matrices of whole numbers, batch by batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(vector: Column, below: float) -> Column:
    """True where the vector and all its entries are there, and entries are finite and under ``below`` in size."""
    inside = F.forall(vector, lambda entry: F.coalesce(F.abs(entry.cast("double")) < F.lit(float(below)), F.lit(False)))
    return F.coalesce(inside, F.lit(False))


def by_length(vectors: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of a batch that are equally long: their places, and a matrix of their entries as doubles."""
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
    found = np.unique(lengths)
    for length in found.tolist():
        places = np.flatnonzero(lengths == length)
        own = vectors if len(found) == 1 else vectors.take(pa.array(places))
        yield places, own.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(places), length)


def scaled(entries: np.ndarray, scale: int) -> np.ndarray:
    """The largest whole numbers not above ``scale`` times the entries."""
    return np.floor(entries * scale).astype(np.int64)
