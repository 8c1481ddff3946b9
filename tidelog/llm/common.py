"""What the operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.session import scratch_path
from tidelog.sources.layout import LogFolder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
WORD = r"[^\x20\x09-\x0D]+"


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back.

    This cuts the lineage, and rows that were computed once stay as they are even
    when an executor is lost.
    """
    return stored_at(frame, scratch_path(frame.sparkSession, name))


def stored_at(frame: DataFrame, path: str) -> DataFrame:
    """The same at a place that the caller chooses, and may give to :func:`removed` when nothing reads it any more."""
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    LogFolder(spark, path).discard(path)


def give_back() -> None:
    """Return freed memory of this process to the system: the C library otherwise keeps up to 64 MB of it, and what lies between live blocks."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc alone
    if trim is not None:
        trim(0)


def strings(values: pa.Array) -> list[str]:
    """The values as a list, ten times as fast as ``to_pylist``."""
    return values.to_numpy(zero_copy_only=False).tolist()


def runs(texts: pa.Array, most: int) -> Iterator[pa.Array]:
    """Runs of neighbouring texts without nulls; those after a run's first one have less than ``most`` bytes."""
    if not len(texts):
        return
    upto = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64) // most
    firsts = [0, *(np.flatnonzero(np.diff(upto)) + 1).tolist(), len(texts)]
    for first, last in pairwise(firsts):
        yield texts.slice(first, last - first)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are; null is empty.

    ``lower`` does the same for texts of ASCII alone, and much faster.
    """
    filled = F.coalesce(text, F.lit(""))
    plain = F.octet_length(filled) == F.length(filled)
    return F.when(plain, F.lower(filled)).otherwise(F.translate(filled, UPPER, LOWER))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
