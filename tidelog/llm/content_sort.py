"""Exact copies by a sort of the content.

Splitters sampled by Spark deal the texts out by ranges of their normalised
beginning; an external sort places equal texts next to each other, and a sorted
aggregate compares each whole text with its neighbour. This is done twice. First the ranges also
split by the task that read a row, so that a group of copies of any size is spread over as many
ranges as it fills; that leaves one row for a text and reading task. Then these rows are dealt by beginning and hash
alone, so that equal texts of all tasks lie next to each other. A text never lies across the edge of a range.
The digest that groups are named by finds no copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import lower_ascii, stored

# Splitters are held by the driver, so they are made from this many characters
# and a hash, not from whole texts.
_BEGINNING = 64


def copy_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", largest: bool = False) -> DataFrame:
    """One row for each different text: text_sha256, keep_id, group_size.

    Texts are equal when they are identical after A-Z are lower-cased; null is empty.
    keep_id is the smallest identifier of the group, or the largest; a null identifier
    stays only where a group has no other. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), lower_ascii(F.col(text_col)).alias("content")).select(
        "id",
        "content",
        F.substring("content", 1, _BEGINNING).alias("beginning"),
        F.xxhash64("content").alias("digest"),
        F.spark_partition_id().alias("reader"),
    )
    best = F.max if largest else F.min
    own = F.when(F.col("id").isNotNull(), F.struct("id"))
    read = _neighbours(rows, ["beginning", "digest", "reader"], best(own).alias("best"), F.count(F.lit(1)).alias("copies"))
    whole = _neighbours(read, ["beginning", "digest"], best("best").alias("best"), F.sum("copies").alias("copies"))
    groups = whole.select(
        F.sha2("content", 256).alias("text_sha256"), F.col("best.id").alias("keep_id"), F.col("copies").alias("group_size")
    )
    return stored(groups, "copy-groups")


def _neighbours(rows: DataFrame, ranges: list[str], *aggregates: Column) -> DataFrame:
    """Equal texts of a range of ``ranges`` as one row, by a comparison of whole neighbours.

    A struct among the aggregates keeps Spark to its sorted aggregate: nothing is hashed.
    """
    ordered = rows.repartitionByRange(*ranges).sortWithinPartitions(*ranges, "content")
    return ordered.groupBy(*ranges, "content").agg(*aggregates)


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", largest: bool = False) -> DataFrame:
    """One row for each document: its id, keep_id, group_size, kept, text_sha256.

    ``kept`` is true where the id is keep_id; rows that repeat the kept id and text are
    all marked. Extra columns are not read. See ``copy_groups`` for nulls and ties.
    """
    groups = copy_groups(docs, id_col, text_col, largest)
    marked = docs.select(F.col(id_col), F.sha2(lower_ascii(F.col(text_col)), 256).alias("text_sha256"))
    return marked.join(groups, "text_sha256").select(
        F.col(id_col), "keep_id", "group_size", F.col(id_col).eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", largest: bool = False) -> DataFrame:
    """The documents without their copies, with all columns of the input.

    Exactly one row of each group stays: the one of ``keep_id``; of rows that repeat
    this id and text any one.
    """
    kept = copy_groups(docs, id_col, text_col, largest).select(
        F.col("text_sha256").alias("copy group digest"), F.col("keep_id").alias("copy group id")
    )
    digest = F.sha2(lower_ascii(docs[text_col]), 256)
    same = (digest == kept["copy group digest"]) & docs[id_col].eqNullSafe(kept["copy group id"])
    return (
        docs.join(kept, same)
        .dropDuplicates(["copy group digest", "copy group id"])
        .select(*[docs[name] for name in docs.columns])
    )
