"""Sharding by extendible hashing.

A document's place is a hash of its id, read bit by bit. All documents begin in one bucket;
a bucket with more bytes than the limit is split on the next bit, others stay as they are, so
shards differ in depth. The bytes of all prefixes of eight more bits are counted at a time, for the
buckets still over the limit only; a directory entry is a prefix, never a document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import stored

LIMIT_BYTES = 64 << 20
_BITS = 60
_STEP = 10


def place(id_: Column) -> Column:
    """60 bits of a hash of the id's text; a null id counts as empty."""
    digest = F.md5(F.coalesce(id_.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, _BITS // 4), 16, 10).cast("long")


def assign(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit_bytes: int = LIMIT_BYTES
) -> DataFrame:
    """One row for each document: its id, bytes, shard, depth, shard_rows, shard_bytes, fits.

    ``shard`` is the bits of the directory entry, empty for the only shard; ``depth`` their number.
    Bytes are those of the text in UTF-8, 0 for null. A shard over the limit whose documents
    all have one hash, a single long document or rows that repeat an id, cannot be split and has
    fits = false. An empty table gives no rows. Extra columns are not read.
    """
    size = F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long")
    rows = docs.select(F.col(id_col).alias("id"), size.alias("bytes"), place(F.col(id_col)).alias("place"))
    open_rows = stored(rows, "shard-places")
    done = None
    for depth in range(0, _BITS, _STEP):
        cells = stored(_cells(open_rows, depth, limit_bytes), "shard-cells")
        at = F.shiftright("place", _BITS - depth - _STEP) == F.col("cell")
        dealt = open_rows.join(cells, at)
        found = dealt.where("depth IS NOT NULL").drop("cell")
        done = found if done is None else done.unionByName(found)
        if cells.where("depth IS NULL").isEmpty():
            break
        open_rows = stored(dealt.where("depth IS NULL").select("id", "bytes", "place"), "shard-places")
    shard = F.expr(f"CASE WHEN depth > 0 THEN lpad(bin(shiftright(place, {_BITS} - depth)), depth, '0') ELSE '' END")
    return done.select(
        F.col("id").alias(id_col), "bytes", shard.alias("shard"), "depth", "shard_rows", "shard_bytes",
        (F.col("shard_bytes") <= limit_bytes).alias("fits"),
    )


def _cells(rows: DataFrame, depth: int, limit_bytes: int) -> DataFrame:
    """For each prefix of _STEP more bits: the depth of its shard, null if it is to be split further."""
    cell = F.shiftright("place", _BITS - depth - _STEP).alias("cell")
    cells = rows.groupBy(cell).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("bytes").alias("bytes"), F.min("place").alias("least"), F.max("place").alias("most")
    )
    chosen = F.lit(None).cast("struct<depth:int,shard_rows:bigint,shard_bytes:bigint>")
    for bits in range(_STEP + 1):  # the shortest prefix that fits is the last to be written over
        ancestor = Window.partitionBy(F.shiftright("cell", bits))
        rows_of, bytes_of = F.sum("rows").over(ancestor), F.sum("bytes").over(ancestor)
        one = F.min("least").over(ancestor) == F.max("most").over(ancestor)
        here = F.struct(F.lit(depth + _STEP - bits).alias("depth"), rows_of.alias("shard_rows"), bytes_of.alias("shard_bytes"))
        if bits < _STEP or depth == 0:  # a bucket that is open here is known to be over the limit
            chosen = F.when((bytes_of <= limit_bytes) | one, here).otherwise(chosen)
    last = F.struct(F.lit(_BITS).alias("depth"), F.col("rows").alias("shard_rows"), F.col("bytes").alias("shard_bytes"))
    if depth + _STEP == _BITS:
        chosen = F.coalesce(chosen, last)
    return cells.select("cell", chosen.alias("entry")).select("cell", "entry.*")


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit_bytes: int = LIMIT_BYTES) -> None:
    """Write the documents as Parquet, one folder for each shard, named by its bits.

    The folders' column is called ``shard``, with as many ``_`` behind it as keep it apart from the columns of the input.
    Rows that repeat an id go to the same shard; a null text is empty, an empty table writes no shard.
    """
    name = "shard"
    while name in docs.columns:
        name += "_"
    shards = assign(docs, id_col, text_col, limit_bytes).select(
        F.col(id_col).alias("sharded id"), F.col("shard").alias(name)
    ).distinct()
    joined = docs.join(shards, docs[id_col].eqNullSafe(shards["sharded id"])).drop("sharded id")
    joined.repartition(name).write.partitionBy(name).parquet(path)
