"""Mixing sources to target weights by systematic sampling.

Every document of a source is to be taken ``target / source size`` times, in whole
copies. The expected copies are summed up along the documents of the source from one
random start, and a document is taken once for each whole number its stretch crosses.
Documents run in order of size and, within about an eighth of the same size, of a
hash, so that the words taken come near the target for any mixture of sizes.

The running sum is kept in units of 2^-32 copies and modulo one copy, hence exact. It
comes from counts in four levels (class of size, hash prefix, longer hash prefix, document), so no
window holds more than a small share of a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import WORD, stored

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
SEED = "mix"
_ROWS_IN_CELL = 512
_ONE = 1 << 32


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def size_class(size: Column) -> Column:
    """Grows with the size; sizes of one class differ by an eighth at most."""
    bits = F.length(F.bin(size))
    return bits * 16 + F.expr("shiftright(size, greatest(length(bin(size)) - 4, 0))")


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """For each source its size, target and copies of a document in 2^-32.

    ``sizes`` has source and size. Sources in order of code points, null last, have the
    weights in turn. A target stops at ``most`` times the size; what it leaves is
    shared by the others. Works on one row for each source.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weighed = per_source.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")))
    cap = F.col("source_size") * most
    # sources reach their caps in this order as the level, words for a weight of one, rises
    ratio = cap.cast("double") / F.col("weight")
    everything = Window.partitionBy()
    upto = Window.orderBy("ratio").rangeBetween(Window.unboundedPreceding, 0)
    filled = (
        weighed.withColumn("ratio", ratio)
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("capped", F.sum(cap).over(upto) + F.col("ratio") * (F.col("all_weight") - F.sum("weight").over(upto)) <= F.col("total"))
        .withColumn("capped_size", F.sum(F.when(F.col("capped"), cap).otherwise(0)).over(everything))
        .withColumn("free_weight", F.sum(F.when(F.col("capped"), 0).otherwise(F.col("weight"))).over(everything))
    )
    level = (F.col("total") - F.col("capped_size")).cast("double") / F.nullif(F.col("free_weight"), F.lit(0)).cast("double")
    target = F.when(F.col("capped"), cap.cast("double")).otherwise(level * F.col("weight"))
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * float(_ONE))).otherwise(0)
    start = F.conv(F.substring(F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce("source", F.lit("")))), 1, 8), 16, 10)
    return filled.withColumn("target", target).select(
        "source", "source_size", "target", copies.cast("long").alias("copies"), start.cast("long").alias("start")
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row for each document: its id, size, source_size, target, copies, taken.

    ``copies`` times the document is in the mix, ``taken`` is that times its size in
    words. Null texts are empty, size 0; a null source is a source of its own. Rows
    that repeat an id count one by one. An empty table gives no rows. Extra columns are not read.
    """
    sized = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col)).alias("size"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("hash"),
    )
    sized = stored(sized.withColumn("class", size_class(F.col("size"))), "mix-sizes")
    counted = sized.groupBy("source", "class").agg(F.count(F.lit(1)).alias("rows"))
    targets = source_targets(sized)
    # hash digits that leave no more than about _ROWS_IN_CELL documents in a cell
    digits = F.ceil(F.log2(F.greatest(F.col("rows") / _ROWS_IN_CELL, F.lit(1.0))) / 4).cast("int")
    classes = counted.join(targets, counted["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    before = Window.partitionBy("source").orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
    classes = stored(
        classes.withColumn("digits", digits).withColumn("class_before", F.coalesce(F.sum("rows").over(before), F.lit(0))),
        "mix-classes",
    )
    same_class = sized["source"].eqNullSafe(classes["source"]) & (sized["class"] == classes["class"])
    dealt = sized.join(classes, same_class).select(
        sized["*"], "source_size", "target", "copies", "start", "class_before",
        F.substring(F.col("hash"), F.lit(1), F.floor(F.col("digits") / 2).cast("int")).alias("block"),
        F.substring(F.col("hash"), F.lit(1), F.col("digits")).alias("cell"),
    )
    dealt = stored(dealt, "mix-dealt")
    cell = ["source", "class", "block", "cell"]
    cells = dealt.groupBy(*cell).agg(F.count(F.lit(1)).alias("rows"))
    blocks = cells.groupBy(*cell[:3]).agg(F.sum("rows").alias("rows"))
    in_class = Window.partitionBy("source", "class").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    in_block = Window.partitionBy(*cell[:3]).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(*cell[:3], F.coalesce(F.sum("rows").over(in_class), F.lit(0)).alias("block_before"))
    cells = cells.select(*cell, F.coalesce(F.sum("rows").over(in_block), F.lit(0)).alias("cell_before"))
    alike = lambda a, b, keys: [a[k].eqNullSafe(b[k]) for k in keys]
    cells = cells.join(blocks, alike(cells, blocks, cell[:3])).select(
        *[cells[k] for k in cell], (F.col("cell_before") + F.col("block_before")).alias("rows_before")
    )
    rank = F.row_number().over(Window.partitionBy(*cell).orderBy("hash", "id", "size"))
    ranked = dealt.join(cells, alike(dealt, cells, cell)).select(
        dealt["*"], (F.col("class_before") + F.col("rows_before")).alias("rows_before")
    )
    ranked = ranked.withColumn("before", F.col("rows_before") + rank - 1)
    # (start + before * copies) modulo one copy; both factors are cut to 16 bits to stay in a long
    low, high = F.col("before").bitwiseAND(0xFFFF), F.shiftright("before", 16).bitwiseAND(0xFFFF)
    part = F.col("copies").bitwiseAND(_ONE - 1)
    position = (F.col("start") + low * part + F.shiftleft((high * part).bitwiseAND(0xFFFF), 16)).bitwiseAND(_ONE - 1)
    crossed = F.shiftright(position + F.col("copies"), 32)
    return ranked.withColumn("crossed", crossed).select(
        F.col("id").alias(id_col), "size", "source_size", "target", F.col("crossed").alias("copies"),
        (F.col("crossed") * F.col("size")).alias("taken"),
    )


def take(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: each document as often as it is taken, with all columns of the input.

    Rows that repeat an id, those without one among them, are taken equally often, as often as the one of them taken most.
    """
    turn = "turn"
    while turn in docs.columns:  # the caller's columns all stay
        turn += "_"
    copies = mix(docs, id_col, text_col, source_col).groupBy(id_col).agg(F.max("copies").alias("times taken"))
    copies = copies.where(F.col("times taken") > 0).withColumnRenamed(id_col, "taken id")
    taken = docs.join(copies, docs[id_col].eqNullSafe(copies["taken id"]))
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("times taken")))
    return taken.select(*[docs[name] for name in docs.columns], each.alias(turn)).drop(turn)
