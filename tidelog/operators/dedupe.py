"""Removing messages that were delivered more than once.

The packet id alone does not identify a message, so copies are rows that agree
on topic, id and payload.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

# Fixed value: how many messages back a redelivery is looked for where nothing else is said.
BACKLOG = 500


def dedupe_stream(messages: DataFrame, delay: str, salts: int = 1) -> DataFrame:
    """One message for each set of copies that are read within ``delay`` of each other.

    The copy kept is from the first micro-batch that holds one. State keeps a
    digest in place of the payload. The watermark rests on the time of the micro-batch, which is
    in the checkpoint and only grows: a message is never late, whatever its ``timestamp``.
    With ``salts`` copies are first reduced by the
    task that read them, so that even a message that makes up a third of the
    stream passes through many tasks; at most ``salts`` of its copies meet in
    the second, deciding step. The first step costs as much state again.
    """
    keys = ["topic", "id", "__digest"]
    marked = messages.withColumn("__digest", F.unhex(F.sha2("payload", 256)))
    if salts > 1:
        marked = marked.withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    reduced = marked.withColumn("__read", F.current_timestamp()).withWatermark("__read", delay)
    if salts > 1:
        reduced = reduced.dropDuplicatesWithinWatermark([*keys, "__salt"])
    return reduced.dropDuplicatesWithinWatermark(keys).drop("__digest", "__salt", "__read")


def dedupe(messages: DataFrame) -> DataFrame:
    """First arrivals of a bounded frame, one row for each topic, id and payload.

    All columns of the first copy are kept, whichever the frame has. Copies are folded
    together before the shuffle.
    """
    keys = ["topic", "id", "payload"]
    others = [name for name in messages.columns if name not in keys and name != "timestamp"]
    first = F.min(F.struct("timestamp", *others)) if others else F.struct(F.min("timestamp").alias("timestamp"))
    kept = messages.groupBy(*keys).agg(first.alias("__first"))
    given = [F.col(name) if name in keys else F.col(f"__first.{name}").alias(name) for name in messages.columns]
    return kept.select(*given)


def _digest() -> Column:
    """Equal for equal topic, id and payload, NULLs included; lengths keep the parts apart."""
    topic, payload = F.coalesce("topic", F.lit("")), F.coalesce("payload", F.lit("").cast("binary"))
    head = F.concat_ws(
        ":", F.coalesce(F.length("topic").cast("string"), F.lit("-")), F.coalesce(F.col("id").cast("string"), F.lit("-")),
        F.col("payload").isNull().cast("string"), topic, F.lit(""),
    )
    return F.unhex(F.sha2(F.concat(head.cast("binary"), payload), 256))


def dedupe_last(messages: DataFrame, backlog: int = BACKLOG, offset: str = "offset") -> DataFrame:
    """Messages of a bounded, numbered frame without those that equal one of the ``backlog`` messages before.

    An equal message counts whether it was kept itself or not. It lies in the same block of ``backlog`` offsets or in the block before, so
    messages meet by digest and block: the copies of one message, however many, are spread over blocks, and
    a task's group holds no more than a block. Messages without an offset are kept.
    """
    marked = _in_blocks(messages, backlog, offset)
    within = Window.partitionBy("__digest", "__block").orderBy(offset)
    last = marked.groupBy("__digest", (F.col("__block") + 1).alias("__block")).agg(F.max(offset).alias("__last"))
    seen = marked.withColumn("__before", F.lag(offset).over(within)).join(last, ["__digest", "__block"], "left")
    before = F.coalesce("__before", "__last")
    kept = seen.where(before.isNull() | (F.col(offset) - before > backlog))
    return kept.select(*[F.col(f"`{name}`") for name in messages.columns])


def dedupe_last_stream(messages: DataFrame, backlog: int = BACKLOG, offset: str = "offset", buckets: int = 64) -> DataFrame:
    """The same for a stream of numbered messages that come in the order of their offsets.

    State holds the last offset of each digest for the newest two blocks of ``backlog`` offsets, in ``buckets`` parts, and forgets older blocks
    by their number. A message is sent to the bucket of its digest and block, and a note of it, without its payload, to that of the
    next block. A message that comes out of order is kept where its block is forgotten.
    """
    marked = _in_blocks(messages, backlog, offset)
    own = F.struct(F.col("__block").alias("block"), F.lit(False).alias("note"))
    note = F.struct((F.col("__block") + 1).alias("block"), F.lit(True).alias("note"))
    sent = marked.select("*", F.explode(F.array(own, note)).alias("__to")).where("__block IS NOT NULL OR NOT __to.note")
    # a note needs no payload; other columns stay, since numbers beside NULLs would not stay whole in pandas
    payload = F.when(~F.col("__to.note"), F.col("payload")).alias("payload")
    light = [payload if name == "payload" else F.col(f"`{name}`") for name in messages.columns]
    bucket = F.pmod(F.xxhash64("__digest", "__to.block"), F.lit(buckets)).cast("int").alias("__bucket")
    keyed = sent.select(*light, "__digest", F.col("__to.block").alias("__block"), F.col("__to.note").alias("__note"), bucket)
    names = messages.columns

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames)).sort_values(offset, kind="stable")
        digests, blocks, offsets = state.get if state.exists else ([], [], [])
        last = {(bytes(digest), block): at for digest, block, at in zip(digests, blocks, offsets)}
        keep = []
        for digest, block, at, is_note in zip(rows["__digest"], rows["__block"], rows[offset], rows["__note"]):
            if pd.isna(block):
                keep.append(True)
                continue
            place = (bytes(digest), int(block))
            before = last.get(place)
            keep.append(not is_note and (before is None or at - before > backlog))
            last[place] = int(at) if before is None else max(int(at), before)
        newest = max((block for _, block in last), default=0)
        left = [(digest, block, at) for (digest, block), at in last.items() if block >= newest - 1]
        state.update(tuple(map(list, zip(*left))) if left else ([], [], []))
        if any(keep):
            yield rows[keep][names]

    return keyed.groupBy("__bucket").applyInPandasWithState(
        step, messages.schema, "digests ARRAY<BINARY>, blocks ARRAY<BIGINT>, offsets ARRAY<BIGINT>", "append",
        GroupStateTimeout.NoTimeout,
    )


def _in_blocks(messages: DataFrame, backlog: int, offset: str) -> DataFrame:
    if backlog < 1:
        raise ValueError("the backlog must hold at least one message")
    block = F.call_function("div", F.col(offset), F.lit(backlog).cast("long"))
    return messages.withColumns({"__digest": _digest(), "__block": block})
