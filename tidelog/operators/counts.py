"""Word counts, windows over arrival time, accounting. All work on batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.payload import as_text, tokens


def words(messages: DataFrame) -> DataFrame:
    """One row for each word of each payload, in column ``value``."""
    return messages.select(F.explode(tokens(as_text("payload"))).alias("value"))


def word_count(messages: DataFrame) -> DataFrame:
    """How often each word occurs; counted on the map side before the shuffle."""
    return words(messages).groupBy("value").agg(F.count(F.lit(1)).alias("count"))


def window_counts(
    messages: DataFrame, width: str, slide: str | None = None, delay: str | None = None
) -> DataFrame:
    """Messages for each topic and window of arrival time.

    ``delay`` sets a watermark: an append stream then emits a window once it is
    past, and the state of past windows is dropped.
    """
    if delay:
        messages = messages.withWatermark("timestamp", delay)
    window = F.window("timestamp", width, slide) if slide else F.window("timestamp", width)
    return (
        messages.groupBy(window.alias("window"), "topic")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "topic", "n")
    )


def topic_stats(log_rows: DataFrame) -> DataFrame:
    """For each topic: messages, payload bytes, first and last offset and time."""
    return log_rows.groupBy("topic").agg(
        F.count(F.lit(1)).alias("messages"),
        F.coalesce(F.sum(F.length("payload").cast("long")), F.lit(0)).cast("long").alias("bytes"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
        F.min("timestamp").alias("first_time"),
        F.max("timestamp").alias("last_time"),
    )
