"""The given tables as messages, and logs landed from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators.routing import fan_in
from tidelog.session import scratch_path
from tidelog.sources.layout import LogFolder
from tidelog.streaming.publish import land

# Packet ids are 32-bit and wrap around.
_ID_SPAN = 2147483648
_DOCS_START = 1704067200  # 2024-01-01 00:00:00 UTC

_logs: dict[tuple[str, str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def packet_id(column: str):
    return F.pmod(F.col(column), F.lit(_ID_SPAN)).cast("int").alias("id")


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select(
        packet_id("event_id"),
        F.concat(F.lit("events/"), "event_type").alias("topic"),
        F.col("props").cast("binary").alias("payload"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.pmod("event_id", F.lit(3)).cast("int").alias("qos"),
        F.lit(False).alias("retained"),
        F.lit(False).alias("duplicate"),
    )


def document_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return documents.select(
        packet_id("doc_id"),
        F.concat(F.lit("docs/"), "lang").alias("topic"),
        F.col("text").cast("binary").alias("payload"),
        F.timestamp_seconds(F.lit(_DOCS_START) + F.col("doc_id")).alias("timestamp"),
        F.lit(1).alias("qos"),
        F.lit(False).alias("retained"),
        F.lit(False).alias("duplicate"),
    )


def event_part(messages: DataFrame, part: int) -> DataFrame:
    """One of four parts of the events, by day of the month."""
    return messages.where(F.expr("(day(timestamp) - 1) div 8") == part)


def landed(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """A log landed from the tables once per application, then only read."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key in _logs and LogFolder(spark, _logs[key]).newest_batches():
        return _logs[key]
    log = scratch_path(spark, f"log-{kind}")
    if kind == "events":
        land(event_messages(spark, sf_dir), log)
    elif kind == "documents":
        land(document_messages(spark, sf_dir), log)
    elif kind == "all":
        land(fan_in(event_messages(spark, sf_dir), document_messages(spark, sf_dir)), log)
    elif kind == "parts":
        for part in range(4):
            land(event_part(event_messages(spark, sf_dir), part), log)
    else:
        raise ValueError(f"no such log: {kind}")
    _logs[key] = log
    return log
