"""Import of messages that were landed as lines of text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the separator between the fields of a landed line, which reads
# id##topic##milliseconds since 1970##payload
SEPARATOR = "##"


def read_landed_text(spark: SparkSession, path: str) -> DataFrame:
    """Envelope rows from landed lines; a payload may itself hold the separator.

    Under ANSI mode, Spark's default, a line without four fields or with a bad
    number fails the job, as such a line is a sign of a torn payload.
    """
    return parse_landed_lines(spark.read.text(path))


def parse_landed_lines(lines: DataFrame) -> DataFrame:
    """The same for any frame or stream with a ``value`` column of lines."""
    field = F.split("value", SEPARATOR, 4)
    return lines.select(
        field[0].cast("int").alias("id"),
        field[1].alias("topic"),
        field[3].cast("binary").alias("payload"),
        F.timestamp_millis(field[2].cast("long")).alias("timestamp"),
    )


def render_landed_lines(messages: DataFrame) -> DataFrame:
    """Envelope rows as landed lines. Payloads with a newline do not survive this."""
    return messages.select(
        F.concat_ws(
            SEPARATOR,
            F.col("id").cast("string"),
            "topic",
            F.unix_millis("timestamp").cast("string"),
            F.col("payload").cast("string"),
        ).alias("value")
    )
