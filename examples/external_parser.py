"""Read binary readings, two big-endian numbers each, with a parser of one's own.

    spark-submit examples/external_parser.py <log> <topic>
"""

import struct
import sys

import pandas as pd
from pyspark.sql import SparkSession

from tidelog import configured, parse_rows, subscribe


def readings(batch: pd.DataFrame) -> pd.DataFrame:
    pairs = [struct.unpack(">id", raw) for raw in batch["payload"]]
    return pd.DataFrame(
        {"topic": batch["topic"].to_numpy(), "sensor": [p[0] for p in pairs], "value": [p[1] for p in pairs]}
    )


def main(log: str, topic: str) -> None:
    spark = configured(SparkSession.builder.appName("external-parser")).getOrCreate()
    messages = subscribe(spark, {"path": log, "topic": topic}).select("topic", "payload")
    parsed = parse_rows(messages, readings, "topic STRING, sensor INT, value DOUBLE")
    parsed.writeStream.outputMode("append").format("console").start().awaitTermination()


if __name__ == "__main__":
    if len(sys.argv) != 3:
        sys.exit(__doc__)
    main(*sys.argv[1:])
