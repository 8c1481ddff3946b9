"""Count words in the messages of one topic, printed as they change.

    spark-submit examples/stream_word_count.py <log> <topic>
"""

import sys

from pyspark.sql import SparkSession

from tidelog import configured, subscribe, word_count


def main(log: str, topic: str) -> None:
    spark = configured(SparkSession.builder.appName("stream-word-count")).getOrCreate()
    lines = subscribe(spark, {"path": log, "topic": topic})
    query = word_count(lines).writeStream.outputMode("complete").format("console").start()
    query.awaitTermination()


if __name__ == "__main__":
    if len(sys.argv) != 3:
        sys.exit(__doc__)
    main(*sys.argv[1:])
