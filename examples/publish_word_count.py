"""Count words in lines of text files and publish the counts to a topic.

    spark-submit examples/publish_word_count.py <folder of text> <log> <topic> <checkpoint>
"""

import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidelog import configured, publish_stream, word_count


def main(folder: str, log: str, topic: str, checkpoint: str) -> None:
    spark = configured(SparkSession.builder.appName("publish-word-count")).getOrCreate()
    lines = spark.readStream.text(folder).select(F.col("value").cast("binary").alias("payload"))
    query = publish_stream(
        word_count(lines), log, checkpoint, topic, output_mode="complete", trigger={"processingTime": "10 seconds"}
    )
    query.awaitTermination()


if __name__ == "__main__":
    if len(sys.argv) != 5:
        sys.exit(__doc__)
    main(*sys.argv[1:])
