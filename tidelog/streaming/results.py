"""Keeping a stream's result as Parquet, to be read as a bounded frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidelog.session import state_settings
from tidelog.sources.layout import LogFolder
from tidelog.sources.positions import expire

_RESULTS = "results"
_RETAINED = 2


def keep(df: DataFrame, out: str, checkpoint: str, output_mode: str = "append") -> StreamingQuery:
    """Write what a stream has available: appended rows, or one whole result per micro-batch."""
    writer = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if output_mode == "append":
        writer = writer.format("parquet").option("path", out)
    else:

        def replace(batch: DataFrame, batch_id: int) -> None:
            folder = LogFolder(batch.sparkSession, out)
            batch.write.mode("overwrite").parquet(folder.batch_path(_RESULTS, batch_id))
            expire(batch.sparkSession, out, _RETAINED, _RESULTS)

        writer = writer.foreachBatch(replace)
    with state_settings(df):
        return writer.trigger(availableNow=True).start()


def newest_result(spark: SparkSession, out: str) -> DataFrame:
    """The whole result that a complete-mode :func:`keep` wrote last."""
    folder = LogFolder(spark, out)
    return spark.read.parquet(folder.batch_path(_RESULTS, folder.batches(_RESULTS)[-1]))
