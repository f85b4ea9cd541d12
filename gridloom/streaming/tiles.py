"""A stream of new raster cells or events, beyond the batch operators: the same plans run on each micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType


def process_new_files(spark: SparkSession, path: str, schema: StructType, plan: Callable[[DataFrame], DataFrame], target: str, checkpoint: str) -> StreamingQuery:
    """Runs plan on the files that are new since the last run, and appends what it gives to target, each batch to a folder of its own so that a repeated batch replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        plan(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return spark.readStream.schema(schema).parquet(path).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_means(events: DataFrame, window: str = "30 days", late: str = "1 day") -> DataFrame:
    """Means by event type and time window of a stream, closed once the watermark has passed."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", window), "event_type").agg(F.avg("value").alias("mean"), F.count(F.lit(1)).alias("n"))
