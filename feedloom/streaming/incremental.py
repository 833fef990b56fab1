"""Incremental collection with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedloom.functions.urls import canonical_url


def new_posts(stream: DataFrame, time_column: str, delay: str = "10 minutes") -> DataFrame:
    """First post of each canonical address within the watermark."""
    keyed = stream.withColumn("canon", canonical_url(F.col("url")))
    return keyed.withWatermark(time_column, delay).dropDuplicatesWithinWatermark(["canon"])


def windowed_counts(stream: DataFrame, time_column: str, group: str, size: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Rows of each group in tumbling windows."""
    return stream.withWatermark(time_column, delay).groupBy(F.window(time_column, size), group).agg(F.count(F.lit(1)).alias("n"))


def append_new(stream: DataFrame, target: str, key: str, checkpoint: str) -> StreamingQuery:
    """Append rows whose key the target does not hold, one micro-batch at a time; a repeated batch adds nothing."""

    def write(batch: DataFrame, _: int) -> None:
        from feedloom.sources.files import exists

        once = batch.dropDuplicates([key])
        if exists(batch.sparkSession, target):
            once = once.join(batch.sparkSession.read.parquet(target).select(key).distinct(), key, "left_anti")
        once.write.mode("append").parquet(target)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
