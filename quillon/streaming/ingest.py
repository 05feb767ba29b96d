"""Incremental ingest of arriving files or events (an extension of batch ingest)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def arriving(spark: SparkSession, path: str, schema: str, time_column: str, delay: str = "1 day") -> DataFrame:
    """New Parquet files as a stream, late data bounded by a watermark."""
    return spark.readStream.schema(schema).parquet(path).withWatermark(time_column, delay)


def once_per_key(stream: DataFrame, key: str) -> DataFrame:
    """Each key once within the watermark: repeated deliveries are dropped."""
    return stream.dropDuplicatesWithinWatermark([key])


def windowed(stream: DataFrame, time_column: str, group: str, value: str, width: str = "1 hour") -> DataFrame:
    w = F.window(time_column, width)
    return stream.groupBy(w, group).agg(F.count("*").alias("n"), F.sum(value).alias("total"))


def append_to(stream: DataFrame, path: str, checkpoint: str):
    """Writes what has arrived and stops; the checkpoint remembers the files."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
