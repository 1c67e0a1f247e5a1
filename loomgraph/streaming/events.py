"""Windowed counts over a stream of events, with late events up to a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENT = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def read_events(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream of the Parquet files of events that arrive in a folder."""
    reader = spark.readStream.schema(EVENT)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def windowed(events: DataFrame, length: str, slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """``start``, ``event_type``, ``events`` and ``value`` of each window; batch or stream."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    window = F.window("ts", length, slide) if slide else F.window("ts", length)
    counted = timed.groupBy(window.alias("window"), "event_type").agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("value"))
    return counted.select(F.col("window.start").cast("timestamp_ntz").alias("start"), "event_type", "events", "value")
