"""Running counts over a stream (ST-01, ST-02)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_event_time(stream: DataFrame, ts: str) -> DataFrame:
    """Watermarks need a zoned timestamp; read in a UTC session."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp"))


def running_counts(stream: DataFrame, key: str) -> DataFrame:
    """Rows by key so far; use output mode `complete` or `update`. State is one number per key."""
    return stream.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def hourly_counts(stream: DataFrame, ts: str, *keys: str, lateness: str = "1 hour", width: str = "1 hour") -> DataFrame:
    """Rows per window and key in event time; rows later than the watermark are dropped and closed windows leave the state."""
    windowed = with_event_time(stream, ts).withWatermark(ts, lateness)
    counted = windowed.groupBy(F.window(ts, width).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("w.start").alias("window_start"), *keys, "n")
