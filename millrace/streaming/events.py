"""Windows over event streams with watermarks; the same functions take a batch frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tumbling(df: DataFrame, time: str, size: str, aggregates: list[Column], keys=(), late: str | None = None) -> DataFrame:
    """Groups by windows of one size; events later than ``late`` after the newest are dropped from a stream."""
    return sliding(df, time, size, size, aggregates, keys, late)


def sliding(df: DataFrame, time: str, size: str, step: str, aggregates: list[Column], keys=(), late: str | None = None) -> DataFrame:
    df = df.withWatermark(time, late) if late else df
    out = df.groupBy(F.window(time, size, step).alias("w"), *keys).agg(*aggregates)
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *[c for c in out.columns if c != "w"])


def sessions(df: DataFrame, time: str, gap: str, aggregates: list[Column], keys=(), late: str | None = None) -> DataFrame:
    """Groups by sessions that end after a gap."""
    df = df.withWatermark(time, late) if late else df
    out = df.groupBy(F.session_window(time, gap).alias("w"), *keys).agg(*aggregates)
    return out.select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *[c for c in out.columns if c != "w"])


def dedup(df: DataFrame, keys: list[str], time: str, late: str) -> DataFrame:
    """Drops events whose keys were seen within the watermark."""
    return df.withWatermark(time, late).dropDuplicatesWithinWatermark(keys) if df.isStreaming else df.dropDuplicates(keys)


def to_files(df: DataFrame, path: str, checkpoint: str, every: str = "200 milliseconds"):
    """A continuous append of a stream to Parquet files."""
    return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(processingTime=every).start()
