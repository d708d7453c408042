"""Averaging groups and time stamps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def groups(dumps: DataFrame, ratio: int) -> DataFrame:
    """(grp, first, last, n): groups of ``ratio`` consecutive indices; partial ones are kept, empty ones are not."""
    return dumps.groupBy(F.floor(F.col("dump") / ratio).cast("long").alias("grp")).agg(F.min("dump").alias("first"), F.max("dump").alias("last"), F.count_distinct("dump").alias("n"))


def mid_timestamp(index: Column, ratio: int, interval: int, base: Column, scale: float) -> Column:
    """Seconds from the sync time to the middle of an output dump."""
    return ((index + 0.5) * F.lit(float(ratio)) * F.lit(float(interval)) + base) / F.lit(float(scale))


def centiseconds(seconds: Column) -> Column:
    return (seconds * 100).cast("long")


def timestamps(frames: DataFrame, raw: Column, scale: float, sync_time: float) -> DataFrame:
    """``relative`` seconds since the sync time of a raw timestamp, ``unix`` seconds, and the instant they name."""
    out = frames.withColumn("relative", raw / F.lit(float(scale)))
    return out.withColumn("unix", F.lit(float(sync_time)) + F.col("relative")).withColumn("instant", F.timestamp_seconds("unix"))
