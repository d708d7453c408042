"""Sensor histories: strictly newer samples, backward as-of lookups, external flags."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import CAM, STATIC
from .frames import running_max
from .samples import masked

log = logging.getLogger(__name__)

#: Length of a bucket of time in as-of lookups.
BUCKET_SECONDS = 86_400.0


def strictly_newer(samples: DataFrame) -> DataFrame:
    """Samples (sensor, ts, seq, ...) later than all before them in order of arrival."""
    return running_max(samples, F.col("ts"), "_seen", "seq", ["sensor"]).where("_seen IS NULL OR ts > _seen").drop("_seen")


def as_of(queries: DataFrame, samples: DataFrame, default: Column | None = None, bucket: float = BUCKET_SECONDS) -> DataFrame:
    """Each query (sensor, at, ...) with the ``value`` of the last sample with ts <= at; of samples at one time the last by seq counts.

    Both sides go by (sensor, bucket of time), so that no task sees a sensor's whole history; the last value of the
    buckets before comes from one row a bucket. Times are timestamps, or numbers in seconds. Null values are no samples.
    """
    names = [c for c in queries.columns if c not in ("sensor", "at")]
    left = queries.select("sensor", F.col("at").alias("t"), F.lit(1).alias("side"), F.lit(None).cast("long").alias("seq"), F.lit(None).cast(samples.schema["value"].dataType).alias("value"), F.struct(*names).alias("row"))
    right = samples.select("sensor", F.col("ts").alias("t"), F.lit(0).alias("side"), F.col("seq").cast("long"), "value", F.lit(None).cast(left.schema["row"].dataType).alias("row"))
    seconds = F.unix_seconds("t") if dict(left.dtypes)["t"].startswith("timestamp") else F.col("t")
    both = left.union(right).withColumn("bucket", F.floor(seconds / F.lit(bucket)).cast("long"))
    ends = both.groupBy("sensor", "bucket").agg(F.max_by("value", F.when(F.col("value").isNotNull(), F.struct("t", "seq"))).alias("end"))
    before = Window.partitionBy("sensor").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("sensor", "bucket", F.last("end", ignorenulls=True).over(before).alias("carried"))
    upto = Window.partitionBy("sensor", "bucket").orderBy("t", "side", "seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.join(carried, ["sensor", "bucket"]).withColumn("value", F.coalesce(F.last("value", ignorenulls=True).over(upto), "carried")).where("side = 1")
    value = F.col("value") if default is None else F.coalesce("value", default)
    return found.select("sensor", F.col("t").alias("at"), *[F.col(f"row.{n}").alias(n) for n in names], value.alias("value"))


def baseline_suspects(baselines: DataFrame, suspects: DataFrame) -> DataFrame:
    """(dump, bl, baseline_flags): CAM where either antenna is suspect in a dump. ``baselines``: bl, ant1, ant2; ``suspects``: dump, antenna, suspect."""
    ends = baselines.select("bl", F.explode(F.array_distinct(F.array("ant1", "ant2"))).alias("antenna"))
    return suspects.join(F.broadcast(ends), "antenna").groupBy("dump", "bl").agg(F.when(F.bool_or("suspect"), CAM).otherwise(0).alias("baseline_flags"))


def input_suspects(baselines: DataFrame, labels: list[str], sensor: DataFrame) -> DataFrame:
    """(dump, bl, baseline_flags) of every baseline in every dump that the sensor has a reading of: CAM where either input is suspect,
    else 0. ``baselines``: bl, input1, input2; ``sensor``: dump and an array of booleans, one for each of ``labels``; shorter arrays and
    nulls say nothing, and neither does an input without a label."""
    positions = F.create_map(*[F.lit(x) for k, label in enumerate(labels) for x in (label, k)]) if labels else F.lit(None).cast("map<string,int>")
    at = lambda c: F.coalesce(F.try_element_at(positions, F.col(c)), F.lit(-1)).alias(f"{c}_at")
    ends = baselines.select("bl", at("input1"), at("input2"))
    bad = lambda c: F.coalesce(F.get("suspects", F.col(f"{c}_at")), F.lit(False))
    # Of several readings of a dump each counts. A dump's baselines are the product asked for, and baselines a few thousand.
    return sensor.select("dump", "suspects").join(ends).groupBy("dump", "bl").agg(F.when(F.bool_or(bad("input1") | bad("input2")), CAM).otherwise(0).alias("baseline_flags"))


def any_suspects(*flags: DataFrame) -> DataFrame:
    """Several (dump, bl, baseline_flags) as one."""
    out = flags[0]
    for more in flags[1:]:
        out = out.unionByName(more)
    return out.groupBy("dump", "bl").agg(F.bit_or("baseline_flags").alias("baseline_flags"))


def channel_flags(live: DataFrame, suspect: DataFrame | None = None) -> DataFrame:
    """(dump, channel, channel_flags): STATIC by the dump's live channel mask, CAM by its suspect channels (none if that sensor is not used)."""
    out = live.select("dump", "channel", F.lit(STATIC).alias("f"))
    if suspect is not None:
        out = out.union(suspect.select("dump", "channel", F.lit(CAM).alias("f")))
    return out.groupBy("dump", "channel").agg(F.bit_or("f").alias("channel_flags"))


def channels_at_dumps(dumps: DataFrame, sensor: DataFrame, start: int, stop: int, int_time: float = 0.0) -> DataFrame:
    """(dump, channel) of the channels that a sensor of channels (ts, seq, value) says yes to, by its last value before the end of each dump.

    ``dumps``: dump and ``mid``, its middle in seconds. A value is an array of booleans over the whole band, of which [start, stop) counts;
    arrays of arrays, an old form, count by their first row, with a warning. Dumps before the first value have no channels; neither
    have channels beyond a short array, nor nulls.
    """
    if isinstance(sensor.schema["value"].dataType.elementType, T.ArrayType):
        log.warning("a channel sensor has rows of channels; only the first is used")
        sensor = sensor.withColumn("value", F.get("value", F.lit(0)))
    asked = dumps.select(F.lit("channels").alias("sensor"), (F.col("mid") + F.lit(0.5 * int_time)).alias("at"), "dump")
    told = as_of(asked, sensor.select(F.lit("channels").alias("sensor"), "ts", "seq", "value"))
    return told.select("dump", F.posexplode("value").alias("channel", "said")).where(F.col("said") & (F.col("channel") >= start) & (F.col("channel") < stop)).select("dump", "channel")


def external_flags(grid: DataFrame, baselines: DataFrame, channel_masks: DataFrame, n_masks: int, live: DataFrame, suspect: DataFrame | None = None) -> DataFrame:
    """``flags`` of (dump, channel, bl): by the baseline's static mask, the dump's live channel mask and its suspect channels."""
    df = masked(grid, baselines, channel_masks, n_masks).join(channel_flags(live, suspect), ["dump", "channel"], "left")
    return df.withColumn("flags", F.coalesce("mask_flags", F.lit(0)).bitwiseOR(F.coalesce("channel_flags", F.lit(0)))).drop("mask_flags", "channel_flags")
