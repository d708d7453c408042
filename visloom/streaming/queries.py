"""Bounded runs of the streaming operators over the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import average
from ..session import fresh_folder, table
from ..sources import adapters as A
from ..sources import endpoints
from . import cadence, frames, history

INTERVAL, ACTIVE, PER_ITEM, START, STOP = 2, 3, 8, 0, 24
HOURS = 96


def _run(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run to the end of what is there now, into a table in the warehouse, and read that."""
    spark = stream.sparkSession
    folder = fresh_folder(spark, name)
    query = stream.writeStream.format("parquet").outputMode(mode).option("path", f"{folder}/rows").option("checkpointLocation", f"{folder}/log").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")


def _events(spark, d) -> DataFrame:
    """The events as a stream. A single file is given by its pattern, as file streams read folders."""
    schema = table(spark, d, "events").schema
    return spark.readStream.schema(schema).parquet(f"{d}/events.parque[t]")


def stream_frames(spark, d) -> DataFrame:
    """Items of frames that left the window, and rejected records, of the whole table by session; -1 for none."""
    heaps = A.heaps(_events(spark, d), by_session=True)
    out = _run(frames.assemble(heaps, INTERVAL, ACTIVE, PER_ITEM, START, STOP), "stream_frames")
    return out.select("session", F.coalesce("idx", F.lit(-1)).alias("idx"), "frequency", F.coalesce("payload", F.lit(-1)).alias("payload"), "reason", "arrival_seq")


def stream_average(spark, d) -> DataFrame:
    """Excised averages in event-time windows of ``HOURS`` hours, those that the watermark has closed."""
    k = F.get_json_object("props", "$.k").cast("int")
    rows = _events(spark, d).select(
        F.col("ts").cast("timestamp").alias("ts"),
        (F.floor(F.col("event_id") / 8) % A.N_CHANNELS).cast("int").alias("channel"),
        (F.col("event_id") % 8).cast("int").alias("bl"),
        F.floor(F.col("value") * 100 + 0.5).cast("int").alias("re"),
        (k - 50).alias("im"),
        F.when(k % 3 == 0, 16).otherwise(0).alias("flags"),
    )
    closed = _run(frames.averages(rows, 3600.0, HOURS, "1 minute"), "stream_average")
    index = F.floor(F.unix_seconds("window.start") / (3600 * HOURS)).cast("long")
    return average.finalise(closed.withColumn("out_idx", index), ["out_idx", "channel", "bl"], A.N_ACCS)


RATIO, BASELINES = 8, 64


def stream_count_windows(spark, d) -> DataFrame:
    """Excised averages of groups of ``RATIO`` hours, by count, of the groups that a later one has closed. Most baselines skip groups."""
    k = F.get_json_object("props", "$.k").cast("int")
    rows = _events(spark, d).select(
        F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 3600).alias("dump"),
        (F.floor(F.col("event_id") / 8) % 4).cast("int").alias("channel"),
        (F.col("user_id") % BASELINES).cast("int").alias("bl"),
        F.floor(F.col("value") * 100 + 0.5).cast("int").alias("re"),
        (k - 50).alias("im"),
        F.when(k % 3 == 0, 16).otherwise(0).alias("flags"),
    )
    closed = _run(cadence.count_windows(rows, ["bl"], RATIO), "stream_count_windows")
    return average.finalise(closed, ["out_idx", "channel", "bl"], A.N_ACCS)


def stream_asof(spark, d) -> DataFrame:
    """The batch as-of lookup on a stream, of the questions that the watermark has passed."""
    ts = F.col("ts").cast("timestamp")
    questions = _events(spark, d).select(F.col("user_id").alias("sensor"), F.col("event_id").alias("seq"), ts.alias("ts"), (ts + F.expr("INTERVAL 30 MINUTE")).alias("at"), F.col("event_id").alias("id"))
    out = _run(history.as_of(A.sensors(_events(spark, d)), questions, -1.0), "stream_asof")
    return out.select(F.col("id").alias("event_id"), "value")


def heaps_by_endpoint(spark, d) -> DataFrame:
    """Wanted records, read back through the data source from the endpoints that carry them."""
    folder = fresh_folder(spark, "capture")
    endpoints.record(A.heaps(table(spark, d, "events")), folder, PER_ITEM)
    return endpoints.read(spark, folder, PER_ITEM).where((F.col("frequency") >= START) & (F.col("frequency") < STOP))
