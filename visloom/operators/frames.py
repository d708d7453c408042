"""Frame assembly from network records, in batch form over the order of arrival.

The window of open frames depends on everything that came before, so its running maximum runs over the
whole session. It is taken in two levels: within ranges of ``BLOCK`` arrivals in parallel, and over one row a
range, so no task sees a long session whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import TIMESTAMP_BITS

BLOCK = 1 << 16
#: The reasons for which a record is not used, in no order.
REASONS = ("incomplete", "no-descriptor", "bad-heap", "metadata", "too-old", "bad-timestamp", "bad-channel")


#: Kinds of records that have no time: they neither set the base nor move the window.
UNTIMED = ("metadata", "no-descriptor", "bad-heap")


def running_max(df: DataFrame, value: Column, name: str, order: str = "arrival_seq", keys: tuple | list = ()) -> DataFrame:
    """Maximum of ``value`` over all earlier rows (of the same keys), null for none."""
    df = df.withColumns({"_block": F.floor(F.col(order) / BLOCK).cast("long"), "_value": value})
    at = [*keys, "_block"]
    blocks = df.groupBy(*at).agg(F.max("_value").alias("_top"))
    earlier = (Window.partitionBy(*keys).orderBy("_block") if keys else Window.orderBy("_block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(*at, F.max("_top").over(earlier).alias("_before"))
    inner = Window.partitionBy(*at).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.join(blocks, at).withColumn(name, F.greatest(F.max("_value").over(inner), F.col("_before"))).drop("_block", "_value", "_before")


def unwrap(df: DataFrame, bits: int = TIMESTAMP_BITS, order: str = "arrival_seq") -> DataFrame:
    """``ts``: ``ts_raw`` without its wraps. A jump of more than half the range since the last record with a time is a wrap, forwards or back."""
    whole, half = 1 << bits, 1 << (bits - 1)
    df = df.withColumn("_block", F.floor(F.col(order) / BLOCK).cast("long"))
    inner = Window.partitionBy("_block").orderBy(order)
    earlier = Window.unboundedPreceding, -1
    ends = df.groupBy("_block").agg(F.max_by("ts_raw", F.when(F.col("ts_raw").isNotNull(), F.col(order))).alias("_end"))
    ends = ends.select("_block", F.last("_end", ignorenulls=True).over(Window.orderBy("_block").rowsBetween(*earlier)).alias("_previous"))
    last = F.last("ts_raw", ignorenulls=True).over(inner.rowsBetween(*earlier))
    df = df.join(ends, "_block").withColumn("_jump", F.col("ts_raw") - F.coalesce(last, F.col("_previous"), F.col("ts_raw")))
    df = df.withColumn("_wraps", F.when(F.col("_jump") < -half, 1).when(F.col("_jump") > half, -1).otherwise(0))
    sums = df.groupBy("_block").agg(F.sum("_wraps").alias("_sum"))
    sums = sums.select("_block", F.coalesce(F.sum("_sum").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    df = df.join(sums, "_block").withColumn("ts", F.col("ts_raw") + F.lit(whole) * (F.col("_before") + F.sum("_wraps").over(inner)))
    return df.drop("_block", "_previous", "_jump", "_wraps", "_before")


def first_timestamp(heaps: DataFrame) -> DataFrame:
    """One row: the timestamp of the first record that has one, whether or not its data can be used."""
    return heaps.where(~F.col("kind").isin(*UNTIMED) & F.col("ts_raw").isNotNull()).agg(F.min_by("ts_raw", "arrival_seq").alias("ts0"))


def classify(heaps: DataFrame, interval: int, active_frames: int, channels_per_item: int, start: int, stop: int, bits: int | None = None, base: int | None = None) -> DataFrame:
    """``idx`` (frame number), ``reason`` and ``moves`` (whether it counts for the window) of each record; reason 'ok' is stored in its frame.

    Records with a timestamp on the grid move the window of open frames even if they are not stored: those
    that are incomplete, lack an item (kind 'bad-item', reason 'bad-heap') or lie in an unwanted channel. Incomplete
    ones keep that reason if they are old or have no time. Records that cannot be decoded ('bad-heap') have no time.
    With ``bits``, timestamps of so many bits are unwrapped first. Frames count from ``base``, such as one that sessions share, or else from the
    first timestamp of these records; what lies before it is too old.
    """
    if bits is not None:
        heaps = heaps.withColumn("ts_raw", F.when(~F.col("kind").isin(*UNTIMED), F.col("ts_raw")))
        heaps = unwrap(heaps, bits).withColumn("ts_raw", F.col("ts")).drop("ts")
    df = heaps.join(F.broadcast(first_timestamp(heaps))) if base is None else heaps.withColumn("ts0", F.lit(base).cast("long"))
    idx = F.floor((F.col("ts_raw") - F.col("ts0")) / interval).cast("long")
    aligned = F.pmod(F.col("ts_raw") - F.col("ts0"), F.lit(interval)) == 0
    timed = ~F.col("kind").isin(*UNTIMED)
    df = df.withColumns({"idx": F.when(timed, idx), "_aligned": aligned})
    df = running_max(df, F.when(timed & aligned, F.col("idx")), "_top")
    late = F.col("idx") < F.greatest(F.lit(0).cast("long"), F.coalesce("_top", F.lit(0)) - (active_frames - 1))
    wanted = (F.col("frequency") % channels_per_item == 0) & (F.col("frequency") >= start) & (F.col("frequency") < stop)
    reason = (
        F.when(F.col("kind").isin("incomplete", *UNTIMED), F.col("kind"))
        .when(late, "too-old")
        .when(~F.col("_aligned"), "bad-timestamp")
        .when(F.col("kind") == "bad-item", "bad-heap")
        .when(~wanted, "bad-channel")
        .otherwise("ok")
    )
    return df.withColumns({"reason": reason, "moves": F.coalesce(timed & aligned & ~late, F.lit(False))}).drop("_top", "_aligned", "ts0")


def items(classified: DataFrame) -> DataFrame:
    """(idx, frequency, payload): one item for each place in a frame; of repeated records the last counts."""
    return classified.where("reason = 'ok'").groupBy("idx", "frequency").agg(F.max_by("payload", "arrival_seq").alias("payload"))


def grid(classified: DataFrame, frequencies: list[int]) -> DataFrame:
    """All (idx, frequency) from frame 0 to the last one reached."""
    last = classified.where("moves").agg(F.max("idx").alias("last"))
    frames = last.where("last IS NOT NULL").select(F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("idx"))
    return frames.select("idx", F.explode(F.array(*[F.lit(int(f)) for f in frequencies])).alias("frequency"))


def completeness(classified: DataFrame, frequencies: list[int]) -> DataFrame:
    """(idx, n_items, n_missing) of every frame, wholly empty ones included."""
    all_ = grid(classified, frequencies).join(items(classified), ["idx", "frequency"], "left")
    return all_.groupBy("idx").agg(F.count("payload").alias("n_items"), F.count_if(F.col("payload").isNull()).alias("n_missing"))


def fill_lost(classified: DataFrame, frequencies: list[int], channels_per_item: int, lost_flags: int, wanted: tuple[int, int] | None = None) -> DataFrame:
    """(idx, channel, value, flags) over frames that have an item: channels of lost items get value 0, and ``lost_flags`` in the place of their mask.

    With ``wanted``, a half-open range of channels that need not begin or end with an item, only the parts of items in it are
    spread, and channels count from its start.
    """
    there = items(classified)
    start, stop = wanted or (min(frequencies, default=0), max(frequencies, default=0) + channels_per_item)
    inside = [f for f in frequencies if f < stop and f + channels_per_item > start]
    all_ = grid(classified, inside).join(there.select("idx").distinct(), "idx", "left_semi").join(there, ["idx", "frequency"], "left")
    first, last = F.greatest("frequency", F.lit(start)), F.least(F.col("frequency") + channels_per_item, F.lit(stop)) - 1
    channel = F.explode(F.sequence(first, last)).alias("channel")
    out = all_.select("idx", channel, F.coalesce("payload", F.lit(0)).alias("value"), F.when(F.col("payload").isNull(), lost_flags).otherwise(0).alias("flags"))
    return out.withColumn("channel", F.col("channel") - start) if wanted else out


def totals(classified: DataFrame, stopped_at: int | None = None) -> DataFrame:
    """Records and payload by reason. After ``stopped_at``, when the session was told to stop, incomplete ones are expected and not counted."""
    if stopped_at is not None:
        classified = classified.where((F.col("reason") != "incomplete") | (F.col("arrival_seq") <= stopped_at))
    return classified.groupBy("reason").agg(F.count("*").alias("n"), F.sum(F.coalesce("payload", F.lit(0))).alias("payload"))
