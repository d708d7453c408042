"""From raw records to flagged samples: scaling, missing markers, reordering, masks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import CAM, DATA_LOST, INT32_MIN


def prepare(raw: DataFrame) -> DataFrame:
    """Turn missing markers into a ``missing`` column and zeros. Values stay integers; scaling by the number of accumulations comes with the last projection, so that sums are exact."""
    missing = F.col("re") == INT32_MIN
    return raw.withColumns({"missing": missing, "re": F.when(missing, 0).otherwise(F.col("re")), "im": F.when(missing, 0).otherwise(F.col("im"))})


def scaled(df: DataFrame, n_accs: int) -> DataFrame:
    return df.withColumns({"re": F.col("re") / float(n_accs), "im": F.col("im") / float(n_accs)})


def reorder(df: DataFrame, permutation: DataFrame) -> DataFrame:
    """Give samples their output baseline; those without one go. The permutation has a row a baseline, a few thousand at most, and is broadcast."""
    return df.join(F.broadcast(permutation), "cbf_bl").drop("cbf_bl")


def flag(df: DataFrame, baselines: DataFrame, channel_masks: DataFrame, n_masks: int, zero_flag: int = CAM, missing_flag: int = DATA_LOST) -> DataFrame:
    """Flags of each sample: its mask's, ``zero_flag`` for zeros and ``missing_flag`` for missing data. Mask numbers beyond the last mean the last.

    Baselines to masks and masks to channels are two small dimensions; their product is never made.
    """
    zero = F.when((F.col("re") == 0) & (F.col("im") == 0), zero_flag).otherwise(0)
    lost = F.when(F.col("missing"), missing_flag).otherwise(0)
    out = masked(df, baselines, channel_masks, n_masks)
    return out.withColumn("flags", F.coalesce("mask_flags", F.lit(0)).bitwiseOR(zero).bitwiseOR(lost)).drop("mask_flags")


def masked(df: DataFrame, baselines: DataFrame, channel_masks: DataFrame, n_masks: int) -> DataFrame:
    """``mask_flags`` of each (bl, channel), null where its mask has none."""
    its = baselines.select("bl", F.least("mask_id", F.lit(n_masks - 1)).alias("mask_id"))
    return df.join(F.broadcast(its), "bl", "left").join(F.broadcast(channel_masks), ["mask_id", "channel"], "left").drop("mask_id")


def add_channel_flags(df: DataFrame, channel_flags: DataFrame) -> DataFrame:
    """OR flags by (dump, channel) into ``flags``."""
    joined = df.join(channel_flags, ["dump", "channel"], "left")
    return joined.withColumn("flags", F.col("flags").bitwiseOR(F.coalesce("channel_flags", F.lit(0)))).drop("channel_flags")


def merge_flags(df: DataFrame, rfi: str, baseline_flags: DataFrame) -> DataFrame:
    """OR a column of detector flags and per (dump, bl) flags into ``flags``."""
    joined = df.join(baseline_flags, ["dump", "bl"], "left")
    return joined.withColumn("flags", F.col("flags").bitwiseOR(F.coalesce(rfi, F.lit(0))).bitwiseOR(F.coalesce("baseline_flags", F.lit(0)))).drop("baseline_flags")


def channels_between(df: DataFrame, start: int, stop: int) -> DataFrame:
    return df.where((F.col("channel") >= start) & (F.col("channel") < stop))


def amplitude(re="re", im="im"):
    """As doubles: squares of 32-bit values overflow."""
    x, y = F.col(re).cast("double"), F.col(im).cast("double")
    return F.sqrt(x * x + y * y)
