"""Flag-aware weighted averages over time and channels.

All forms come from one set of additive partial sums over integers, so that any roll-up (dumps to an
output dump, channels to a continuum channel) is exact, and combines map-side. Excision is not a filter:
if a cell has unflagged samples, only those count and its flags are clear; if all are flagged, their mean is
given with their flags.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import MIN_CHANNEL_WEIGHT

SUMS = ("n_u", "re_u", "im_u", "n_f", "re_f", "im_f")


def partials(samples: DataFrame, keys: list[Column | str], more: list[Column] | tuple = ()) -> DataFrame:
    """Sums over unflagged (u) and flagged (f) samples, the OR of the flags, and ``more`` aggregates, by ``keys``."""
    clear = F.col("flags") == 0
    take = lambda keep, c: F.sum(F.when(keep, F.col(c).cast("long")).otherwise(F.lit(0).cast("long")))
    return samples.groupBy(*keys).agg(
        F.count_if(clear).alias("n_u"), take(clear, "re").alias("re_u"), take(clear, "im").alias("im_u"),
        F.count_if(~clear).alias("n_f"), take(~clear, "re").alias("re_f"), take(~clear, "im").alias("im_f"),
        F.bit_or("flags").alias("any_flags"), *more,
    )


def roll_up(sums: DataFrame, keys: list[Column | str]) -> DataFrame:
    """Partial sums of coarser cells."""
    return sums.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in SUMS], F.bit_or("any_flags").alias("any_flags"))


def finalise(sums: DataFrame, keys: list[str], n_accs: int, excise: bool = True, flush_below: float | None = None) -> DataFrame:
    """re, im, weight and flags of each cell. A sample weighs ``n_accs``. Exact sums leave no residue of flagged samples; for sums of
    other origin, ``flush_below`` sets smaller parts of unflagged cells to zero (when excising)."""
    if excise:
        some = F.col("n_u") > 0
        n, re, im = (F.when(some, F.col(f"{c}_u")).otherwise(F.col(f"{c}_f")) for c in ("n", "re", "im"))
        flags = F.when(some, 0).otherwise(F.col("any_flags"))
    else:
        n, re, im = (F.col(f"{c}_u") + F.col(f"{c}_f") for c in ("n", "re", "im"))
        flags = F.col("any_flags")
    weight = (n * n_accs).cast("double")
    mean = [F.try_divide(x, weight) for x in (re, im)]
    if excise and flush_below is not None:
        mean = [F.when((F.col("n_u") > 0) & (F.abs(x) < flush_below), 0.0).otherwise(x) for x in mean]
    return sums.select(*keys, mean[0].alias("re"), mean[1].alias("im"), weight.alias("weight"), flags.alias("flags"))


def group_index(index: Column | str, ratio: int) -> Column:
    """Number of the averaging group of a non-negative dump index or channel."""
    return F.floor((F.col(index) if isinstance(index, str) else index) / ratio).cast("long")


def spectral(samples: DataFrame, ratio: int, n_accs: int, excise: bool = True) -> DataFrame:
    sums = partials(samples, [group_index("dump", ratio).alias("out_idx"), "channel", "bl"])
    return finalise(sums, ["out_idx", "channel", "bl"], n_accs, excise)


def continuum(samples: DataFrame, ratio: int, factor: int, n_accs: int, excise: bool = True) -> DataFrame:
    cell = group_index("channel", factor).cast("int").alias("cont_channel")
    sums = partials(samples, [group_index("dump", ratio).alias("out_idx"), cell, "bl"])
    return finalise(sums, ["out_idx", "cont_channel", "bl"], n_accs, excise)


def compress_weights(averaged: DataFrame, channel: str = "channel") -> DataFrame:
    """Weights as one number a channel, and a byte a baseline that scales it. A window holds one channel of one output dump, so a row a baseline."""
    top = F.max("weight").over(Window.partitionBy("out_idx", channel))
    out = averaged.withColumn("weight_channel", F.greatest(top, F.lit(MIN_CHANNEL_WEIGHT)) / 255.0)
    return out.withColumn("weight_u8", F.floor(F.col("weight") / F.col("weight_channel") + 0.5).cast("smallint"))
