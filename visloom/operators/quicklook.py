"""Quick-look products: flag counts and fractions, weighted time series, percentile spectra."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import COUNT_MASK
from .samples import amplitude


def bit_counts(mask: int = COUNT_MASK) -> list[Column]:
    """Aggregates: samples of each bit of ``flags`` (c0 to c7) and of any bit."""
    flags = F.col("flags").bitwiseAND(mask)
    return [*[F.count_if(flags.bitwiseAND(1 << b) != 0).alias(f"c{b}") for b in range(8)], F.count_if(flags != 0).alias("any_count")]


def flag_counts(samples: DataFrame, start: int, stop: int, keys: list[Column | str], mask: int = COUNT_MASK) -> DataFrame:
    """Samples of each bit (c0 to c7) and of any bit, over channels [start, stop), before averaging."""
    return samples.where((F.col("channel") >= start) & (F.col("channel") < stop)).groupBy(*keys).agg(*bit_counts(mask))


#: Counts of one cell share a few sums, FIELD bits each; a cell of a step has far fewer samples.
FIELD, FIELDS = 21, 3
COUNTED = (*[f"c{b}" for b in range(8)], "any_count")


def packed_counts(mask: int = COUNT_MASK) -> list[Column]:
    """The same aggregates for cells of up to 2**FIELD - 1 samples, as three sums (p0 to p2) in place of nine."""
    flags = F.col("flags").bitwiseAND(mask).cast("long")
    ones = [*[F.shiftright(flags, b).bitwiseAND(F.lit(1).cast("long")) for b in range(8)], F.when(flags != 0, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))]
    at = lambda k: [F.shiftleft(one, FIELD * (j % FIELDS)) for j, one in enumerate(ones) if j // FIELDS == k]
    return [F.sum(sum(more, first)).alias(f"p{k}") for k in range(3) for first, *more in [at(k)]]


def roll_up_counts(packed: DataFrame, keys: list[Column | str]) -> DataFrame:
    """c0 to c7 and any_count of coarser cells, from packed sums."""
    field = lambda j: F.shiftrightunsigned(f"p{j // FIELDS}", FIELD * (j % FIELDS)).bitwiseAND(F.lit((1 << FIELD) - 1))
    return packed.groupBy(*keys).agg(*[F.sum(field(j)).alias(c) for j, c in enumerate(COUNTED)])


def flag_fractions(counts: DataFrame, keys: list[str], ratio: int, n_channels: int) -> DataFrame:
    """Counts over the nominal number of samples, whether or not all arrived."""
    return counts.select(*keys, *[(F.col(f"c{b}") / float(ratio * n_channels)).alias(f"f{b}") for b in range(8)])


def default_weights(spark, n_channels: int, start: int, stop: int) -> DataFrame:
    """(channel, ts_weight): equal shares of all channels, none outside [start, stop)."""
    return spark.range(n_channels).select(F.col("id").cast("int").alias("channel"), F.when((F.col("id") >= start) & (F.col("id") < stop), 1.0 / n_channels).otherwise(0.0).alias("ts_weight"))


def series_weights(spark, mask: list[float] | None, n_channels: int, start: int, stop: int) -> DataFrame:
    """(channel, ts_weight): the user's mask, or the default one if there is none or it has another number of channels; none outside [start, stop)."""
    if mask is None or len(mask) != n_channels:
        return default_weights(spark, n_channels, start, stop)
    rows = [(c, float(w) if start <= c < stop else 0.0) for c, w in enumerate(mask)]
    return spark.createDataFrame(rows, "channel int, ts_weight double")


def time_series(averaged: DataFrame, weights: DataFrame) -> DataFrame:
    """Weighted sums over channels of each baseline's values and of their amplitudes."""
    joined = averaged.join(F.broadcast(weights), "channel")
    w = F.col("ts_weight")
    return joined.groupBy("out_idx", "bl").agg(F.sum(w * F.col("re")).alias("re"), F.sum(w * F.col("im")).alias("im"), F.sum(w * amplitude()).alias("abs"))


def percentiles(averaged: DataFrame, groups: DataFrame, all_groups: list[str]) -> DataFrame:
    """[min, max, 25 %, 75 %, median] of amplitudes over each group's baselines, each an observed value (rank floor(p * (n - 1))), and the OR of flags. An empty group gives NaN and no flags."""
    amp = averaged.withColumn("amp", amplitude()).join(F.broadcast(groups), "bl")
    found = amp.groupBy("out_idx", "channel", "grp").agg(F.sort_array(F.collect_list("amp")).alias("a"), F.bit_or("flags").alias("flags"))
    cells = averaged.select("out_idx", "channel").distinct().select("*", F.explode(F.array(*map(F.lit, all_groups))).alias("grp"))
    n = F.size("a")
    at = lambda p: F.coalesce(F.get("a", F.floor(F.lit(p) * (n - 1)).cast("int")), F.lit(float("nan")))
    out = cells.join(found, ["out_idx", "channel", "grp"], "left")
    return out.select("out_idx", "channel", "grp", at(0.0).alias("p_min"), at(1.0).alias("p_max"), at(0.25).alias("p_25"), at(0.75).alias("p_75"), at(0.5).alias("p_50"), F.coalesce("flags", F.lit(0)).alias("flags"))


def custom_signals(averaged: DataFrame, wanted: DataFrame, previous: DataFrame, n_bl: int) -> DataFrame:
    """Rows of the chosen baselines; if any choice is out of range, of the previous ones."""
    bad = wanted.agg(F.coalesce(F.bool_or((F.col("bl") < 0) | (F.col("bl") >= n_bl)), F.lit(False)).alias("bad"))
    chosen = wanted.select("bl", F.lit(False).alias("old")).union(previous.select("bl", F.lit(True).alias("old")))
    chosen = chosen.join(F.broadcast(bad)).where("old = bad").select("bl").distinct()
    return averaged.join(F.broadcast(chosen), "bl", "left_semi")
