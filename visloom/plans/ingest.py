"""The composite plan: raw samples in, spectral, continuum and quick-look products out, at two cadences.

Samples are exchanged once, by (step, baseline), where a step is as many dumps as both cadences are multiples of. The detector's
windows and the partial sums of a step need no other exchange. All products are rolled up from those sums, which a caller
that wants several has written once (``base`` of ``build``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial
from math import gcd

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import CAM, DATA_LOST
from ..operators import average, baselines, quicklook, rfi, samples


@dataclass(frozen=True)
class IngestPlan:
    """Parameters of a session. ``detector`` is any function from (samples with ``amp`` and ``flags``, keys of a spectrum) to the same with ``rfi``; none skips detection."""

    n_accs: int
    n_channels: int
    start: int
    stop: int
    ratio: int
    sd_ratio: int
    cont_factor: int
    sd_cont_factor: int
    n_masks: int
    excise: bool = True
    guard: int = 0
    detector: Callable[[DataFrame, list[str]], DataFrame] | None = partial(rfi.detect, flags="flags")

    def __post_init__(self) -> None:
        for factor in (self.cont_factor, self.sd_cont_factor):
            if (self.stop - self.start) % factor or self.start % factor:
                raise ValueError("kept channels are not a multiple of the continuum factors")
        if not 0 <= self.start < self.stop <= self.n_channels:
            raise ValueError("kept channels exceed the band")

    @property
    def step(self) -> int:
        """Dumps of a step."""
        return gcd(self.ratio, self.sd_ratio)

    def samples(self, raw: DataFrame, permutation: DataFrame, baseline_table: DataFrame, masks: DataFrame, baseline_flags: DataFrame | None = None, channel_flags: DataFrame | None = None) -> DataFrame:
        """Flagged samples of the kept channels, with their ``step``. The wide channel filter precedes the detector's windows, the narrow one follows them.

        ``channel_flags`` (dump, channel), of live masks and suspect channels, are there before detection; ``baseline_flags``
        (dump, bl), of suspect antennas and inputs, are merged with the detector's.
        """
        df = samples.channels_between(raw, self.start - self.guard, self.stop + self.guard)
        df = samples.flag(samples.reorder(samples.prepare(df), permutation), baseline_table, masks, self.n_masks, CAM, DATA_LOST)
        if channel_flags is not None:
            df = samples.add_channel_flags(df, channel_flags)
        df = df.withColumn("step", average.group_index("dump", self.step))
        if self.detector is not None:
            df = df.repartition("step", "bl")
            df = self.detector(df.withColumn("amp", samples.amplitude()), ["step", "dump", "bl"])
        else:
            df = df.withColumn("rfi", F.lit(0))
        if baseline_flags is not None:
            df = samples.merge_flags(df, "rfi", baseline_flags)
        else:
            df = df.withColumn("flags", F.col("flags").bitwiseOR(F.col("rfi")))
        return samples.channels_between(df, self.start, self.stop).select("step", "dump", "channel", "bl", "re", "im", "flags")

    def fine_sums(self, flagged: DataFrame) -> DataFrame:
        """Partial sums and packed flag counts by (step, channel, bl)."""
        return average.partials(flagged, ["step", "channel", "bl"], quicklook.packed_counts())

    def sums(self, fine: DataFrame, ratio: int) -> DataFrame:
        """Partial sums by (out_idx, channel, bl), from which all averages of a cadence are finished. Steps of its own length are its sums."""
        if ratio == self.step:
            return fine.withColumnRenamed("step", "out_idx")
        return average.roll_up(fine, [average.group_index("step", ratio // self.step).alias("out_idx"), "channel", "bl"])

    def spectral(self, sums: DataFrame) -> DataFrame:
        return average.compress_weights(average.finalise(sums, ["out_idx", "channel", "bl"], self.n_accs, self.excise))

    def continuum(self, sums: DataFrame, factor: int) -> DataFrame:
        """From the un-normalised sums of the spectral product, as sums add up and flags OR together."""
        keys = ["out_idx", "cont_channel", "bl"]
        rolled = average.roll_up(sums, ["out_idx", average.group_index("channel", factor).cast("int").alias("cont_channel"), "bl"])
        return average.compress_weights(average.finalise(rolled, keys, self.n_accs, self.excise), "cont_channel")

    def build(
        self,
        raw: DataFrame,
        permutation: DataFrame,
        baseline_table: DataFrame,
        masks: DataFrame,
        baseline_flags: DataFrame | None = None,
        channel_flags: DataFrame | None = None,
        series_mask: list[float] | None = None,
        base: Callable[[DataFrame], DataFrame] | None = None,
    ) -> dict[str, DataFrame]:
        """All products by name. ``base`` is given the partial sums and returns them as the products shall read them, such as ``session.written``, which writes them once."""
        flagged = self.samples(raw, permutation, baseline_table, masks, baseline_flags, channel_flags)
        fine = self.fine_sums(flagged)
        if base is not None:
            fine = base(fine)
        sums, sd_sums = self.sums(fine, self.ratio), self.sums(fine, self.sd_ratio)
        sd = average.finalise(sd_sums, ["out_idx", "channel", "bl"], self.n_accs, self.excise)
        counts = quicklook.roll_up_counts(fine, [average.group_index("step", self.sd_ratio // self.step).alias("out_idx"), "bl"])
        weights = quicklook.series_weights(raw.sparkSession, series_mask, self.n_channels, self.start, self.stop)
        return {
            "samples": flagged.drop("step"),
            "spectral": self.spectral(sums),
            "continuum": self.continuum(sums, self.cont_factor),
            "sd_spectral": sd,
            "sd_continuum": self.continuum(sd_sums, self.sd_cont_factor),
            "sd_time_series": quicklook.time_series(sd, weights),
            "sd_percentiles": quicklook.percentiles(sd, baselines.groups(baseline_table), list(baselines.GROUPS)),
            "sd_flag_counts": counts,
            "sd_flag_fractions": quicklook.flag_fractions(counts, ["out_idx", "bl"], self.sd_ratio, self.stop - self.start),
        }
