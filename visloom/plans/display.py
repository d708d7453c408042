"""The quick-look group: all items that a display of one session's second cadence shows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import cadence, quicklook
from .ingest import IngestPlan

#: The items of the group. The first ten have values by frame, the others hold for a session.
ITEMS = (
    "sd_data", "sd_data_index", "sd_flags", "sd_blmxdata", "sd_blmxflags", "sd_timeseries", "sd_timeseriesabs", "sd_percspectrum", "sd_percspectrumflags", "sd_timestamp", "sd_flag_fraction",
    "bls_ordering", "bandwidth", "center_freq", "n_chans", "sd_blmx_n_chans", "frequency",
)


def subband(n_channels: int, centre: float, bandwidth: float, start: int, stop: int) -> tuple[float, float]:
    """Centre and bandwidth of some of a band's channels. A band's centre is that of the channel in the middle, of two the upper."""
    width = bandwidth / n_channels
    return centre + (start + (stop - start) // 2 - n_channels // 2) * width, width * (stop - start)


def session_items(plan: IngestPlan, labels: list[tuple[str, str]], centre: float, bandwidth: float, shown: tuple[int, int] | None = None) -> dict[str, Column]:
    """Items that hold for a session. ``shown``: the channels of all servers' displays, of which the plan's are a part."""
    start, stop = shown or (plan.start, plan.stop)
    mid, wide = subband(plan.n_channels, centre, bandwidth, start, stop)
    return {
        "bls_ordering": F.array(*[F.array(F.lit(a), F.lit(b)) for a, b in labels]),
        "bandwidth": F.lit(wide),
        "center_freq": F.lit(mid),
        "n_chans": F.lit(stop - start),
        "sd_blmx_n_chans": F.lit((stop - start) // plan.sd_cont_factor),
        "frequency": F.lit(plan.start - start),
    }


def display(plan: IngestPlan, made: dict[str, DataFrame], signals: DataFrame, previous: DataFrame, labels: list[tuple[str, str]], centre: float, bandwidth: float, interval: int, base: int, scale: float, shown: tuple[int, int] | None = None) -> dict[str, DataFrame]:
    """Every item as a table by ``out_idx`` (and channel, baseline or group where it has them), from the products of ``IngestPlan.build``.

    ``signals`` (bl) are the baselines whose spectra are shown; choices out of range leave the ``previous`` ones.
    """
    chosen = quicklook.custom_signals(made["sd_spectral"], signals, previous, len(labels))
    matrix, series, spectra = made["sd_continuum"], made["sd_time_series"], made["sd_percentiles"]
    frames = made["sd_flag_counts"].select("out_idx").distinct()
    at = cadence.mid_timestamp(F.col("out_idx"), plan.sd_ratio, interval, F.lit(base), scale)
    held = session_items(plan, labels, centre, bandwidth, shown)
    out = {
        "sd_data": chosen.select("out_idx", "channel", "bl", "re", "im"),
        "sd_data_index": chosen.select("out_idx", "bl").distinct(),
        "sd_flags": chosen.select("out_idx", "channel", "bl", "flags"),
        "sd_blmxdata": matrix.select("out_idx", "cont_channel", "bl", "re", "im"),
        "sd_blmxflags": matrix.select("out_idx", "cont_channel", "bl", "flags"),
        "sd_timeseries": series.select("out_idx", "bl", "re", "im"),
        "sd_timeseriesabs": series.select("out_idx", "bl", "abs"),
        "sd_percspectrum": spectra.drop("flags"),
        "sd_percspectrumflags": spectra.select("out_idx", "channel", "grp", "flags"),
        "sd_timestamp": frames.select("out_idx", cadence.centiseconds(at).alias("centiseconds")),
        "sd_flag_fraction": made["sd_flag_fractions"],
    }
    return out | {name: frames.select("out_idx", value.alias(name)) for name, value in held.items()}
