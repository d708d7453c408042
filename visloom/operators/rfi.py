"""Interference detection: running median over channels, robust noise, thresholds.

The windows of one spectrum share a single exchange and sort by (spectrum, channel). ``selected_noise`` needs no window over a spectrum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import INGEST_RFI, MAD_TO_SIGMA, RFI_SIGMAS, RFI_WIDTH


def background(df: DataFrame, keys: list[str], width: int = RFI_WIDTH, flags: str | None = None, amp: str = "amp") -> DataFrame:
    """Median of the channels around each, fewer at the edges; flagged samples are left out if ``flags`` names a column.

    The neighbours come as offsets within one sorted window and the middle of the sorted few is taken, with no aggregate a row.
    """
    half = width // 2
    along = Window.partitionBy(*keys).orderBy("channel")
    value = F.col(amp) if flags is None else F.when(F.col(flags) == 0, F.col(amp))
    near = [F.lag(value, -k).over(along) if k else value for k in range(-half, half + 1)]
    ordered = F.sort_array(F.array_compact(F.array(*near)))
    n = F.size("_near")
    middle = (F.get("_near", F.floor((n - 1) / 2).cast("int")) + F.get("_near", F.floor(n / 2).cast("int"))) / 2
    return df.withColumn("_near", ordered).withColumn("background", middle).drop("_near")


def deviation(df: DataFrame, amp: str = "amp") -> DataFrame:
    return df.withColumn("dev", F.col(amp) - F.col("background"))


def noise(df: DataFrame, keys: list[str], flags: str | None = None) -> DataFrame:
    """Scaled median of the absolute deviations that are not zero."""
    counts = (F.col("dev") != 0) if flags is None else (F.col("dev") != 0) & (F.col(flags) == 0)
    value = F.when(counts, F.abs("dev"))
    return df.withColumn("noise", MAD_TO_SIGMA * F.percentile(value, 0.5).over(Window.partitionBy(*keys)))


#: Buckets of the selection: to a factor of e at first, then to what one bucket spans.
LOG_BUCKETS, LINEAR_BUCKETS = 64, 4096


def medians(values: DataFrame, keys: list[str], value: str, name: str, rounds: int = 1) -> DataFrame:
    """(keys, name): exact medians of non-negative numbers by selection; keys without a value have none. Nulls are no values.

    The values of each key are counted by buckets of their logarithm, the bucket in which the wanted rank lies is found,
    and only its values go on: ``rounds`` times by equal parts of what the bucket spans, at last one by one. Counts combine map-side,
    and windows hold the buckets of a key or the distinct values of its last bucket, however many values it has.
    An even number of values has two middle ranks, sought side by side.
    """
    rows = values.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    rows = rows.withColumn("_b", F.when(F.col("_v") > 0, F.floor(F.log("_v") * LOG_BUCKETS)).otherwise(-(1 << 40)).cast("double"))
    n = F.col("_n")
    ranks = F.array(*[F.struct(F.lit(k).alias("_side"), F.floor(x / 2).alias("_rank")) for k, x in enumerate((n - 1, n))])
    wanted = rows.groupBy(*keys).agg(F.count("*").alias("_n")).select(*keys, F.inline(ranks))
    by = list(keys)
    for last in [False] * (1 + rounds) + [True]:
        counts = rows.groupBy(*by, "_b").agg(F.count("*").alias("_c"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
        reached = wanted.join(counts, by).withColumn("_upto", F.sum("_c").over(Window.partitionBy(*keys, "_side").orderBy("_b")))
        here = reached.where((F.col("_upto") > F.col("_rank")) & (F.col("_upto") - F.col("_c") <= F.col("_rank")))
        if last:
            return here.groupBy(*keys).agg((F.sum("_low") / 2).alias(name))
        here = here.withColumn("_rank", F.col("_rank") - (F.col("_upto") - F.col("_c")))
        wanted = here.select(*keys, "_side", "_rank")
        inside = rows.join(here.select(*keys, "_side", "_b", "_low", "_high"), [*by, "_b"])
        if rounds > 0:
            part = F.floor((F.col("_v") - F.col("_low")) / (F.col("_high") - F.col("_low")) * LINEAR_BUCKETS).cast("double")
            rows = inside.select(*keys, "_side", "_v", F.when(F.col("_high") > F.col("_low"), part).otherwise(0.0).alias("_b"))
        else:
            rows = inside.select(*keys, "_side", "_v", F.col("_v").alias("_b"))
        rounds -= 1
        by = [*keys, "_side"]


def selected_noise(df: DataFrame, keys: list[str], flags: str | None = None) -> DataFrame:
    """(keys, noise) as ``noise`` has it, one row a spectrum, for spectra of any length."""
    counts = (F.col("dev") != 0) if flags is None else (F.col("dev") != 0) & (F.col(flags) == 0)
    found = medians(df.select(*keys, F.when(counts, F.abs("dev")).alias("_dev")), keys, "_dev", "_median")
    return found.select(*keys, (MAD_TO_SIGMA * F.col("_median")).alias("noise"))


def threshold(df: DataFrame, n_sigma: float = RFI_SIGMAS) -> DataFrame:
    """INGEST_RFI where the deviation exceeds ``n_sigma`` times the noise. Spectra without noise have none."""
    return df.withColumn("rfi", F.when(F.col("dev") > n_sigma * F.col("noise"), INGEST_RFI).otherwise(0))


def threshold_sum(df: DataFrame, keys: list[str], n_sigma: float = RFI_SIGMAS, widths: tuple[int, ...] = (1, 2, 4, 8), falloff: float = 1.2) -> DataFrame:
    """As ``threshold``, also for runs of channels whose mean deviation exceeds a limit that falls with the run's length."""
    by = Window.partitionBy(*keys).orderBy("channel")
    hit = F.lit(False)
    for k, width in enumerate(widths):
        mean = f"_mean{width}"
        df = df.withColumn(mean, F.when(F.count("dev").over(by.rowsBetween(0, width - 1)) == width, F.avg("dev").over(by.rowsBetween(0, width - 1))))
        over = F.col(mean) > n_sigma / falloff**k * F.col("noise")
        df = df.withColumn(mean, F.max(F.when(over, 1).otherwise(0)).over(by.rowsBetween(1 - width, 0)))
        hit = hit | (F.col(mean) == 1)
    return df.withColumn("rfi", F.when(hit, INGEST_RFI).otherwise(0)).drop(*[f"_mean{w}" for w in widths])


def detect(df: DataFrame, keys: list[str], width: int = RFI_WIDTH, n_sigma: float = RFI_SIGMAS, flags: str | None = None) -> DataFrame:
    return threshold(noise(deviation(background(df, keys, width, flags)), keys, flags), n_sigma)


def detect_guarded(df: DataFrame, keys: list[str], start: int, stop: int, guard: int, **options) -> DataFrame:
    """Detection over [start, stop) with the context of ``guard`` channels on either side. The wide filter reaches the scan; the narrow one must wait for the windows."""
    wide = df.where((F.col("channel") >= start - guard) & (F.col("channel") < stop + guard))
    return detect(wide, keys, **options).where((F.col("channel") >= start) & (F.col("channel") < stop))
