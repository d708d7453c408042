"""Registered queries over the supplied tables, and their DuckDB SQL."""

from __future__ import annotations

import json
from dataclasses import replace
from functools import partial

from pyspark.sql import Observation
from pyspark.sql import functions as F

from ..constants import CAM, COUNT_MASK, DATA_LOST, MAD_TO_SIGMA, STATIC
from ..functions import ranges
from ..operators import average, baselines, cadence, frames, metadata, quicklook, rfi, samples, sensors
from ..session import fresh_folder, table, written
from ..sources import adapters as A
from ..streaming import commit
from ..streaming import queries as streams
from . import display
from .ingest import IngestPlan

QUERIES: dict = {}
SQL: dict[str, str] = {}

SD_START, SD_STOP, SD_RATIO = 8, 24, 8
BASE_TS, INTERVAL, SCALE = 1000, 512, 1024.0
HEAP_INTERVAL, ACTIVE, PER_ITEM, WANTED = 2, 3, 8, (0, 24)
FREQUENCIES = list(range(WANTED[0], WANTED[1], PER_ITEM))
CENTRE, BANDWIDTH = 1284.0, 856.0
SIGMAS = 4.0


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


# --- shared SQL -------------------------------------------------------------------------------------

_values = lambda rows: ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)
K = "CAST(json_extract_string(props, '$.k') AS INT)"
CUBE = f"""
raw AS (
  SELECT CAST(event_id // 256 AS BIGINT) AS dump, CAST((event_id // 8) % {A.N_CHANNELS} AS INT) AS channel, CAST(event_id % 8 AS INT) AS cbf_bl,
    event_type = 'error' AND {K} % 4 = 0 AS missing, event_type = 'view' AND {K} % 10 = 0 AS zero, CAST(floor(value * 100 + 0.5) AS INT) AS v, {K} - 50 AS w FROM events),
perm(cbf_bl, bl) AS (VALUES {_values([(k, b) for k, b in enumerate(A.PERMUTATION) if b >= 0])}),
base(bl, input1, input2, mask_id) AS (VALUES {_values([(k, a, b, A.MASK_OF[k]) for k, (a, b) in enumerate(A.LABELS)])}),
masks(mask_id, channel, mask_flags) AS (VALUES {_values([(m, c, STATIC) for m, cs in enumerate(A.MASKS) for c in cs])}),
prepared AS (SELECT dump, channel, cbf_bl, missing, CASE WHEN missing OR zero THEN 0 ELSE v END AS re, CASE WHEN missing OR zero THEN 0 ELSE w END AS im FROM raw),
reordered AS (SELECT dump, channel, p.bl, missing, re, im FROM prepared JOIN perm p USING (cbf_bl)),
sample AS (
  SELECT r.*, coalesce(m.mask_flags, 0) | (CASE WHEN re = 0 AND im = 0 THEN {CAM} ELSE 0 END) | (CASE WHEN missing THEN {DATA_LOST} ELSE 0 END) AS flags
  FROM reordered r JOIN base b ON r.bl = b.bl LEFT JOIN masks m ON m.mask_id = least(b.mask_id, {len(A.MASKS) - 1}) AND m.channel = r.channel)"""


def sums_sql(source: str, keys: str, ratio: int) -> str:
    """Partial sums by out_idx and more keys, as expressions with names."""
    return f"""
SELECT CAST(dump // {ratio} AS BIGINT) AS out_idx, {keys}, count(*) FILTER (flags = 0) AS n_u, count(*) FILTER (flags <> 0) AS n_f,
  coalesce(sum(re) FILTER (flags = 0), 0) AS re_u, coalesce(sum(im) FILTER (flags = 0), 0) AS im_u,
  coalesce(sum(re) FILTER (flags <> 0), 0) AS re_f, coalesce(sum(im) FILTER (flags <> 0), 0) AS im_f, bit_or(flags) AS any_flags
FROM {source} GROUP BY ALL"""


def final_sql(source: str, keys: str, excise: bool = True, n_accs: int = A.N_ACCS) -> str:
    if excise:
        n, re, im = (f"(CASE WHEN n_u > 0 THEN {c}_u ELSE {c}_f END)" for c in ("n", "re", "im"))
        flags = "CAST(CASE WHEN n_u > 0 THEN 0 ELSE any_flags END AS INT)"
    else:
        n, re, im = (f"({c}_u + {c}_f)" for c in ("n", "re", "im"))
        flags = "CAST(any_flags AS INT)"
    w = f"CAST({n} * {n_accs} AS DOUBLE)"
    return f"SELECT {keys}, CAST({re} AS DOUBLE) / {w} AS re, CAST({im} AS DOUBLE) / {w} AS im, {w} AS weight, {flags} AS flags FROM {source}"


SPEC_KEYS = "out_idx, channel, bl"
SPEC = f"sums AS ({sums_sql('sample', 'channel, bl', A.RATIO)}), spec AS ({final_sql('sums', SPEC_KEYS)})"
SD = f"sums AS ({sums_sql('sample', 'channel, bl', SD_RATIO)}), spec AS ({final_sql('sums', SPEC_KEYS)})"


def packed_sql(source: str, keys: str, channel: str) -> str:
    return f"""SELECT *, CAST(floor(weight / weight_channel + 0.5) AS SMALLINT) AS weight_u8 FROM (
  SELECT {keys}, re, im, weight, flags, greatest(max(weight) OVER (PARTITION BY out_idx, {channel}), {2.0**-96!r}) / 255.0 AS weight_channel FROM {source})"""


def _raw(spark, d):
    return A.cube(table(spark, d, "events"))


def _reordered(spark, d):
    return samples.reorder(samples.prepare(_raw(spark, d)), A.permutation(spark))


def _samples(spark, d):
    return samples.flag(_reordered(spark, d), A.baselines(spark), A.channel_masks(spark), len(A.MASKS))


def _sd(spark, d):
    return average.spectral(_samples(spark, d), SD_RATIO, A.N_ACCS)


# --- samples ----------------------------------------------------------------------------------------


@query(f"WITH {CUBE} SELECT dump, channel, cbf_bl, re / {A.N_ACCS}.0::DOUBLE AS re, im / {A.N_ACCS}.0::DOUBLE AS im, missing FROM prepared")
def prepared_samples(spark, d):
    return samples.scaled(samples.prepare(_raw(spark, d)), A.N_ACCS)


@query(f"WITH {CUBE} SELECT dump, channel, bl, re, im, missing FROM reordered")
def baseline_reorder(spark, d):
    return _reordered(spark, d).select("dump", "channel", "bl", "re", "im", "missing")


@query(f"WITH {CUBE} SELECT dump, channel, bl, CAST(flags AS INT) AS flags FROM sample")
def channel_mask_lookup(spark, d):
    return _samples(spark, d).select("dump", "channel", "bl", "flags")


@query(f"""WITH {CUBE}, suspect AS (SELECT DISTINCT dump, bl, CASE WHEN (dump + bl) % 5 = 0 THEN {CAM} ELSE 0 END AS f FROM sample)
SELECT dump, channel, bl, CAST(flags | (CASE WHEN re > 15000 THEN 16 ELSE 0 END) | f AS INT) AS flags FROM sample JOIN suspect USING (dump, bl)""")
def merge_flags(spark, d):
    df = _samples(spark, d).withColumn("rfi", F.when(F.col("re") > 15000, 16).otherwise(0))
    suspect = df.select("dump", "bl", F.when((F.col("dump") + F.col("bl")) % 5 == 0, CAM).otherwise(0).alias("baseline_flags")).distinct()
    return samples.merge_flags(df, "rfi", suspect).select("dump", "channel", "bl", "flags")


# --- averages ---------------------------------------------------------------------------------------


@query(f"WITH {CUBE}, {SPEC} SELECT * FROM spec")
def excised_average(spark, d):
    return average.spectral(_samples(spark, d), A.RATIO, A.N_ACCS)


@query(f"WITH {CUBE}, sums AS ({sums_sql('sample', 'channel, bl', A.RATIO)}) {final_sql('sums', SPEC_KEYS, excise=False)}")
def plain_average(spark, d):
    return average.spectral(_samples(spark, d), A.RATIO, A.N_ACCS, excise=False)


CONT_KEYS = "out_idx, cont_channel, bl"
CONT = f"sums AS ({sums_sql('sample', f'CAST(channel // {A.CONT_FACTOR} AS INT) AS cont_channel, bl', A.RATIO)})"


@query(f"WITH {CUBE}, {CONT} {final_sql('sums', CONT_KEYS)}")
def continuum_average(spark, d):
    return average.continuum(_samples(spark, d), A.RATIO, A.CONT_FACTOR, A.N_ACCS)


@query(f"WITH {CUBE}, {CONT} {final_sql('sums', CONT_KEYS, excise=False)}")
def plain_continuum(spark, d):
    return average.continuum(_samples(spark, d), A.RATIO, A.CONT_FACTOR, A.N_ACCS, excise=False)


@query(f"WITH {CUBE}, {SPEC} {packed_sql('spec', SPEC_KEYS, 'channel')}")
def compress_weights(spark, d):
    return average.compress_weights(excised_average(spark, d)).select("out_idx", "channel", "bl", "re", "im", "weight", "flags", "weight_channel", "weight_u8")


BULK = """bulk AS (
  SELECT CAST(l_orderkey // 16 AS BIGINT) AS dump, CAST(l_partkey % 64 AS INT) AS channel, CAST(l_suppkey % 16 AS INT) AS bl, CAST(l_quantity AS INT) AS re,
    CAST(floor(l_discount * 100 + 0.5) AS INT) AS im, CASE WHEN l_returnflag = 'R' THEN 16 ELSE 0 END AS flags FROM lineitem)"""


@query(f"WITH {BULK}, sums AS ({sums_sql('bulk', 'channel, bl', 16)}) {final_sql('sums', SPEC_KEYS)}")
def bulk_average(spark, d):
    return average.spectral(A.bulk(table(spark, d, "lineitem")), 16, A.N_ACCS)


@query(f"WITH {BULK}, sums AS ({sums_sql('bulk', 'CAST(channel // 16 AS INT) AS cont_channel, bl', 16)}) {final_sql('sums', CONT_KEYS)}")
def bulk_continuum(spark, d):
    return average.continuum(A.bulk(table(spark, d, "lineitem")), 16, 16, A.N_ACCS)


# --- quick-look -------------------------------------------------------------------------------------

BITS = ", ".join(f"count(*) FILTER ((flags & {COUNT_MASK} & {1 << b}) <> 0) AS c{b}" for b in range(8))
COUNTS = f"counts AS (SELECT CAST(dump // {SD_RATIO} AS BIGINT) AS out_idx, bl, {BITS}, count(*) FILTER ((flags & {COUNT_MASK}) <> 0) AS any_count FROM sample WHERE channel >= {SD_START} AND channel < {SD_STOP} GROUP BY ALL)"


def _counts(spark, d):
    return quicklook.flag_counts(_samples(spark, d), SD_START, SD_STOP, [average.group_index("dump", SD_RATIO).alias("out_idx"), "bl"])


@query(f"WITH {CUBE}, {COUNTS} SELECT out_idx, bl, {', '.join(f'c{b}' for b in range(8))} FROM counts")
def flag_bit_counts(spark, d):
    return _counts(spark, d).drop("any_count")


@query(f"WITH {CUBE}, {COUNTS} SELECT out_idx, bl, any_count FROM counts")
def flag_any_counts(spark, d):
    return _counts(spark, d).select("out_idx", "bl", "any_count")


FRACTIONS = ", ".join(f"c{b} / {float(SD_RATIO * (SD_STOP - SD_START))}::DOUBLE AS f{b}" for b in range(8))


@query(f"WITH {CUBE}, {COUNTS} SELECT out_idx, bl, {FRACTIONS} FROM counts")
def flag_fraction(spark, d):
    return quicklook.flag_fractions(_counts(spark, d), ["out_idx", "bl"], SD_RATIO, SD_STOP - SD_START)


SERIES = f"""series AS (
  SELECT out_idx, bl, sum(w * re) AS re, sum(w * im) AS im, sum(w * sqrt(re * re + im * im)) AS abs FROM (
    SELECT *, CASE WHEN channel >= {SD_START} AND channel < {SD_STOP} THEN {1.0 / A.N_CHANNELS}::DOUBLE ELSE 0.0::DOUBLE END AS w FROM spec) GROUP BY ALL)"""


def _series(spark, d):
    return quicklook.time_series(_sd(spark, d), quicklook.default_weights(spark, A.N_CHANNELS, SD_START, SD_STOP))


@query(f"WITH {CUBE}, {SD}, {SERIES} SELECT out_idx, bl, round(re, 6) AS re, round(im, 6) AS im FROM series")
def timeseries(spark, d):
    return _series(spark, d).select("out_idx", "bl", F.round("re", 6).alias("re"), F.round("im", 6).alias("im"))


@query(f"WITH {CUBE}, {SD}, {SERIES} SELECT out_idx, bl, round(abs, 6) AS abs FROM series")
def timeseries_abs(spark, d):
    return _series(spark, d).select("out_idx", "bl", F.round("abs", 6).alias("abs"))


GROUPED = """parts AS (
  SELECT bl, CASE WHEN left(input1, -1) = left(input2, -1) THEN 'auto' ELSE 'cross' END AS kind, CASE WHEN right(input1, 1) = 'h' THEN 'h' ELSE 'v' END AS p, CASE WHEN right(input2, 1) = 'h' THEN 'h' ELSE 'v' END AS q FROM base),
grouped AS (SELECT bl, unnest([kind, kind || CASE WHEN p = q THEN p || q ELSE 'hv' END]) AS grp FROM parts)"""
CELLS = f"cells AS (SELECT DISTINCT out_idx, channel, g.grp FROM spec, (SELECT unnest({list(baselines.GROUPS)}) AS grp) g)"
PERCENTILES = f"""{GROUPED}, {CELLS}, lists AS (
  SELECT out_idx, channel, grp, list_sort(list(sqrt(re * re + im * im))) AS a, bit_or(flags) AS flags FROM spec JOIN grouped USING (bl) GROUP BY ALL)"""
_rank = lambda p, name: f"a[CAST(floor({p} * (len(a) - 1)) AS INT) + 1] AS {name}"


def _percentiles(spark, d):
    return quicklook.percentiles(_sd(spark, d), baselines.groups(A.baselines(spark)), list(baselines.GROUPS))


@query(f"WITH {CUBE}, {SD}, {PERCENTILES} SELECT out_idx, channel, grp, {_rank(0, 'p_min')}, {_rank(1, 'p_max')}, {_rank(0.25, 'p_25')}, {_rank(0.75, 'p_75')}, {_rank(0.5, 'p_50')} FROM cells LEFT JOIN lists USING (out_idx, channel, grp)")
def percentile5(spark, d):
    """With the groups that have no baseline; their NaN is given as null, as NaN equals nothing."""
    ranks = [c for c in _percentiles(spark, d).columns if c.startswith("p_")]
    return _percentiles(spark, d).drop("flags").withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ranks})


@query(f"WITH {CUBE}, {SD}, {PERCENTILES} SELECT out_idx, channel, grp, CAST(coalesce(flags, 0) AS INT) AS flags FROM cells LEFT JOIN lists USING (out_idx, channel, grp)")
def percentile_flags(spark, d):
    return _percentiles(spark, d).select("out_idx", "channel", "grp", "flags")


@query(f"WITH {CUBE}, {SD} SELECT * FROM spec WHERE bl IN (1, 4)")
def custom_signals(spark, d):
    wanted = spark.createDataFrame([(0,), (99,)], "bl int")
    return quicklook.custom_signals(_sd(spark, d), wanted, spark.createDataFrame([(1,), (4,)], "bl int"), len(A.LABELS))


# --- interference detection -------------------------------------------------------------------------

SPECTRA = "spectra AS (SELECT vec_id AS bl, CAST(i - 1 AS INT) AS channel, abs(CAST(embedding[i] AS DOUBLE)) AS amp FROM embeddings, unnest(range(1, len(embedding) + 1)) AS t(i))"


def detect_sql(source: str, keys: str, flags: str | None = None, sigmas: float = SIGMAS) -> str:
    amp = f"CASE WHEN {flags} = 0 THEN amp END" if flags else "amp"
    use = f"dev <> 0 AND {flags} = 0" if flags else "dev <> 0"
    return f"""
bg AS (SELECT *, median({amp}) OVER (PARTITION BY {keys} ORDER BY channel ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING) AS background FROM {source}),
dv AS (SELECT *, amp - background AS dev FROM bg),
nz AS (SELECT *, {MAD_TO_SIGMA} * median(CASE WHEN {use} THEN abs(dev) END) OVER (PARTITION BY {keys}) AS noise FROM dv),
found AS (SELECT *, CASE WHEN dev > {sigmas} * noise THEN 16 ELSE 0 END AS rfi FROM nz)"""


def _spectra(spark, d):
    return A.spectra(table(spark, d, "embeddings"))


@query(f"WITH {SPECTRA}, {detect_sql('spectra', 'bl')} SELECT bl, channel, background FROM found")
def background_median(spark, d):
    return rfi.background(_spectra(spark, d), ["bl"]).select("bl", "channel", "background")


@query(f"WITH {SPECTRA}, {detect_sql('spectra', 'bl')} SELECT bl, channel, dev FROM found")
def deviation(spark, d):
    return rfi.deviation(rfi.background(_spectra(spark, d), ["bl"])).select("bl", "channel", "dev")


@query(f"WITH {SPECTRA}, {detect_sql('spectra', 'bl')} SELECT bl, round(any_value(noise), 9) AS noise FROM found GROUP BY bl")
def noise_mad(spark, d):
    df = rfi.noise(rfi.deviation(rfi.background(_spectra(spark, d), ["bl"])), ["bl"])
    return df.groupBy("bl").agg(F.round(F.first("noise"), 9).alias("noise"))


@query(f"WITH {SPECTRA}, {detect_sql('spectra', 'bl')} SELECT bl, round(any_value(noise), 9) AS noise FROM found GROUP BY bl")
def noise_selection(spark, d):
    """The same by selection, without a window over a spectrum."""
    found = rfi.selected_noise(rfi.deviation(rfi.background(_spectra(spark, d), ["bl"])), ["bl"])
    return found.select("bl", F.round("noise", 9).alias("noise"))


@query(f"WITH {SPECTRA}, {detect_sql('spectra', 'bl')} SELECT bl, channel, rfi FROM found")
def rfi_threshold(spark, d):
    return rfi.detect(_spectra(spark, d), ["bl"], n_sigma=SIGMAS).select("bl", "channel", "rfi")


@query(f"WITH {SPECTRA}, wide AS (SELECT * FROM spectra WHERE channel >= 10 AND channel < 54), {detect_sql('wide', 'bl')} SELECT bl, channel, rfi FROM found WHERE channel >= 16 AND channel < 48")
def rfi_guarded(spark, d):
    return rfi.detect_guarded(_spectra(spark, d), ["bl"], 16, 48, 6, n_sigma=SIGMAS).select("bl", "channel", "rfi")


AMPS = "amps AS (SELECT *, sqrt(CAST(re AS DOUBLE) * re + CAST(im AS DOUBLE) * im) AS amp FROM sample)"


@query(f"WITH {CUBE}, {AMPS}, {detect_sql('amps', 'dump, bl', 'flags')} SELECT dump, channel, bl, rfi FROM found")
def rfi_flag_aware(spark, d):
    df = _samples(spark, d).withColumn("amp", samples.amplitude())
    return rfi.detect(df, ["dump", "bl"], n_sigma=SIGMAS, flags="flags").select("dump", "channel", "bl", "rfi")


_widths = (1, 2, 4, 8)
_means = ", ".join(f"CASE WHEN count(dev) OVER (PARTITION BY bl ORDER BY channel ROWS BETWEEN CURRENT ROW AND {w - 1} FOLLOWING) = {w} THEN avg(dev) OVER (PARTITION BY bl ORDER BY channel ROWS BETWEEN CURRENT ROW AND {w - 1} FOLLOWING) END > {SIGMAS / 1.2**k!r} * noise AS o{w}" for k, w in enumerate(_widths))
_hits = " OR ".join(f"coalesce(max(CASE WHEN o{w} THEN 1 ELSE 0 END) OVER (PARTITION BY bl ORDER BY channel ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW), 0) = 1" for w in _widths)


@query(f"WITH {SPECTRA}, {detect_sql('spectra', 'bl')}, m AS (SELECT bl, channel, {_means} FROM found) SELECT bl, channel, CASE WHEN {_hits} THEN 16 ELSE 0 END AS rfi FROM m")
def rfi_threshold_sum(spark, d):
    df = rfi.noise(rfi.deviation(rfi.background(_spectra(spark, d), ["bl"])), ["bl"])
    return rfi.threshold_sum(df, ["bl"], SIGMAS).select("bl", "channel", "rfi")


# --- baselines and masks ----------------------------------------------------------------------------

ANTENNAS = "ant AS (SELECT s_suppkey AS number, 'm' || s_suppkey AS antenna, s_acctbal AS east, s_nationkey * 100.0::DOUBLE AS north FROM supplier)"
LABELLED = f"""{ANTENNAS}, products(k, p, q) AS (VALUES {_values([(k, p, q) for k, (p, q) in enumerate(baselines.PRODUCTS)])}),
labelled AS (
  SELECT CAST((a.number * 1000000 + b.number) * 4 + k AS BIGINT) AS cbf_bl, a.antenna || p AS input1, b.antenna || q AS input2, a.antenna AS ant1, b.antenna AS ant2, p AS pol1, q AS pol2
  FROM ant a JOIN ant b ON a.number <= b.number, products),
kept AS (SELECT * FROM labelled WHERE ant2 >= ant1)"""


def _antennas(spark, d):
    return A.antennas(table(spark, d, "supplier"))


@query(f"WITH {LABELLED} SELECT cbf_bl, input1, input2 FROM labelled")
def antenna_baselines(spark, d):
    return baselines.generate(_antennas(spark, d))


@query(f"WITH {LABELLED} SELECT cbf_bl, input1, input2, CAST(row_number() OVER (ORDER BY ant1 <> ant2, pol1 <> pol2, pol1, pol2, cbf_bl) - 1 AS INT) AS bl FROM kept")
def baseline_order(spark, d):
    return baselines.ordered_pairs(_antennas(spark, d))


@query(f"""WITH {LABELLED}, parts AS (SELECT cbf_bl, CASE WHEN ant1 = ant2 THEN 'auto' ELSE 'cross' END AS kind, CASE WHEN pol1 = pol2 THEN pol1 || pol2 ELSE 'hv' END AS pols FROM kept)
SELECT cbf_bl, unnest([kind, kind || pols]) AS grp FROM parts""")
def baseline_groups(spark, d):
    return baselines.grouped_pairs(_antennas(spark, d))


LENGTHS = "len AS (SELECT cbf_bl, ant1, ant2, sqrt((a.east - b.east) * (a.east - b.east) + (a.north - b.north) * (a.north - b.north) + 0.0::DOUBLE) AS length_m FROM kept JOIN ant a ON a.antenna = ant1 JOIN ant b ON b.antenna = ant2)"


def _measured(spark, d):
    return baselines.measured_pairs(_antennas(spark, d))


@query(f"WITH {LABELLED}, {LENGTHS} SELECT cbf_bl, ant1, ant2, length_m FROM len")
def antenna_length(spark, d):
    return baselines.pair_lengths(_measured(spark, d))


WIDTH = BANDWIDTH / A.N_CHANNELS
AXIS = f"axis AS (SELECT CAST(i AS INT) AS channel, {CENTRE - BANDWIDTH / 2}::DOUBLE + i * {WIDTH}::DOUBLE AS frequency, {WIDTH}::DOUBLE AS width FROM range({A.N_CHANNELS}) t(i))"
REACH = f"""model AS (SELECT p_retailprice AS fmin, p_retailprice + p_size / 100.0::DOUBLE AS fmax, p_size * 200.0::DOUBLE AS max_baseline FROM part),
reach AS (SELECT channel, max(max_baseline) AS reach FROM axis JOIN model ON frequency - width / 2 <= fmax AND frequency + width / 2 >= fmin GROUP BY channel)"""
RANGE = f"masked AS (SELECT cbf_bl, channel FROM len JOIN reach ON length_m <= reach WHERE ant1 <> ant2)"


AXIS_OF = baselines.Axis.of(A.N_CHANNELS, CENTRE, BANDWIDTH)


def _reach(spark, d):
    return baselines.interference_reach(AXIS_OF, A.interference(table(spark, d, "part")))


@query(f"WITH {CUBE}, {AXIS}, {SPEC} SELECT channel, frequency, count(*) AS n, CAST(sum(CAST(weight AS BIGINT)) AS BIGINT) AS weight FROM spec JOIN axis USING (channel) GROUP BY channel, frequency")
def channel_frequencies(spark, d):
    """Samples and weight of the averaged product at each frequency of the band."""
    axis = baselines.channel_axis(spark, A.N_CHANNELS, CENTRE, BANDWIDTH)
    return excised_average(spark, d).join(axis, "channel").groupBy("channel", "frequency").agg(F.count("*").alias("n"), F.sum(F.col("weight").cast("long")).alias("weight"))


@query(f"WITH {LABELLED}, {LENGTHS}, {AXIS}, {REACH}, {RANGE} SELECT cbf_bl, channel FROM masked")
def range_mask(spark, d):
    return baselines.range_mask(_measured(spark, d), _reach(spark, d))


@query(f"""WITH {LABELLED}, {LENGTHS}, {AXIS}, {REACH}, {RANGE},
lists AS (SELECT cbf_bl, string_agg(CAST(channel AS VARCHAR), ',' ORDER BY channel) AS channels FROM masked GROUP BY cbf_bl),
rows_ AS (SELECT cbf_bl, coalesce(channels, '') AS channels FROM len LEFT JOIN lists USING (cbf_bl))
SELECT cbf_bl, CAST(dense_rank() OVER (ORDER BY channels) - 1 AS INT) AS mask_id, channels FROM rows_""")
def unique_masks(spark, d):
    return baselines.pair_masks(_measured(spark, d), _reach(spark, d))


@query(f"""WITH {AXIS}, bands AS (SELECT p_size / 100.0::DOUBLE AS a, p_size / 100.0::DOUBLE + 0.002::DOUBLE AS b FROM part)
SELECT DISTINCT channel FROM axis JOIN bands ON (frequency - width / 2 - {CENTRE - BANDWIDTH / 2}::DOUBLE) / {BANDWIDTH}::DOUBLE <= b AND (frequency + width / 2 - {CENTRE - BANDWIDTH / 2}::DOUBLE) / {BANDWIDTH}::DOUBLE >= a""")
def band_mask(spark, d):
    model = table(spark, d, "part").select((F.col("p_size") / 100.0).alias("min_fraction"), (F.col("p_size") / 100.0 + 0.002).alias("max_fraction")).distinct()
    return baselines.band_mask(AXIS_OF, model)


@query("""SELECT l_orderkey, l_linenumber, CAST(floor((a - 30) / 7.0) * 7 AS BIGINT) AS low, CAST(ceil(b / 7.0) * 7 AS BIGINT) AS high, CAST(greatest(b - (a - 30), 0) AS BIGINT) AS n
FROM (SELECT l_orderkey, l_linenumber, CAST(l_partkey % 50 AS BIGINT) AS a, CAST(l_quantity AS BIGINT) AS b FROM lineitem)""")
def range_algebra(spark, d):
    a, b = F.col("l_partkey") % 50 - 30, F.col("l_quantity").cast("long")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", ranges.align_down(a, 7).alias("low"), ranges.align_up(b, 7).alias("high"), ranges.length(a, b).cast("long").alias("n"))


@query("SELECT p_partkey, (SELECT min(s) FROM (VALUES (2), (4), (8), (16), (32), (64)) t(s) WHERE s >= p_size) AS size FROM part")
def quantised_sizes(spark, d):
    sizes = F.array(*map(F.lit, (2, 4, 8, 16, 32, 64)))
    return table(spark, d, "part").select("p_partkey", F.array_min(F.filter(sizes, lambda s: s >= F.col("p_size"))).alias("size"))


# --- sensors ----------------------------------------------------------------------------------------


@query("""WITH s AS (SELECT user_id, ts, value FROM events WHERE event_type = 'error'), q AS (SELECT event_id, user_id, ts + INTERVAL 30 MINUTE AS at FROM events)
SELECT q.event_id, coalesce(s.value, -1.0::DOUBLE) AS value FROM q ASOF LEFT JOIN s ON q.user_id = s.user_id AND q.at >= s.ts""")
def sensor_asof(spark, d):
    events = table(spark, d, "events")
    queries = events.select(F.col("user_id").alias("sensor"), (F.col("ts").cast("timestamp") + F.expr("INTERVAL 30 MINUTE")).alias("at"), "event_id")
    return sensors.as_of(queries, A.sensors(events), F.lit(-1.0)).select("event_id", "value")


@query(f"""WITH s AS (SELECT user_id AS sensor, event_id AS seq, epoch_us(ts) - CASE WHEN {K} % 13 = 0 THEN 36000000000 ELSE 0 END AS ts FROM events),
w AS (SELECT *, max(ts) OVER (PARTITION BY sensor ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM s)
SELECT sensor, seq, CAST(ts AS BIGINT) AS ts FROM w WHERE seen IS NULL OR ts > seen""")
def sensor_dedupe(spark, d):
    us = F.unix_micros(F.col("ts").cast("timestamp")) - F.when(F.get_json_object("props", "$.k").cast("int") % 13 == 0, F.lit(36_000_000_000)).otherwise(F.lit(0))
    return sensors.strictly_newer(table(spark, d, "events").select(F.col("user_id").alias("sensor"), F.col("event_id").alias("seq"), us.alias("ts")))


SUSPECTS = "suspects AS (SELECT dump, 'm' || (channel % 3) AS antenna, bool_or(v > 20000) AS suspect FROM raw GROUP BY ALL)"


@query(f"""WITH {CUBE}, {SUSPECTS}, ends AS (SELECT DISTINCT bl, unnest([left(input1, -1), left(input2, -1)]) AS antenna FROM base)
SELECT dump, bl, CASE WHEN bool_or(suspect) THEN {CAM} ELSE 0 END AS baseline_flags FROM suspects JOIN ends USING (antenna) GROUP BY ALL""")
def baseline_suspects(spark, d):
    ants = A.baselines(spark).select("bl", baselines.antenna_of(F.col("input1")).alias("ant1"), baselines.antenna_of(F.col("input2")).alias("ant2"))
    # Markers hide values from the cube, so sensors look at the events.
    suspects = table(spark, d, "events").select(F.floor(F.col("event_id") / 256).cast("long").alias("dump"), F.concat(F.lit("m"), (F.floor(F.col("event_id") / 8) % A.N_CHANNELS % 3).cast("string")).alias("antenna"), (F.floor(F.col("value") * 100 + 0.5) > 20000).alias("bad"))
    return sensors.baseline_suspects(ants, suspects.groupBy("dump", "antenna").agg(F.bool_or("bad").alias("suspect")))


@query(f"""WITH {CUBE}, static AS (SELECT b.bl, m.channel FROM base b JOIN masks m ON m.mask_id = least(b.mask_id, {len(A.MASKS) - 1})),
live AS (SELECT dump, channel FROM reordered GROUP BY ALL HAVING sum(re) % 7 = 0), sus AS (SELECT dump, channel FROM reordered GROUP BY ALL HAVING sum(re) % 11 = 0)
SELECT r.dump, r.channel, r.bl, CAST((CASE WHEN s.bl IS NOT NULL OR l.dump IS NOT NULL THEN {STATIC} ELSE 0 END) | (CASE WHEN u.dump IS NOT NULL THEN {CAM} ELSE 0 END) AS INT) AS flags
FROM reordered r LEFT JOIN static s USING (bl, channel) LEFT JOIN live l ON l.dump = r.dump AND l.channel = r.channel LEFT JOIN sus u ON u.dump = r.dump AND u.channel = r.channel""")
def external_flags(spark, d):
    df = _reordered(spark, d)
    return sensors.external_flags(df.select("dump", "channel", "bl"), A.baselines(spark), A.channel_masks(spark), len(A.MASKS), *_live(df))


def _live(reordered):
    """Channels that are masked, and suspect ones, by dump."""
    per = reordered.groupBy("dump", "channel").agg(F.sum("re").alias("s"))
    return [per.where(F.col("s") % k == 0).select("dump", "channel") for k in (7, 11)]


INPUTS = ("m0h", "m0v", "m1h", "m1v")
HOT = 26000
INPUT_SUSPECTS = f"""input_rows AS (SELECT dump, channel % 4 AS pos, v > {HOT} AS bad FROM raw),
input_bad AS (SELECT DISTINCT dump, name FROM input_rows JOIN (VALUES {_values(list(enumerate(INPUTS)))}) l(pos, name) USING (pos) WHERE bad),
input_flags AS (SELECT dump, bl, EXISTS (FROM input_bad i WHERE i.dump = d.dump AND i.name IN (input1, input2)) AS bad FROM (SELECT DISTINCT dump FROM raw) d, base)"""


@query(f"WITH {CUBE}, {INPUT_SUSPECTS} SELECT dump, bl, CASE WHEN bad THEN {CAM} ELSE 0 END AS baseline_flags FROM input_flags")
def input_suspects(spark, d):
    pos = F.floor(F.col("event_id") / 8) % 4
    rows = table(spark, d, "events").select(F.floor(F.col("event_id") / 256).cast("long").alias("dump"), pos.alias("pos"), (F.floor(F.col("value") * 100 + 0.5) > HOT).alias("bad"))
    by = rows.groupBy("dump").agg(*[F.max(F.when(F.col("pos") == k, F.col("bad"))).alias(f"s{k}") for k in range(len(INPUTS))])
    return sensors.input_suspects(A.baselines(spark), list(INPUTS), by.select("dump", F.array(*[f"s{k}" for k in range(len(INPUTS))]).alias("suspects")))


# --- frames -----------------------------------------------------------------------------------------

HEAPS = f"""heaps AS (
  SELECT event_id AS arrival_seq, CASE WHEN event_type = 'error' AND {K} % 4 = 0 THEN 'incomplete' WHEN event_type = 'signup' AND {K} % 10 = 0 THEN 'metadata'
      WHEN event_type = 'signup' AND {K} % 10 = 1 THEN 'no-descriptor' WHEN event_type = 'click' AND {K} % 40 = 0 THEN 'bad-heap' WHEN event_type = 'click' AND {K} % 20 = 0 THEN 'bad-item' ELSE 'data' END AS kind,
    CAST(floor(epoch(ts) / 3600) AS BIGINT) - CASE WHEN {K} % 13 = 0 THEN 9 ELSE 0 END AS ts_raw,
    CAST((user_id % 4) * 8 + CASE WHEN {K} % 17 = 0 THEN 1 ELSE 0 END AS INT) AS frequency, CAST(floor(value * 100 + 0.5) AS BIGINT) AS payload, 's' || CAST((user_id // 4) % 8 AS BIGINT) AS session FROM events),
-- the first record with a time sets the base, an incomplete one or one without an item too
t0 AS (SELECT arg_min(ts_raw, arrival_seq) AS ts0 FROM heaps WHERE kind NOT IN ('metadata', 'no-descriptor', 'bad-heap')),
timed AS (SELECT h.*, CASE WHEN kind NOT IN ('metadata', 'no-descriptor', 'bad-heap') THEN CAST(floor((ts_raw - ts0) / {HEAP_INTERVAL}.0) AS BIGINT) END AS idx,
    ((ts_raw - ts0) % {HEAP_INTERVAL} + {HEAP_INTERVAL}) % {HEAP_INTERVAL} = 0 AS aligned FROM heaps h, t0),
tops AS (SELECT *, max(CASE WHEN aligned THEN idx END) OVER (ORDER BY arrival_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM timed),
classed AS (SELECT *, CASE WHEN kind IN ('incomplete', 'no-descriptor', 'metadata', 'bad-heap') THEN kind WHEN idx < greatest(0, coalesce(top, 0) - {ACTIVE - 1}) THEN 'too-old' WHEN NOT aligned THEN 'bad-timestamp'
    WHEN kind = 'bad-item' THEN 'bad-heap' WHEN frequency % {PER_ITEM} <> 0 OR frequency < {WANTED[0]} OR frequency >= {WANTED[1]} THEN 'bad-channel' ELSE 'ok' END AS reason FROM tops),
items AS (SELECT idx, frequency, arg_max(payload, arrival_seq) AS payload FROM classed WHERE reason = 'ok' GROUP BY ALL),
last_ AS (SELECT max(idx) AS last FROM classed WHERE aligned),
grid AS (SELECT CAST(i AS BIGINT) AS idx, f AS frequency FROM last_, unnest(range(last + 1)) t(i), unnest({FREQUENCIES}) u(f))"""


def _classified(spark, d):
    return frames.classify(A.heaps(table(spark, d, "events")), HEAP_INTERVAL, ACTIVE, PER_ITEM, *WANTED)


@query(f"WITH {HEAPS} SELECT arrival_seq, coalesce(idx, -1) AS idx, reason FROM classed")
def heap_classification(spark, d):
    return _classified(spark, d).select("arrival_seq", F.coalesce("idx", F.lit(-1)).alias("idx"), "reason")


@query(f"WITH {HEAPS} SELECT reason, count(*) AS n, CAST(sum(coalesce(payload, 0)) AS BIGINT) AS payload FROM classed GROUP BY reason")
def reject_reasons(spark, d):
    return frames.totals(_classified(spark, d))


@query(f"WITH {HEAPS} SELECT arrival_seq, idx, frequency FROM classed WHERE reason = 'too-old'")
def late_heaps(spark, d):
    return _classified(spark, d).where("reason = 'too-old'").select("arrival_seq", "idx", "frequency")


@query(f"WITH {HEAPS} SELECT idx, frequency, payload FROM items")
def dedupe_last_wins(spark, d):
    return frames.items(_classified(spark, d))


@query(f"WITH {HEAPS} SELECT idx, count(payload) AS n_items, count(*) - count(payload) AS n_missing FROM grid LEFT JOIN items USING (idx, frequency) GROUP BY idx")
def frame_completeness(spark, d):
    return frames.completeness(_classified(spark, d), FREQUENCIES)


@query(f"""WITH {HEAPS} SELECT idx, CAST(frequency + c AS INT) AS channel, coalesce(payload, 0) AS value, CASE WHEN payload IS NULL THEN {DATA_LOST} ELSE 0 END AS flags
FROM grid LEFT JOIN items USING (idx, frequency), range({PER_ITEM}) t(c) WHERE idx IN (SELECT idx FROM items)""")
def lost_fill(spark, d):
    return frames.fill_lost(_classified(spark, d), FREQUENCIES, PER_ITEM, DATA_LOST)


WRAP = 20


@query(f"""WITH r AS (SELECT event_id AS arrival_seq, (epoch_us(ts) // 1000000 + event_id * 400 - CASE WHEN {K} % 13 = 0 THEN 900 ELSE 0 END) % {1 << WRAP} AS ts_raw FROM events),
j AS (SELECT *, ts_raw - lag(ts_raw, 1, ts_raw) OVER (ORDER BY arrival_seq) AS jump FROM r)
SELECT arrival_seq, CAST(ts_raw + {1 << WRAP} * sum(CASE WHEN jump < {-(1 << (WRAP - 1))} THEN 1 WHEN jump > {1 << (WRAP - 1)} THEN -1 ELSE 0 END) OVER (ORDER BY arrival_seq) AS BIGINT) AS ts FROM j""")
def timestamp_unwrap(spark, d):
    k = F.get_json_object("props", "$.k").cast("int")
    raw = (F.unix_seconds(F.col("ts").cast("timestamp")) + F.col("event_id") * 400 - F.when(k % 13 == 0, 900).otherwise(0)) % (1 << WRAP)
    df = table(spark, d, "events").select(F.col("event_id").alias("arrival_seq"), raw.cast("long").alias("ts_raw"))
    return frames.unwrap(df, WRAP).select("arrival_seq", "ts")


#: Bits of the short timestamps.
WRAPPED = 10
_timed = "kind NOT IN ('metadata', 'no-descriptor', 'bad-heap')"
_hour = f"CAST(floor(epoch(ts) / 3600) AS BIGINT) - CASE WHEN {K} % 13 = 0 THEN 9 ELSE 0 END"
WRAPPED_HEAPS = (
    HEAPS.replace("heaps AS (", "short AS (", 1)
    .replace(_hour, f"({_hour}) % {1 << WRAPPED}", 1)
    .replace(
        "-- the first",
        f"""jumps AS (SELECT *, ts_raw - last_value(CASE WHEN {_timed} THEN ts_raw END IGNORE NULLS) OVER (ORDER BY arrival_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS jump FROM short),
heaps AS (SELECT * REPLACE (CAST(ts_raw + {1 << WRAPPED} * sum(CASE WHEN {_timed} AND jump < {-(1 << (WRAPPED - 1))} THEN 1 WHEN {_timed} AND jump > {1 << (WRAPPED - 1)} THEN -1 ELSE 0 END) OVER (ORDER BY arrival_seq) AS BIGINT) AS ts_raw) FROM jumps),
-- the first""",
        1,
    )
)


@query(f"WITH {WRAPPED_HEAPS} SELECT arrival_seq, coalesce(idx, -1) AS idx, reason FROM classed")
def wrapped_frames(spark, d):
    """Classification of records whose timestamps wrap."""
    heaps = A.heaps(table(spark, d, "events")).withColumn("ts_raw", F.col("ts_raw") % (1 << WRAPPED))
    out = frames.classify(heaps, HEAP_INTERVAL, ACTIVE, PER_ITEM, *WANTED, bits=WRAPPED)
    return out.select("arrival_seq", F.coalesce("idx", F.lit(-1)).alias("idx"), "reason")


# --- cadence ----------------------------------------------------------------------------------------


@query(f"WITH {BULK} SELECT CAST(dump // 8 AS BIGINT) AS grp, min(dump) AS first, max(dump) AS last, count(DISTINCT dump) AS n FROM bulk GROUP BY ALL")
def cadence_groups(spark, d):
    return cadence.groups(A.bulk(table(spark, d, "lineitem")), 8)


@query(f"""WITH {BULK} SELECT DISTINCT dump // 8 AS grp, ((dump // 8 + 0.5::DOUBLE) * 8.0::DOUBLE * {float(INTERVAL)}::DOUBLE + {BASE_TS}) / {SCALE}::DOUBLE AS seconds,
  CAST(trunc(((dump // 8 + 0.5::DOUBLE) * 8.0::DOUBLE * {float(INTERVAL)}::DOUBLE + {BASE_TS}) / {SCALE}::DOUBLE * 100) AS BIGINT) AS centiseconds FROM bulk""")
def mid_timestamps(spark, d):
    at = cadence.mid_timestamp(F.col("grp"), 8, INTERVAL, F.lit(BASE_TS), SCALE)
    df = cadence.groups(A.bulk(table(spark, d, "lineitem")), 8)
    return df.select("grp", at.alias("seconds"), cadence.centiseconds(at).alias("centiseconds"))


@query(f"WITH {HEAPS} SELECT ts0, ts0 / {SCALE}::DOUBLE + 0.5 * 2.0::DOUBLE AS first_timestamp FROM t0")
def first_timestamp(spark, d):
    return frames.first_timestamp(A.heaps(table(spark, d, "events"))).select("ts0", (F.col("ts0") / SCALE + 0.5 * 2.0).alias("first_timestamp"))


# --- metadata and sinks -----------------------------------------------------------------------------


@query("""WITH a AS (SELECT p_type AS prefix, p_brand AS key, max(p_name) AS value FROM part GROUP BY ALL),
o(prefix, priority) AS (VALUES ('SMALL', 0), ('ECONOMY', 1), ('STANDARD', 2)) SELECT key, arg_min(value, priority) AS value FROM a JOIN o USING (prefix) GROUP BY key""")
def attribute_lookup(spark, d):
    attributes = table(spark, d, "part").groupBy(F.col("p_type").alias("prefix"), F.col("p_brand").alias("key")).agg(F.max("p_name").alias("value"))
    return metadata.lookup(attributes, ["SMALL", "ECONOMY", "STANDARD"])


@query("""WITH n AS (SELECT 'user_' || user_id AS key, arg_min(event_type, event_id) AS value FROM events GROUP BY user_id)
SELECT key, value FROM n WHERE key NOT IN (SELECT 'user_' || c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def metadata_once(spark, d):
    new = table(spark, d, "events").select(F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("key"), F.col("event_id").alias("seq"), F.col("event_type").alias("value"))
    held = table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.concat(F.lit("user_"), F.col("c_custkey").cast("string")).alias("key"))
    return metadata.write_once(held, new)


@query(f"WITH {CUBE}, {SPEC} SELECT CAST(channel // 8 AS INT) AS substream, count(*) AS n, CAST(sum(CAST(weight AS BIGINT)) AS BIGINT) AS weight FROM spec GROUP BY ALL")
def substreams(spark, d):
    df = metadata.sharded(excised_average(spark, d), 4, A.N_CHANNELS)
    return df.groupBy("substream").agg(F.count("*").alias("n"), F.sum(F.col("weight").cast("long")).alias("weight"))


@query(f"WITH {CUBE} SELECT count(DISTINCT dump) AS n_dumps, count(DISTINCT channel) AS n_channels, count(DISTINCT bl) AS n_baselines, count(*) AS n_samples, count(*) FILTER (flags <> 0) AS n_flagged FROM sample")
def session_totals(spark, d):
    return _samples(spark, d).agg(F.count_distinct("dump").alias("n_dumps"), F.count_distinct("channel").alias("n_channels"), F.count_distinct("bl").alias("n_baselines"), F.count("*").alias("n_samples"), F.count_if(F.col("flags") != 0).alias("n_flagged"))


# --- composite plans --------------------------------------------------------------------------------

PLAN = IngestPlan(n_accs=A.N_ACCS, n_channels=A.N_CHANNELS, start=SD_START, stop=SD_STOP, ratio=A.RATIO, sd_ratio=SD_RATIO, cont_factor=A.CONT_FACTOR, sd_cont_factor=4, n_masks=len(A.MASKS), guard=6, detector=partial(rfi.detect, n_sigma=SIGMAS, flags="flags"))
WIDE = f"wide AS (SELECT *, sqrt(CAST(re AS DOUBLE) * re + CAST(im AS DOUBLE) * im) AS amp FROM sample WHERE channel >= {SD_START - 6} AND channel < {SD_STOP + 6})"
FLAGGED = f"{WIDE}, {detect_sql('wide', 'dump, bl', 'flags')}, flagged AS (SELECT dump, channel, bl, re, im, flags | rfi AS flags FROM found WHERE channel >= {SD_START} AND channel < {SD_STOP})"


def _products(spark, d):
    raw = _raw(spark, d)
    return PLAN.build(raw, A.permutation(spark), A.baselines(spark), A.channel_masks(spark))


PACKED = ["re", "im", "weight", "flags", "weight_channel", "weight_u8"]


@query(f"WITH {CUBE}, {FLAGGED}, sums AS ({sums_sql('flagged', 'channel, bl', A.RATIO)}), spec AS ({final_sql('sums', SPEC_KEYS)}) {packed_sql('spec', SPEC_KEYS, 'channel')}")
def ingest_spectral(spark, d):
    return _products(spark, d)["spectral"].select("out_idx", "channel", "bl", *PACKED)


@query(f"WITH {CUBE}, {FLAGGED}, sums AS ({sums_sql('flagged', f'CAST(channel // {A.CONT_FACTOR} AS INT) AS cont_channel, bl', A.RATIO)}), spec AS ({final_sql('sums', CONT_KEYS)}) {packed_sql('spec', CONT_KEYS, 'cont_channel')}")
def ingest_continuum(spark, d):
    return _products(spark, d)["continuum"].select("out_idx", "cont_channel", "bl", *PACKED)


@query(f"""WITH {CUBE}, {FLAGGED}, sums AS ({sums_sql('flagged', 'channel, bl', SD_RATIO)}), spec AS ({final_sql('sums', SPEC_KEYS)}), {SERIES},
counts AS (SELECT CAST(dump // {SD_RATIO} AS BIGINT) AS out_idx, bl, count(*) FILTER ((flags & {COUNT_MASK}) <> 0) AS any_count FROM flagged GROUP BY ALL)
SELECT out_idx, bl, round(re, 6) AS re, round(im, 6) AS im, round(abs, 6) AS abs, any_count FROM series JOIN counts USING (out_idx, bl)""")
def ingest_quicklook(spark, d):
    made = _products(spark, d)
    series = made["sd_time_series"].select("out_idx", "bl", *[F.round(c, 6).alias(c) for c in ("re", "im", "abs")])
    return series.join(made["sd_flag_counts"].select("out_idx", "bl", "any_count"), ["out_idx", "bl"])


_product = lambda name, ratio, cell: f"SELECT '{name}' AS product, * FROM ({final_sql('(' + sums_sql('flagged', f'CAST({cell} AS INT) AS cell, bl', ratio) + ')', 'out_idx, cell, bl')})"


@query(f"""WITH {CUBE}, {FLAGGED} {_product('spectral', A.RATIO, 'channel')} UNION ALL {_product('continuum', A.RATIO, f'channel // {A.CONT_FACTOR}')}
UNION ALL {_product('sd_spectral', SD_RATIO, 'channel')} UNION ALL {_product('sd_continuum', SD_RATIO, 'channel // 4')}""")
def ingest_products(spark, d):
    """Both cadences' spectral and continuum products, from sums that are written once."""
    made = PLAN.build(_raw(spark, d), A.permutation(spark), A.baselines(spark), A.channel_masks(spark), base=partial(written, name="sums"))
    names = {"spectral": "channel", "continuum": "cont_channel", "sd_spectral": "channel", "sd_continuum": "cont_channel"}
    parts = [made[p].select(F.lit(p).alias("product"), "out_idx", F.col(c).alias("cell"), "bl", "re", "im", "weight", "flags") for p, c in names.items()]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


EXTERNAL = f"""{SUSPECTS}, {INPUT_SUSPECTS}, ends AS (SELECT DISTINCT bl, unnest([left(input1, -1), left(input2, -1)]) AS antenna FROM base),
live AS (SELECT dump, channel FROM reordered GROUP BY ALL HAVING sum(re) % 7 = 0), sus AS (SELECT dump, channel FROM reordered GROUP BY ALL HAVING sum(re) % 11 = 0),
bad AS (SELECT dump, bl, bool_or(bad) AS bad FROM (SELECT dump, bl, suspect AS bad FROM suspects JOIN ends USING (antenna) UNION ALL SELECT dump, bl, bad FROM input_flags) GROUP BY ALL),
told AS (SELECT s.* REPLACE (s.flags | (CASE WHEN l.dump IS NOT NULL THEN {STATIC} ELSE 0 END) | (CASE WHEN u.dump IS NOT NULL THEN {CAM} ELSE 0 END) AS flags)
  FROM sample s LEFT JOIN live l ON l.dump = s.dump AND l.channel = s.channel LEFT JOIN sus u ON u.dump = s.dump AND u.channel = s.channel)"""
EXTERNAL_FLAGGED = FLAGGED.replace("FROM sample", "FROM told").replace("flagged AS (", "detected AS (") + f", flagged AS (SELECT f.* REPLACE (f.flags | (CASE WHEN b.bad THEN {CAM} ELSE 0 END) AS flags) FROM detected f LEFT JOIN bad b ON b.dump = f.dump AND b.bl = f.bl)"


@query(f"WITH {CUBE}, {EXTERNAL}, {EXTERNAL_FLAGGED}, sums AS ({sums_sql('flagged', 'channel, bl', A.RATIO)}), spec AS ({final_sql('sums', SPEC_KEYS)}) {packed_sql('spec', SPEC_KEYS, 'channel')}")
def ingest_external(spark, d):
    """The spectral product with static and live masks, suspect channels, antennas and inputs."""
    flags = sensors.any_suspects(baseline_suspects(spark, d), input_suspects(spark, d))
    channel_flags = sensors.channel_flags(*_live(_reordered(spark, d)))
    made = PLAN.build(_raw(spark, d), A.permutation(spark), A.baselines(spark), A.channel_masks(spark), flags, channel_flags)
    return made["spectral"].select("out_idx", "channel", "bl", *PACKED)


SHARDS, WIDTH = 4, SD_STOP - SD_START


@query(f"""WITH {CUBE}, {FLAGGED}, sums AS ({sums_sql('flagged', 'channel, bl', A.RATIO)}), spec AS ({final_sql('sums', SPEC_KEYS)}), packed AS ({packed_sql('spec', SPEC_KEYS, 'channel')})
SELECT out_idx AS dump_index, ((out_idx + 0.5::DOUBLE) * {float(A.RATIO)}::DOUBLE * {float(INTERVAL)}::DOUBLE + {BASE_TS}) / {SCALE}::DOUBLE AS timestamp,
  CAST((channel - {SD_START}) // {WIDTH // SHARDS} AS INT) AS substream, CAST((channel - {SD_START}) // {WIDTH // SHARDS} * {WIDTH // SHARDS} + {SD_START} AS INT) AS frequency, CAST(channel - {SD_START} AS INT) AS channel, bl, flags, weight_u8 FROM packed""")
def product_rows(spark, d):
    made = _products(spark, d)["spectral"].withColumn("channel", F.col("channel") - SD_START)
    rows = metadata.product_rows(made, A.RATIO, INTERVAL, BASE_TS, SCALE, WIDTH, SHARDS, SD_START)
    return rows.select("dump_index", "timestamp", "substream", "frequency", "channel", "bl", "flags", "weight_u8")


FIXED = {"sync_time": 0.0, "center_freq": CENTRE, "int_time": A.RATIO * INTERVAL / SCALE, "excise": True, "src_streams": ["raw"], "stream_type": "vis", "calibrations_applied": 0, "need_weights_power_scale": True}
_json_rows = ", ".join(f"('l0_{k}', '{json.dumps(v)}')" for k, v in FIXED.items())


@query(f"""WITH {CUBE}, {FLAGGED}, s AS (SELECT count(DISTINCT channel) AS n, min(channel) AS low, max(channel) + 1 AS high, count(DISTINCT bl) AS bls FROM flagged),
a(key, value) AS (VALUES {_json_rows}),
told AS (SELECT * FROM a UNION ALL SELECT unnest(['l0_n_chans', 'l0_n_chans_per_substream', 'l0_n_bls', 'l0_channel_range', 'l0_bandwidth', 'l0_bls_ordering']),
  unnest([CAST(n AS VARCHAR), CAST(n // {SHARDS} AS VARCHAR), CAST(bls AS VARCHAR), '[' || low || ', ' || high || ']', CAST({BANDWIDTH} * n / {A.N_CHANNELS} AS VARCHAR),
    (SELECT '[' || string_agg('["' || input1 || '", "' || input2 || '"]', ', ' ORDER BY bl) || ']' FROM base WHERE bl IN (SELECT bl FROM flagged))]) FROM s)
SELECT key, value FROM told WHERE key NOT IN (SELECT 'l0_' || event_type FROM events)""")
def product_attributes(spark, d):
    """Attributes of the product as it is in the data, those that are not there yet."""
    product = _products(spark, d)["samples"]
    seen = product.agg(F.count_distinct("channel").alias("n"), F.min("channel").alias("low"), (F.max("channel") + 1).alias("high"), F.sort_array(F.collect_set("bl")).alias("bls")).first()
    values = FIXED | {
        "n_chans": seen["n"], "n_chans_per_substream": seen["n"] // SHARDS, "n_bls": len(seen["bls"]), "bls_ordering": [list(A.LABELS[b]) for b in seen["bls"]],
        "channel_range": [seen["low"], seen["high"]], "bandwidth": BANDWIDTH * seen["n"] / A.N_CHANNELS,
    }
    held = table(spark, d, "events").select(F.concat(F.lit("l0_"), "event_type").alias("key")).distinct()
    return metadata.write_once(held, metadata.product_attributes(spark, "l0", values))


# --- the display's group ----------------------------------------------------------------------------


SIGNALS = (1, 4)


def _display(spark, d):
    chosen = spark.createDataFrame([(b,) for b in SIGNALS], "bl int")
    return display.display(PLAN, _products(spark, d), chosen, chosen.limit(1), list(A.LABELS), CENTRE, BANDWIDTH, INTERVAL, BASE_TS, SCALE, (0, A.N_CHANNELS))


_ordering = "[" + ", ".join(f"['{a}', '{b}']" for a, b in A.LABELS) + "]"


@query(f"""WITH {CUBE}, {FLAGGED}, f AS (SELECT DISTINCT CAST(dump // {SD_RATIO} AS BIGINT) AS out_idx FROM flagged)
SELECT out_idx, CAST(trunc(((out_idx + 0.5::DOUBLE) * {float(SD_RATIO)}::DOUBLE * {float(INTERVAL)}::DOUBLE + {BASE_TS}) / {SCALE}::DOUBLE * 100) AS BIGINT) AS sd_timestamp,
  array_to_string(flatten({_ordering}), ' ') AS bls_ordering, {BANDWIDTH}::DOUBLE AS bandwidth, {CENTRE}::DOUBLE AS center_freq, {A.N_CHANNELS} AS n_chans, {A.N_CHANNELS // 4} AS sd_blmx_n_chans, {SD_START} AS frequency FROM f""")
def display_frames(spark, d):
    """One row a frame: its time stamp, and the items that hold for the session."""
    made = _display(spark, d)
    out = made["sd_timestamp"].withColumnRenamed("centiseconds", "sd_timestamp")
    for name in ("bls_ordering", "bandwidth", "center_freq", "n_chans", "sd_blmx_n_chans", "frequency"):
        out = out.join(made[name], "out_idx")
    return out.withColumn("bls_ordering", F.array_join(F.flatten("bls_ordering"), " "))


@query(f"""WITH {CUBE}, {FLAGGED}, sums AS ({sums_sql('flagged', 'channel, bl', SD_RATIO)}), spec AS ({final_sql('sums', SPEC_KEYS)}),
csums AS ({sums_sql('flagged', 'CAST(channel // 4 AS INT) AS cont_channel, bl', SD_RATIO)}), cont AS ({final_sql('csums', CONT_KEYS)})
SELECT 'sd_data' AS item, out_idx, channel AS cell, bl, re, im, flags FROM spec WHERE bl IN {SIGNALS} UNION ALL SELECT 'sd_blmxdata', out_idx, cont_channel, bl, re, im, flags FROM cont""")
def display_data(spark, d):
    """Spectra of the chosen signals with their flags, and the baseline matrix with its flags."""
    made, key = _display(spark, d), ["out_idx", "channel", "bl"]
    signals = made["sd_data"].join(made["sd_flags"], key).join(made["sd_data_index"], ["out_idx", "bl"])
    matrix = made["sd_blmxdata"].join(made["sd_blmxflags"], ["out_idx", "cont_channel", "bl"])
    shape = lambda df, item, cell: df.select(F.lit(item).alias("item"), "out_idx", F.col(cell).alias("cell"), "bl", "re", "im", "flags")
    return shape(signals, "sd_data", "channel").union(shape(matrix, "sd_blmxdata", "cont_channel"))


# --- partial items, times of frames, live masks -----------------------------------------------------

PART = (5, 21)


@query(f"""WITH {HEAPS} SELECT idx, CAST(frequency + c - {PART[0]} AS INT) AS channel, coalesce(payload, 0) AS value, CASE WHEN payload IS NULL THEN {DATA_LOST} ELSE 0 END AS flags
FROM grid LEFT JOIN items USING (idx, frequency), range({PER_ITEM}) t(c) WHERE idx IN (SELECT idx FROM items) AND frequency + c >= {PART[0]} AND frequency + c < {PART[1]}""")
def partial_items(spark, d):
    """Items against a wanted range that begins and ends within them."""
    return frames.fill_lost(_classified(spark, d), FREQUENCIES, PER_ITEM, DATA_LOST, PART)


SYNC = 1_700_000_000.0


@query(f"""WITH {HEAPS} SELECT DISTINCT idx, (ts0 + idx * {HEAP_INTERVAL}) / {SCALE}::DOUBLE AS relative, {SYNC}::DOUBLE + (ts0 + idx * {HEAP_INTERVAL}) / {SCALE}::DOUBLE AS unix,
  CAST(trunc(({SYNC}::DOUBLE + (ts0 + idx * {HEAP_INTERVAL}) / {SCALE}::DOUBLE) * 1000000) AS BIGINT) AS micros FROM grid, t0""")
def frame_times(spark, d):
    """Relative and absolute time of every frame, wholly empty ones included."""
    all_ = frames.grid(_classified(spark, d), FREQUENCIES[:1]).join(frames.first_timestamp(A.heaps(table(spark, d, "events"))))
    out = cadence.timestamps(all_, F.col("ts0") + F.col("idx") * HEAP_INTERVAL, SCALE, SYNC)
    return out.select("idx", "relative", "unix", F.unix_micros("instant").alias("micros"))


_band = f"list_transform(range({A.N_CHANNELS}), lambda c: (c + {K}) % 9 = 0)"


@query(f"""WITH t AS (SELECT CAST(event_id // 256 AS BIGINT) AS dump, avg(epoch_us(ts) / 1000000.0::DOUBLE) AS mid FROM events GROUP BY ALL),
s AS (SELECT epoch_us(ts) / 1000000.0::DOUBLE AS at, arg_max({_band}, event_id) AS said FROM events WHERE event_type = 'signup' GROUP BY ALL)
SELECT dump, CAST(c AS INT) AS channel FROM (SELECT dump, said FROM t ASOF JOIN s ON t.mid + 900.0 >= s.at), unnest(range({SD_START}, {SD_STOP})) u(c) WHERE said[c + 1]""")
def live_channel_masks(spark, d):
    """Channels masked in each dump by the last value of the channel sensor before the dump's end, a sensor of the old form with rows of channels."""
    events, at = table(spark, d, "events"), F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1_000_000.0)
    dumps = events.groupBy(F.floor(F.col("event_id") / 256).alias("dump")).agg(F.avg(at).alias("mid"))
    k = F.get_json_object("props", "$.k").cast("int")
    said = F.transform(F.sequence(F.lit(0), F.lit(A.N_CHANNELS - 1)), lambda c: (c + k) % 9 == 0)
    sensor = events.where("event_type = 'signup'").select(at.alias("ts"), F.col("event_id").alias("seq"), F.array(said).alias("value"))
    return sensors.channels_at_dumps(dumps, sensor, SD_START, SD_STOP, 1800.0)


# --- streaming --------------------------------------------------------------------------------------


BY_SESSION = (
    HEAPS.replace("(SELECT arg_min(ts_raw, arrival_seq) AS ts0 FROM heaps", "(SELECT session, arg_min(ts_raw, arrival_seq) AS ts0 FROM heaps")
    .replace("'bad-heap')),\ntimed", "'bad-heap') GROUP BY session),\ntimed")
    .replace("FROM heaps h, t0)", "FROM heaps h LEFT JOIN t0 USING (session))")
    .replace("OVER (ORDER BY arrival_seq", "OVER (PARTITION BY session ORDER BY arrival_seq")
    .replace("(SELECT max(idx) AS last FROM classed WHERE aligned)", "(SELECT session, max(idx) AS last FROM classed WHERE aligned GROUP BY session)")
)


@query(f"""WITH {BY_SESSION} SELECT session, coalesce(idx, -1) AS idx, frequency, CAST(-1 AS BIGINT) AS payload, reason, arrival_seq FROM classed WHERE reason <> 'ok'
UNION ALL SELECT session, idx, frequency, arg_max(payload, arrival_seq), 'ok', max(arrival_seq) FROM classed JOIN last_ USING (session) WHERE reason = 'ok' AND idx < last - {ACTIVE - 1} GROUP BY session, idx, frequency""")
def stream_frames(spark, d):
    return streams.stream_frames(spark, d)


_hours = 3600 * streams.HOURS


@query(f"""WITH s AS (
  SELECT CAST(floor(epoch(ts) / {_hours}) AS BIGINT) AS out_idx, CAST((event_id // 8) % {A.N_CHANNELS} AS INT) AS channel, CAST(event_id % 8 AS INT) AS bl,
    CAST(floor(value * 100 + 0.5) AS INT) AS re, {K} - 50 AS im, CASE WHEN {K} % 3 = 0 THEN 16 ELSE 0 END AS flags FROM events),
sums AS ({sums_sql('s', 'out_idx, channel, bl', 1).replace('CAST(dump // 1 AS BIGINT) AS out_idx, ', '')}),
edge AS (SELECT max(epoch(ts)) - 60 AS closed FROM events)
{final_sql('sums, edge', SPEC_KEYS)} WHERE (out_idx + 1) * {_hours} <= closed""")
def stream_average(spark, d):
    return streams.stream_average(spark, d)


@query(f"""WITH s AS (
  SELECT CAST(floor(epoch(ts) / 3600) AS BIGINT) AS dump, CAST((event_id // 8) % 4 AS INT) AS channel, CAST(user_id % {streams.BASELINES} AS INT) AS bl,
    CAST(floor(value * 100 + 0.5) AS INT) AS re, {K} - 50 AS im, CASE WHEN {K} % 3 = 0 THEN 16 ELSE 0 END AS flags FROM events),
sums AS ({sums_sql('s', 'channel, bl', streams.RATIO)}), last_ AS (SELECT bl, max(dump // {streams.RATIO}) AS open FROM s GROUP BY bl)
{final_sql('sums JOIN last_ USING (bl)', SPEC_KEYS)} WHERE out_idx < open""")
def stream_count_windows(spark, d):
    return streams.stream_count_windows(spark, d)


@query("""WITH s AS (SELECT user_id, event_id, ts, value, max(ts) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM events WHERE event_type = 'error'),
n AS (SELECT * FROM s WHERE seen IS NULL OR ts > seen), q AS (SELECT event_id, user_id, ts + INTERVAL 30 MINUTE AS at FROM events), edge AS (SELECT max(epoch_ms(ts)) * 1000 AS passed FROM events)
SELECT q.event_id, coalesce(n.value, -1.0::DOUBLE) AS value FROM q ASOF LEFT JOIN n ON q.user_id = n.user_id AND q.at >= n.ts WHERE epoch_us(q.at) < (SELECT passed FROM edge)""")
def stream_asof(spark, d):
    return streams.stream_asof(spark, d)


@query(f"WITH {HEAPS} SELECT arrival_seq, kind, ts_raw, frequency, payload, CAST(frequency // {PER_ITEM} AS INT) AS endpoint FROM heaps WHERE frequency >= {WANTED[0]} AND frequency < {WANTED[1]}")
def heaps_by_endpoint(spark, d):
    return streams.heaps_by_endpoint(spark, d)


# --- masks of models, shared base, totals -----------------------------------------------------------

MODEL_MASKS = f"""{AXIS}, {REACH}, pairs AS (SELECT bl, left(input1, -1) AS a1, left(input2, -1) AS a2 FROM base),
ant AS (SELECT 'm' || (s_suppkey - 1) AS antenna, s_acctbal AS east, s_nationkey * 100.0::DOUBLE AS north FROM supplier),
model_mask AS (SELECT bl, channel FROM (SELECT bl, sqrt((a.east - b.east) * (a.east - b.east) + (a.north - b.north) * (a.north - b.north)) AS length_m FROM pairs JOIN ant a ON a.antenna = a1 JOIN ant b ON b.antenna = a2 WHERE a1 <> a2) JOIN reach ON length_m <= reach)"""
MASKED_FLAGGED = FLAGGED.replace("FROM sample", "FROM modelled")


def _model_masks(spark, d):
    """(bl, mask_id) and (mask_id, channel, mask_flags) of the output baselines, by the interference model."""
    base = A.baselines(spark).withColumn("cbf_bl", F.col("bl").cast("long"))
    places = A.antennas(table(spark, d, "supplier").withColumn("s_suppkey", F.col("s_suppkey") - 1))
    reach = baselines.interference_reach(AXIS_OF, A.interference(table(spark, d, "part")))
    ids, channels = baselines.plan_masks(baselines.range_mask(baselines.lengths(base, places), reach), base)
    return ids.withColumn("bl", F.col("cbf_bl").cast("int")).drop("cbf_bl"), channels.withColumn("mask_flags", F.lit(STATIC))


@query(f"""WITH {CUBE}, {MODEL_MASKS}, unmasked AS (SELECT *, CASE WHEN re = 0 AND im = 0 THEN {CAM} ELSE 0 END | CASE WHEN missing THEN {DATA_LOST} ELSE 0 END AS own FROM reordered),
modelled AS (SELECT u.dump, u.channel, u.bl, re, im, own | (CASE WHEN m.bl IS NOT NULL THEN {STATIC} ELSE 0 END) AS flags FROM unmasked u LEFT JOIN model_mask m ON m.bl = u.bl AND m.channel = u.channel),
{MASKED_FLAGGED}, sums AS ({sums_sql('flagged', 'channel, bl', A.RATIO)}), spec AS ({final_sql('sums', SPEC_KEYS)}) {packed_sql('spec', SPEC_KEYS, 'channel')}""")
def ingest_masked(spark, d):
    """The spectral product with the masks that the planner makes of the interference model."""
    ids, masks = _model_masks(spark, d)
    made = replace(PLAN, n_masks=1 << 31).build(_raw(spark, d), A.permutation(spark), A.baselines(spark).drop("mask_id").join(ids, "bl"), masks)
    return made["spectral"].select("out_idx", "channel", "bl", *PACKED)


_shared = HEAPS.replace("(SELECT arg_min(ts_raw, arrival_seq) AS ts0 FROM heaps", "(SELECT arg_min(ts_raw, arrival_seq) AS ts0 FROM heaps WHERE session = 's3' AND").replace("AND WHERE kind", "AND kind")


@query(f"WITH {_shared} SELECT arrival_seq, session, coalesce(idx, -1) AS idx FROM timed WHERE session IN ('s3', 's5')")
def shared_first_timestamp(spark, d):
    """Frame numbers of two sessions that share the base of the one which told its first timestamp first."""
    heaps, folder = A.heaps(table(spark, d, "events"), by_session=True), fresh_folder(spark, "base")
    out = []
    for name in ("s3", "s5"):
        own = heaps.where(F.col("session") == name)
        base = commit.shared_base(spark, folder, "block", own)
        out.append(frames.classify(own, HEAP_INTERVAL, ACTIVE, PER_ITEM, *WANTED, base=base).select("arrival_seq", "session", F.coalesce("idx", F.lit(-1)).alias("idx")))
    return out[0].union(out[1])


@query(f"""WITH {CUBE}, {SPEC} SELECT count(*) AS n_samples, count(*) FILTER (flags <> 0) AS n_flagged, count(*) * 8 AS bytes_in, CAST(min(dump) AS BIGINT) AS first_dump, CAST(max(dump) AS BIGINT) AS last_dump,
  (SELECT count(*) FROM spec) AS n_out, (SELECT count(*) * 10 FROM spec) AS bytes_out FROM sample""")
def observed_totals(spark, d):
    """Totals of a session's input and output, observed while its product is written."""
    seen, made = Observation("input"), Observation("output")
    flagged = metadata.observe_samples(_samples(spark, d), seen)
    product = metadata.observe_product(average.compress_weights(average.spectral(flagged, A.RATIO, A.N_ACCS)), made)
    written(product, "observed")
    return spark.createDataFrame([{**seen.get, **made.get}], "n_samples long, n_flagged long, bytes_in long, first_dump long, last_dump long, n_out long, bytes_out long")
