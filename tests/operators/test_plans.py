"""Medians by selection, covered channels, planned masks, and what the composite plan exchanges."""

import io
import contextlib
import math
import random
import statistics
from functools import partial

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from visloom.operators import average, baselines, metadata, quicklook, rfi, sensors
from visloom.plans.ingest import IngestPlan
from visloom.session import written


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


@pytest.mark.parametrize("rounds", [0, 1, 2])
def test_medians_by_selection(spark, rounds):
    rng = random.Random(rounds)
    keyed = {
        0: [rng.expovariate(1) for _ in range(1001)],
        1: [rng.expovariate(1) for _ in range(1000)],
        2: [rng.choice([0.0, 1.0, 1.0, 2.0]) for _ in range(500)],
        3: [10.0 ** rng.randint(-300, 300) for _ in range(400)],
        4: [1 + k * 2.0**-52 for k in range(64)],
        5: [7.5],
        6: [0.0, 1e9],
        7: [None, None],
    }
    rows = [(k, v) for k, vs in keyed.items() for v in [*vs, None]]
    got = {r["k"]: r["m"] for r in rfi.medians(spark.createDataFrame(rows, "k int, v double"), ["k"], "v", "m", rounds).collect()}
    assert got == {k: statistics.median(vs) for k, vs in keyed.items() if vs[0] is not None}


def test_selected_noise_of_a_long_spectrum(spark):
    """32,768 channels; of the windows of the plan none is over a spectrum's channels."""
    df = spark.range(2 * 32_768).select((F.col("id") % 2).alias("bl"), F.floor(F.col("id") / 2).cast("int").alias("channel"), ((F.pmod(F.xxhash64("id"), F.lit(2001)) - 1000) / 7.0).alias("dev"), (F.col("id") % 5 == 0).cast("int").alias("flags"))
    found = rfi.selected_noise(df, ["bl"], "flags")
    windows = [line for line in plan_of(found).splitlines() if "Window [" in line]
    assert windows and all("_b#" in line for line in windows)
    expected = {r["bl"]: r["n"] for r in df.where("dev <> 0 AND flags = 0").groupBy("bl").agg((F.percentile(F.abs("dev"), 0.5) * 1.4826).alias("n")).collect()}
    assert {r["bl"]: r["noise"] for r in found.collect()} == pytest.approx(expected)


@pytest.mark.parametrize("n", [1, 7, 32])
def test_covered_channels(spark, n):
    rng = random.Random(n)
    ranges = [(a, rng.randint(a - 1, n - 1), rng.random()) for a in (rng.randrange(n) for _ in range(40))]
    df = spark.createDataFrame(ranges, "first long, last long, v double")
    best = {}
    for a, b, v in ranges:
        for c in range(a, b + 1):
            best[c] = max(best.get(c, 0), v)
    assert {r["channel"]: r["v"] for r in baselines.covered(df, n, "v").collect()} == best
    assert {r["channel"] for r in baselines.covered(df, n).collect()} == set(best)
    assert baselines.covered(df.limit(0), n, "v").count() == 0


def test_interference_as_by_comparison(spark):
    """As every channel against every range, with ranges outside, on edges, without end and without length."""
    axis, rng = baselines.Axis.of(64, 1284.0, 856.0), random.Random(3)
    at = [axis.first + k * axis.width / 2 for k in range(-5, 140)]
    model = [(a, a + rng.choice([0.0, 0.1, 13.375, 300.0]), rng.choice([100.0, 900.0, math.inf])) for a in rng.sample(at, 60)] + [(-math.inf, 900.0, 5.0), (5000.0, math.inf, 7.0), (1300.0, 1200.0, 1e9)]
    best = {}
    for lo, hi, reach in model:
        for c in range(axis.n):
            f = axis.first + c * axis.width
            if f - axis.width / 2 <= hi and f + axis.width / 2 >= lo:
                best[c] = max(best.get(c, 0.0), reach)
    reach = baselines.interference_reach(axis, spark.createDataFrame(model, "fmin double, fmax double, max_baseline double"))
    # A range whose end lies before its start touches a channel only if both edges fall in it.
    assert {r["channel"]: r["reach"] for r in reach.collect()} == best
    lengths = [(k, "a", "a" if k == 0 else "b", float(x)) for k, x in enumerate([0, 0, 4.9, 5, 99.99, 100, 100.01, 899, 901, 1e7])]
    measured = spark.createDataFrame(lengths, "cbf_bl long, ant1 string, ant2 string, length_m double")
    for autos in (False, True):
        expected = {(k, c) for k, a, b, x in lengths for c, r in best.items() if x <= r and (autos or a != b)}
        assert {tuple(r) for r in baselines.range_mask(measured, reach, autos).collect()} == expected


def test_no_nested_loop_over_channels(spark, sf_dir):
    axis = baselines.Axis.of(32_768, 1284.0, 856.0)
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    model = part.select((F.col("p_retailprice")).alias("fmin"), (F.col("p_retailprice") + 20).alias("fmax"), (F.col("p_size") * 200.0).alias("max_baseline"))
    reach = baselines.interference_reach(axis, model)
    measured = spark.createDataFrame([(1, "a", "b", 500.0)], "cbf_bl long, ant1 string, ant2 string, length_m double")
    assert "NestedLoop" not in plan_of(baselines.range_mask(measured, reach)) and "Cartesian" not in plan_of(reach)
    edges = [(r["fmin"], r["fmax"], r["max_baseline"]) for r in model.collect()]
    found = {r["channel"]: r["reach"] for r in reach.collect()}
    for c in range(0, axis.n, 997):
        f = axis.first + c * axis.width
        assert found.get(c) == max((m for lo, hi, m in edges if f - axis.width / 2 <= hi and f + axis.width / 2 >= lo), default=None)


def test_planned_masks(spark):
    masked = spark.createDataFrame([(5, 1), (5, 40_000), (2, 40_000), (2, 1), (2, 1), (9, 0), (7, 32_768)], "cbf_bl long, channel int")
    ids, channels = baselines.plan_masks(masked, spark.createDataFrame([(k,) for k in (2, 5, 7, 8, 9)], "cbf_bl long"))
    assert {tuple(r) for r in ids.collect()} == {(2, 2), (5, 2), (7, 7), (8, -1), (9, 9)}
    assert sorted(map(tuple, channels.collect())) == [(2, 1), (2, 40_000), (7, 32_768), (9, 0)]


def test_suspects_of_all_baselines(spark):
    """Nulls, short arrays and inputs without a label say nothing; every baseline of a dump with a reading has a row."""
    base = spark.createDataFrame([(0, "a", "a"), (1, "a", "b"), (2, "b", "c"), (3, "c", "x")], "bl int, input1 string, input2 string")
    sensor = spark.createDataFrame([(1, [True, None, None]), (2, [None, None, None]), (3, [False]), (4, None), (5, [False, False, True]), (5, [False, True, False])], "dump long, suspects array<boolean>")
    got = {(r["dump"], r["bl"]): r["baseline_flags"] for r in sensors.input_suspects(base, ["a", "b", "c"], sensor).collect()}
    bad = {(1, 0), (1, 1), (5, 1), (5, 2), (5, 3)}
    assert got == {(d, b): 4 if (d, b) in bad else 0 for d in (1, 2, 3, 4, 5) for b in range(4)}


def test_packed_counts_equal_plain_ones(spark):
    rng = random.Random(8)
    df = spark.createDataFrame([(k % 3, k % 4, rng.randrange(256)) for k in range(900)], "step long, channel int, flags int")
    packed = df.groupBy("step", "channel").agg(*quicklook.packed_counts())
    plain = quicklook.flag_counts(df, 0, 4, ["step"])
    assert sorted(map(tuple, quicklook.roll_up_counts(packed, ["step"]).collect())) == sorted(map(tuple, plain.collect()))


@pytest.fixture(scope="module")
def parts(spark):
    rng = random.Random(9)
    raw = [(d, c, b, rng.randint(-90, 90), rng.randint(-90, 90)) for d in range(12) for c in range(16) for b in range(3)]
    labels = [(0, "m0h", "m0h", 0), (1, "m0h", "m1h", 0), (2, "m0v", "m1v", 0)]
    return (
        spark.createDataFrame(raw, "dump long, channel int, cbf_bl int, re int, im int"),
        spark.createDataFrame([(b, b) for b in range(3)], "cbf_bl int, bl int"),
        spark.createDataFrame(labels, "bl int, input1 string, input2 string, mask_id int"),
        spark.createDataFrame([(0, 3, 2)], "mask_id int, channel int, mask_flags int"),
    )


def test_two_cadences_from_one_exchange(spark, parts):
    plan = IngestPlan(n_accs=4, n_channels=16, start=4, stop=12, ratio=4, sd_ratio=6, cont_factor=4, sd_cont_factor=2, n_masks=1, guard=2, detector=partial(rfi.detect, n_sigma=3.0, flags="flags"))
    assert plan.step == 2
    flagged = plan.samples(*parts)
    text = plan_of(plan.fine_sums(flagged))
    # One exchange of samples: the windows and the sums of a step need no other. Broadcasts are of dimensions.
    assert text.count(" Exchange hashpartitioning") == 1
    seen = []
    made = plan.build(*parts, base=lambda fine: seen.append(1) or written(fine))
    assert seen == [1] and "Window" not in plan_of(made["sd_spectral"]) and "parquet" in plan_of(made["sd_time_series"])
    samples = made["samples"].cache()
    for name, ratio in (("spectral", 4), ("sd_spectral", 6)):
        direct = average.spectral(samples, ratio, 4)
        assert sorted(map(tuple, made[name].select(*direct.columns).collect())) == sorted(map(tuple, direct.collect()))
    for name, ratio, factor in (("continuum", 4, 4), ("sd_continuum", 6, 2)):
        direct = average.continuum(samples, ratio, factor, 4)
        assert sorted(map(tuple, made[name].select(*direct.columns).collect())) == sorted(map(tuple, direct.collect()))
    counts = quicklook.flag_counts(samples, 4, 12, [average.group_index("dump", 6).alias("out_idx"), "bl"])
    assert sorted(map(tuple, made["sd_flag_counts"].collect())) == sorted(map(tuple, counts.collect()))


def test_totals_are_observed_with_the_product(spark, parts):
    plan = IngestPlan(n_accs=4, n_channels=16, start=4, stop=12, ratio=4, sd_ratio=4, cont_factor=4, sd_cont_factor=2, n_masks=1, detector=None)
    seen, out = Observation(), Observation()
    flagged = metadata.observe_samples(plan.samples(*parts), seen)
    rows = metadata.observe_product(plan.spectral(plan.sums(plan.fine_sums(flagged), 4)), out).collect()
    assert seen.get["n_samples"] == 12 * 8 * 3 and seen.get["bytes_in"] == 8 * 12 * 8 * 3 and (seen.get["first_dump"], seen.get["last_dump"]) == (0, 11)
    assert out.get["n_out"] == len(rows) == 3 * 8 * 3


def test_display_group(spark, parts):
    from visloom.plans import display

    plan = IngestPlan(n_accs=4, n_channels=16, start=4, stop=12, ratio=4, sd_ratio=4, cont_factor=4, sd_cont_factor=2, n_masks=1, detector=None)
    made, labels = plan.build(*parts), [("m0h", "m0h"), ("m0h", "m1h"), ("m0v", "m1v")]
    one = lambda *bl: spark.createDataFrame([(b,) for b in bl], "bl int")
    shown = display.display(plan, made, one(2), one(0), labels, 1284.0, 856.0, 10, 0, 1.0)
    assert set(shown) == set(display.ITEMS) and len(display.ITEMS) == 17
    assert {r["bl"] for r in shown["sd_data_index"].collect()} == {2} and shown["sd_data"].count() == shown["sd_flags"].count() == 3 * 8
    assert shown["sd_blmxdata"].count() == shown["sd_blmxflags"].count() == 3 * 4 * 3
    # A choice out of range leaves the one before.
    assert {r["bl"] for r in display.display(plan, made, one(1, 3), one(0), labels, 1284.0, 856.0, 10, 0, 1.0)["sd_data_index"].collect()} == {0}
    assert [shown[k].first()[k] for k in ("bandwidth", "center_freq", "n_chans", "sd_blmx_n_chans", "frequency")] == [428.0, 1284.0, 8, 4, 0]
    assert display.subband(16, 1284.0, 856.0, 0, 4) == (1284.0 - 6 * 53.5, 4 * 53.5)


def test_channel_sensors_at_the_end_of_dumps(spark, caplog):
    dumps = spark.createDataFrame([(0, 9.0), (1, 19.5), (2, 29.0), (3, 99.0)], "dump long, mid double")
    rows = [(20.0, 1, [True, False, True, None]), (20.0, 2, [False, True, True]), (30.0, 3, [True] * 6)]
    flat = spark.createDataFrame(rows, "ts double, seq long, value array<boolean>")
    expected = {(1, 1), (1, 2), (2, 1), (2, 2), (3, 1), (3, 2), (3, 3)}
    expected = (expected - {(2, 1), (2, 2)}) | {(2, 1), (2, 2), (2, 3)}  # 29 + 0.5 * 2 reaches 30
    assert {tuple(r) for r in sensors.channels_at_dumps(dumps, flat, 1, 4, 2.0).collect()} == expected
    deep = flat.select("ts", "seq", F.array("value", F.array(F.lit(True))).alias("value"))
    assert {tuple(r) for r in sensors.channels_at_dumps(dumps, deep, 1, 4, 2.0).collect()} == expected and "first is used" in caplog.text
