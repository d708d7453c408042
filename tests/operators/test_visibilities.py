"""Operators on samples against plain Python models, and the anchors of the domain."""

import math
import random
import statistics
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from visloom.constants import CAM, DATA_LOST, INT32_MIN, STATIC
from visloom.operators import average, baselines, cadence, frames, metadata, quicklook, rfi, samples, sensors
from visloom.plans.ingest import IngestPlan

SAMPLE = "dump long, channel int, bl int, re int, im int, flags int"


def rows(df, *keys):
    return {tuple(r[k] for k in keys): r.asDict() for r in df.collect()}


def random_samples(n_dumps=7, n_channels=8, n_bl=3, seed=1):
    rng = random.Random(seed)
    return [(d, c, b, rng.randint(-50, 50), rng.randint(-50, 50), rng.choice([0, 0, 2, 16, 18])) for d in range(n_dumps) for c in range(n_channels) for b in range(n_bl)]


def model_average(cells, n_accs, excise):
    out = {}
    for key, own in cells.items():
        clear = [s for s in own if s[2] == 0]
        use = (clear or own) if excise else own
        flags = 0
        for s in use:
            flags |= s[2]
        out[key] = (sum(s[0] for s in use) / n_accs / len(use), sum(s[1] for s in use) / n_accs / len(use), n_accs * len(use), flags)
    return out


@pytest.mark.parametrize("excise", [True, False])
@pytest.mark.parametrize("factor", [None, 4])
def test_average(spark, excise, factor):
    data = random_samples()
    df = spark.createDataFrame(data, SAMPLE)
    cells = defaultdict(list)
    for d, c, b, re, im, f in data:
        cells[(d // 3, c // (factor or 1), b)].append((re, im, f))
    got = rows(average.continuum(df, 3, factor, 16, excise), "out_idx", "cont_channel", "bl") if factor else rows(average.spectral(df, 3, 16, excise), "out_idx", "channel", "bl")
    expected = model_average(cells, 16, excise)
    assert got.keys() == expected.keys()
    for k, e in expected.items():
        assert tuple(got[k][c] for c in ("re", "im", "weight", "flags")) == pytest.approx(e)


def test_rolled_up_sums_equal_direct_ones(spark):
    df = spark.createDataFrame(random_samples(), SAMPLE)
    direct = rows(average.continuum(df, 3, 4, 16), "out_idx", "cont_channel", "bl")
    fine = average.partials(df, [average.group_index("dump", 3).alias("out_idx"), "channel", "bl"])
    rolled = average.roll_up(fine, ["out_idx", average.group_index("channel", 4).cast("int").alias("cont_channel"), "bl"])
    assert rows(average.finalise(rolled, ["out_idx", "cont_channel", "bl"], 16), "out_idx", "cont_channel", "bl") == direct


def test_prepare_and_flags(spark):
    raw = spark.createDataFrame([(0, 0, 0, INT32_MIN, 5), (0, 1, 0, 0, 0), (0, 2, 0, 0, 3), (0, 3, 1, 4, 4), (0, 3, 2, 4, 4)], "dump long, channel int, cbf_bl int, re int, im int")
    perm = spark.createDataFrame([(0, 1), (1, 0)], "cbf_bl int, bl int")
    base = spark.createDataFrame([(0, 9), (1, 0)], "bl int, mask_id int")
    masks = spark.createDataFrame([(0, 2, 2), (1, 3, 2), (1, 2, 2)], "mask_id int, channel int, mask_flags int")
    got = rows(samples.flag(samples.reorder(samples.prepare(raw), perm), base, masks, 2), "bl", "channel")
    assert {k: (r["re"], r["im"], r["flags"]) for k, r in got.items()} == {(1, 0): (0, 0, CAM | DATA_LOST), (1, 1): (0, 0, CAM), (1, 2): (0, 3, 2), (0, 3): (4, 4, 2)}


def test_compress_weights(spark):
    rng = random.Random(2)
    data = [(0, c, b, rng.uniform(0.01, 1000)) for c in range(5) for b in range(6)] + [(0, 9, b, 0.0) for b in range(3)]
    for r in average.compress_weights(spark.createDataFrame(data, "out_idx long, channel int, bl int, weight double")).collect():
        top = max(2.0**-96, max(w for _, c, _, w in data if c == r["channel"])) / 255
        assert r["weight_channel"] == top and r["weight_u8"] == math.floor(r["weight"] / top + 0.5) <= 255


def test_flag_counts_and_fractions(spark):
    data = random_samples()
    counts = quicklook.flag_counts(spark.createDataFrame(data, SAMPLE), 2, 6, ["bl"])
    for r in counts.collect():
        own = [f & 191 for d, c, b, _, _, f in data if b == r["bl"] and 2 <= c < 6]
        assert [r[f"c{k}"] for k in range(8)] == [sum(f >> k & 1 for f in own) for k in range(8)] and r["any_count"] == sum(f != 0 for f in own)
    fractions = rows(quicklook.flag_fractions(counts, ["bl"], 10, 4), "bl")
    assert all(fractions[(r["bl"],)]["f1"] == r["c1"] / 40 for r in counts.collect())


def test_percentiles(spark):
    rng = random.Random(3)
    data = [(0, c, b, rng.uniform(-5, 5), rng.uniform(-5, 5), rng.choice([0, 4])) for c in range(3) for b in range(7)]
    groups = [(b, "all") for b in range(7)] + [(b, "few") for b in range(2)]
    df = spark.createDataFrame(data, "out_idx long, channel int, bl int, re double, im double, flags int")
    got = rows(quicklook.percentiles(df, spark.createDataFrame(groups, "bl int, grp string"), ["all", "few", "none"]), "channel", "grp")
    for (c, g), r in got.items():
        own = sorted(math.sqrt(re * re + im * im) for _, ch, b, re, im, _ in data if ch == c and (b, g) in groups)
        if own:
            assert [r[p] for p in ("p_min", "p_max", "p_25", "p_75", "p_50")] == pytest.approx([own[math.floor(p * (len(own) - 1))] for p in (0, 1, 0.25, 0.75, 0.5)])
        else:
            assert math.isnan(r["p_50"]) and r["flags"] == 0


def test_time_series_and_custom_signals(spark):
    df = spark.createDataFrame([(0, c, b, float(c + b), 0.0) for c in range(4) for b in range(2)], "out_idx long, channel int, bl int, re double, im double")
    got = rows(quicklook.time_series(df, quicklook.default_weights(spark, 4, 1, 3)), "bl")
    assert got[(0,)]["re"] == pytest.approx(3 / 4) and got[(1,)]["abs"] == pytest.approx(5 / 4)
    ids = lambda *x: spark.createDataFrame([(k,) for k in x], "bl int")
    chosen = lambda w: {r["bl"] for r in quicklook.custom_signals(df, w, ids(1), 2).collect()}
    assert chosen(ids(0)) == {0} and chosen(ids(0, 7)) == {1}


# --- detection --------------------------------------------------------------------------------------


def test_detector_against_model(spark):
    rng = random.Random(4)
    spectrum = [10 + rng.gauss(0, 1) for _ in range(60)]
    spectrum[20], spectrum[41] = 80.0, 55.0
    flags = [16 if c in (5, 21) else 0 for c in range(60)]
    df = spark.createDataFrame([(0, c, a, f) for c, (a, f) in enumerate(zip(spectrum, flags, strict=True))], "bl int, channel int, amp double, flags int")
    dev = []
    for c in range(60):
        near = [spectrum[k] for k in range(max(0, c - 6), min(60, c + 7)) if flags[k] == 0]
        dev.append(spectrum[c] - statistics.median(near))
    noise = 1.4826 * statistics.median(abs(x) for x, f in zip(dev, flags, strict=True) if x and not f)
    got = rows(rfi.detect(df, ["bl"], flags="flags"), "channel")
    assert {c for (c,), r in got.items() if r["rfi"]} == {c for c in range(60) if dev[c] > 11 * noise} == {20, 41}
    assert all(r["dev"] == pytest.approx(dev[c]) for (c,), r in got.items())
    guarded = rows(rfi.detect_guarded(df.drop("flags"), ["bl"], 15, 30, 64), "channel")
    assert {c for c, in guarded} == set(range(15, 30)) and guarded[(20,)]["rfi"] == 16
    summed = rows(rfi.threshold_sum(rfi.noise(rfi.deviation(rfi.background(df, ["bl"])), ["bl"]), ["bl"]), "channel")
    assert summed[(20,)]["rfi"] == 16 and summed[(41,)]["rfi"] == 16


def test_all_zero_spectra_have_no_interference(spark):
    df = spark.createDataFrame([(b, c, 0.0) for b in range(2) for c in range(20)], "bl int, channel int, amp double")
    assert rfi.detect(df, ["bl"]).where("rfi <> 0").count() == 0


# --- baselines --------------------------------------------------------------------------------------


def test_baseline_order_and_groups(spark):
    names = [("m1v", "m2v"), ("m1v", "m2h"), ("m1h", "m2h"), ("m2h", "m2h"), ("m1h", "m1h"), ("m1h", "m1v"), ("m2v", "m2v"), ("m2h", "m1h"), ("m1v", "m1v")]
    df = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(names)], "cbf_bl int, input1 string, input2 string")
    order = sorted(baselines.order(df).collect(), key=lambda r: r["bl"])
    assert [r["cbf_bl"] for r in order] == [3, 4, 6, 8, 5, 2, 0, 1]
    assert [r["cbf_bl"] for r in sorted(baselines.order(df, ["m1"]).collect(), key=lambda r: r["bl"])] == [4, 8, 5]
    grouped = defaultdict(set)
    for r in baselines.groups(df, "cbf_bl").collect():
        grouped[r["grp"]].add(r["cbf_bl"])
    assert grouped["autohh"] == {3, 4} and grouped["autohv"] == {5} and grouped["crosshv"] == {1} and grouped["cross"] == {0, 1, 2, 7}
    ants = spark.createDataFrame([(k, f"m{k}", 3.0 * k, 4.0 * k, 0.0) for k in range(3)], "number int, antenna string, east double, north double, up double")
    made = baselines.generate(ants)
    assert made.count() == 6 * 4
    assert {r["length_m"] for r in baselines.lengths(made, ants).collect()} == {0.0, 5.0, 10.0}


def test_masks(spark):
    axis = baselines.channel_axis(spark, 8, 100.0, 8.0)
    assert [r["frequency"] for r in axis.orderBy("channel").collect()] == [96.0 + k for k in range(8)]
    assert [r["frequency"] for r in baselines.channel_axis(spark, 8, 100.0, 8.0, 4).collect()] == [97.5, 101.5]
    model = spark.createDataFrame([(98.6, 99.2, 50.0), (101.0, 101.0, float("inf"))], "fmin double, fmax double, max_baseline double")
    reach = rows(baselines.interference_reach(axis, model), "channel")
    assert {c: r["reach"] for (c,), r in reach.items()} == {3: 50.0, 5: float("inf")}
    measured = spark.createDataFrame([(0, "a", "a", 0.0), (1, "a", "b", 40.0), (2, "a", "c", 90.0)], "cbf_bl int, ant1 string, ant2 string, length_m double")
    masked = baselines.range_mask(measured, baselines.interference_reach(axis, model))
    assert {(r["cbf_bl"], r["channel"]) for r in masked.collect()} == {(1, 3), (1, 5), (2, 5)}
    unique = rows(baselines.unique_masks(masked, measured), "cbf_bl")
    assert {k[0]: (r["mask_id"], r["channels"]) for k, r in unique.items()} == {0: (0, ""), 1: (1, "3,5"), 2: (2, "5")}
    band = spark.createDataFrame([(0.3, 0.4)], "min_fraction double, max_fraction double")
    assert {r["channel"] for r in baselines.band_mask(axis, band, 100.0, 8.0).collect()} == {2, 3}


# --- sensors ----------------------------------------------------------------------------------------


def test_sensor_history(spark):
    history = spark.createDataFrame([("a", 4.0, 0, "hello"), ("a", 6.0, 1, "world"), ("b", 1.0, 2, "x"), ("b", 1.0, 3, "y")], "sensor string, ts double, seq long, value string")
    queries = spark.createDataFrame([("a", t, int(t)) for t in (3.0, 4.0, 5.0, 6.0, 7.0)] + [("b", 1.0, 1), ("c", 1.0, 1)], "sensor string, at double, tag long")
    got = {(r["sensor"], r["at"]): r["value"] for r in sensors.as_of(queries, history, F.lit("none")).collect()}
    assert got == {("a", 3.0): "none", ("a", 4.0): "hello", ("a", 5.0): "hello", ("a", 6.0): "world", ("a", 7.0): "world", ("b", 1.0): "y", ("c", 1.0): "none"}
    late = spark.createDataFrame([("a", t, k) for k, t in enumerate((1.0, 3.0, 2.0, 3.0, 4.0))], "sensor string, ts double, seq long")
    assert sorted(r["seq"] for r in sensors.strictly_newer(late).collect()) == [0, 1, 4]


# --- frames -----------------------------------------------------------------------------------------

#: (frame, item) in order of arrival, for four items a frame and three open frames.
SCRIPT = [(0, 0), (0, 1), (1, 1), (1, 2), (2, 2), (0, 2), (0, 3), (1, 0), (1, 3), (6, 0), (2, 0), (6, 1), (6, 2), (6, 3), (7, 0), (8, 0), (8, 1), (8, 2), (8, 3), (9, 0), (9, 2), (9, 3), (5, 0), (9, 0)]


def test_out_of_order_frames(spark):
    heaps = spark.createDataFrame([(k, "data", 1000 + 10 * f, 4 * i, 100 * f + i) for k, (f, i) in enumerate(SCRIPT)], "arrival_seq long, kind string, ts_raw long, frequency int, payload long")
    classed = frames.classify(heaps, 10, 3, 4, 0, 16)
    got = defaultdict(set)
    for r in frames.items(classed).collect():
        got[r["idx"]].add(r["frequency"] // 4)
    assert dict(got) == {0: {0, 1, 2, 3}, 1: {0, 1, 2, 3}, 2: {2}, 6: {0, 1, 2, 3}, 7: {0}, 8: {0, 1, 2, 3}, 9: {0, 2, 3}}
    assert [r["arrival_seq"] for r in classed.where("reason = 'too-old'").orderBy("arrival_seq").collect()] == [10, 22]
    missing = {r["idx"]: r["n_missing"] for r in frames.completeness(classed, [0, 4, 8, 12]).collect()}
    assert missing == {0: 0, 1: 0, 2: 3, 3: 4, 4: 4, 5: 4, 6: 0, 7: 3, 8: 0, 9: 1}
    filled = rows(frames.fill_lost(classed, [0, 4, 8, 12], 4, DATA_LOST), "idx", "channel")
    assert filled[(2, 8)]["flags"] == 0 and filled[(2, 0)]["flags"] == DATA_LOST and (3, 0) not in filled


def test_two_level_windows_equal_one(spark, monkeypatch):
    rng = random.Random(6)
    raw, wrapped, true = [], [], 1000
    for k in range(200):
        true += rng.randint(-5, 60)
        raw.append(true)
        wrapped.append((k, true % 256))
    monkeypatch.setattr(frames, "BLOCK", 16)
    df = spark.createDataFrame(wrapped, "arrival_seq long, ts_raw long")
    got = [r["ts"] for r in frames.unwrap(df, 8).orderBy("arrival_seq").collect()]
    assert [x - got[0] for x in got] == [x - raw[0] for x in raw]
    tops = [r["top"] for r in frames.running_max(df, F.col("ts_raw"), "top").orderBy("arrival_seq").collect()]
    assert tops == [None] + [max(t for _, t in wrapped[:k]) for k in range(1, 200)]


def test_cadence(spark):
    df = spark.createDataFrame([(k,) for k in range(19)], "dump long")
    assert sorted((r["grp"], r["first"], r["n"]) for r in cadence.groups(df, 8).collect()) == [(0, 0, 8), (1, 8, 8), (2, 16, 3)]


# --- metadata, plans --------------------------------------------------------------------------------


def test_metadata(spark):
    attributes = spark.createDataFrame([("cbf", "a", "1"), ("cbf", "b", "2"), ("i0_x", "a", "3")], "prefix string, key string, value string")
    assert {r["key"]: r["value"] for r in metadata.lookup(attributes, ["i0.x", "cbf"]).collect()} == {"a": "3", "b": "2"}
    new = spark.createDataFrame([("a", 0, "n"), ("c", 2, "late"), ("c", 1, "first")], "key string, seq int, value string")
    assert {r["key"]: r["value"] for r in metadata.write_once(attributes.select("key"), new).collect()} == {"c": "first"}
    with pytest.raises(ValueError):
        metadata.sharded(attributes, 3, 32)
    assert '"name": "x"' in metadata.process_log("x", {"b": 1, "a": 2}, attributes)


def test_plan_validation():
    good = dict(n_accs=1, n_channels=32, start=8, stop=24, ratio=4, sd_ratio=8, cont_factor=8, sd_cont_factor=4, n_masks=1)
    IngestPlan(**good)
    for change in ({"stop": 25}, {"cont_factor": 3}, {"stop": 40}):
        with pytest.raises(ValueError):
            IngestPlan(**good | change)


def test_zero_antenna_raises_cam_only(spark):
    raw = spark.createDataFrame([(d, c, b, 0, 0) for d in range(2) for c in range(4) for b in range(4)], "dump long, channel int, cbf_bl int, re int, im int")
    base = spark.createDataFrame([(b, "m0h", "m0h", 0) for b in range(4)], "bl int, input1 string, input2 string, mask_id int")
    perm = spark.createDataFrame([(b, b) for b in range(4)], "cbf_bl int, bl int")
    masks = spark.createDataFrame([], "mask_id int, channel int, mask_flags int")
    plan = IngestPlan(n_accs=4, n_channels=4, start=0, stop=4, ratio=2, sd_ratio=2, cont_factor=2, sd_cont_factor=2, n_masks=1)
    made = plan.build(raw, perm, base, masks)
    for name in ("spectral", "continuum", "sd_spectral", "sd_continuum"):
        assert {(r["re"], r["im"], r["flags"]) for r in made[name].collect()} == {(0.0, 0.0, CAM)}, name


def test_amplitude_of_extremes(spark):
    """Squares of 32-bit extremes, as integers and as longs."""
    df = spark.createDataFrame([(-2147483648, 2147483647), (46341, 0), (0, 0)], "re int, im int")
    got = [r["a"] for r in df.select(samples.amplitude().alias("a")).collect()]
    assert got == pytest.approx([(2.0**62 + (2.0**31 - 1) ** 2) ** 0.5, 46341.0, 0.0])


def test_input_suspects_and_channel_flags(spark):
    base = spark.createDataFrame([(0, "ah", "ah"), (1, "ah", "bv")], "bl int, input1 string, input2 string")
    sensor = spark.createDataFrame([(0, [True, False]), (1, [False, True]), (2, [None, False]), (3, [False])], "dump long, suspects array<boolean>")
    got = {(r["dump"], r["bl"]): r["baseline_flags"] for r in sensors.input_suspects(base, ["ah", "bv"], sensor).collect()}
    assert {k for k, v in got.items() if v} == {(0, 0), (0, 1), (1, 1)}
    live, sus = spark.createDataFrame([(0, 3)], "dump long, channel int"), spark.createDataFrame([(0, 3), (0, 4)], "dump long, channel int")
    assert {(r["channel"], r["channel_flags"]) for r in sensors.channel_flags(live, sus).collect()} == {(3, STATIC | CAM), (4, CAM)}
    assert {(r["channel"], r["channel_flags"]) for r in sensors.channel_flags(live).collect()} == {(3, STATIC)}
    both = sensors.any_suspects(sensors.input_suspects(base, ["ah", "bv"], sensor), spark.createDataFrame([(2, 1, CAM)], "dump long, bl int, baseline_flags int"))
    assert {(r["dump"], r["bl"]) for r in both.where("baseline_flags > 0").collect()} == {(0, 0), (0, 1), (1, 1), (2, 1)}


def test_base_and_kinds_of_records(spark):
    """An incomplete record sets the base; what cannot be decoded has no time and moves nothing; what lacks an item does."""
    rows = [(0, "bad-heap", 990, 0), (1, "incomplete", 1000, 0), (2, "bad-item", 1030, 0), (3, "data", 1000, 0), (4, "bad-heap", 2000, 0), (5, "data", 1020, 0), (6, "incomplete", None, 0)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "arrival_seq long, kind string, ts_raw long, frequency int, payload long")
    got = {r["arrival_seq"]: (r["idx"], r["reason"], r["moves"]) for r in frames.classify(df, 10, 2, 4, 0, 8).collect()}
    assert got == {0: (None, "bad-heap", False), 1: (0, "incomplete", True), 2: (3, "bad-heap", True), 3: (0, "too-old", False), 4: (None, "bad-heap", False), 5: (2, "ok", True), 6: (None, "incomplete", False)}
    counted = {r["reason"]: r["n"] for r in frames.totals(frames.classify(df, 10, 2, 4, 0, 8), stopped_at=3).collect()}
    assert counted == {"bad-heap": 3, "incomplete": 1, "too-old": 1, "ok": 1}


def test_wraps_before_windows(spark):
    true = [1000, 1010, 1030, 1020, 1040]
    rows = [(k, "metadata" if k == 99 else "data", t % 1024, 0, k) for k, t in enumerate(true)]
    df = spark.createDataFrame(rows, "arrival_seq long, kind string, ts_raw long, frequency int, payload long")
    assert [r["idx"] for r in frames.classify(df, 10, 3, 4, 0, 8, bits=10).orderBy("arrival_seq").collect()] == [0, 1, 3, 2, 4]


def test_autos_in_the_interference_model(spark):
    measured = spark.createDataFrame([(0, "a", "a", 0.0), (1, "a", "b", 10.0)], "cbf_bl int, ant1 string, ant2 string, length_m double")
    reach = spark.createDataFrame([(7, 20.0)], "channel int, reach double")
    assert {r["cbf_bl"] for r in baselines.range_mask(measured, reach).collect()} == {1}
    assert {r["cbf_bl"] for r in baselines.range_mask(measured, reach, mask_autos=True).collect()} == {0, 1}


def test_contiguous_groups_and_series_masks(spark):
    fine = spark.createDataFrame([(0, "a"), (1, "a"), (1, "b")], "bl int, grp string")
    baselines.check_contiguous(fine)
    with pytest.raises(ValueError, match="c"):
        baselines.check_contiguous(fine.union(spark.createDataFrame([(0, "c"), (2, "c")], "bl int, grp string")))
    weights = lambda mask: {r["channel"]: r["ts_weight"] for r in quicklook.series_weights(spark, mask, 4, 1, 3).collect()}
    assert weights([0.5, 0.5, 0.25, 1.0]) == {0: 0.0, 1: 0.5, 2: 0.25, 3: 0.0}
    assert weights([1.0]) == weights(None) == {0: 0.0, 1: 0.25, 2: 0.25, 3: 0.0}


def test_flush_below(spark):
    sums = spark.createDataFrame([(0, 2, 1, -1, 0, 0, 0, 0), (1, 0, 0, 0, 2, 1, 1, 4)], "k int, n_u long, re_u long, im_u long, n_f long, re_f long, im_f long, any_flags int")
    got = {r["k"]: (r["re"], r["im"]) for r in average.finalise(sums, ["k"], 1, flush_below=0.6).collect()}
    assert got == {0: (0.0, 0.0), 1: (0.5, 0.5)}


def test_injected_detector(spark):
    plan = IngestPlan(n_accs=1, n_channels=4, start=0, stop=4, ratio=1, sd_ratio=1, cont_factor=2, sd_cont_factor=2, n_masks=1, detector=lambda df, keys: df.withColumn("rfi", F.when(F.col("channel") == 2, 16).otherwise(0)))
    raw = spark.createDataFrame([(0, c, 0, 5, 5) for c in range(4)], "dump long, channel int, cbf_bl int, re int, im int")
    one = spark.createDataFrame([(0, 0)], "cbf_bl int, bl int")
    masks = spark.createDataFrame([(0, 1, STATIC)], "mask_id int, channel int, mask_flags int")
    base = spark.createDataFrame([(0, "ah", "ah", 0)], "bl int, input1 string, input2 string, mask_id int")
    got = {r["channel"]: r["flags"] for r in plan.samples(raw, one, base, masks, channel_flags=spark.createDataFrame([(0, 3, CAM)], "dump long, channel int, channel_flags int")).collect()}
    assert got == {0: 0, 1: STATIC, 2: 16, 3: CAM}


def test_products_and_attributes(spark, tmp_path, caplog):
    product = spark.createDataFrame([(2, c, 0) for c in range(4)], "out_idx long, channel int, bl int")
    rows = metadata.product_rows(product, 2, 10, 5, 10.0, 4, 2, 100)
    assert {(r["channel"], r["substream"], r["frequency"], r["dump_index"], r["timestamp"]) for r in rows.collect()} == {(c, c // 2, 100 + c // 2 * 2, 2, 5.5) for c in range(4)}
    metadata.write_product(rows, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).where("substream = 1").count() == 2
    with pytest.raises(ValueError):
        metadata.product_attributes(spark, "l0", {"n_chans": 1})
    attributes = spark.createDataFrame([("a_b", k, "1") for k in metadata.SYSTEM_ATTRIBUTES], "prefix string, key string, value string")
    assert set(metadata.system_attributes(attributes, ["a.b"])) == set(metadata.SYSTEM_ATTRIBUTES)
    with pytest.raises(KeyError):
        metadata.system_attributes(attributes.where("key <> 'n_accs'"), ["a.b"])
    assert metadata.optional_model(spark, str(tmp_path / "none"), "a int") is None and "no model" in caplog.text


def test_two_level_sensor_lookup(spark):
    """Buckets of time change no result; histories without a sample in the query's bucket carry the last one."""
    import random

    rng = random.Random(3)
    have = [(rng.randrange(3), float(rng.randrange(60)), k, rng.choice([None, float(k)])) for k in range(80)]
    ask = [(rng.randrange(4), rng.randrange(-5, 70) + 0.5, k) for k in range(50)]
    found = sensors.as_of(spark.createDataFrame(ask, "sensor long, at double, q long"), spark.createDataFrame(have, "sensor long, ts double, seq long, value double"), bucket=7.0)
    best = lambda s, at: max(((t, n, v) for i, t, n, v in have if i == s and t <= at and v is not None), default=(0, 0, None))[2]
    assert {r["q"]: r["value"] for r in found.collect()} == {q: best(s, at) for s, at, q in ask}
