"""Periodic runs, language-model scores and whitening, against brute force and SQL."""

import math
import random
import zlib
from collections import Counter
from fractions import Fraction
from hashlib import sha256

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from visloom.llm import lm, runs, whitening

# --- runs -------------------------------------------------------------------------------------------


def brute_runs(word, least):
    n, out = len(word), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if word[i] != word[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and word[i] == word[i + q]:
                i += 1
            if (length := i - start + q) >= max(least, 2 * q):
                out.setdefault((start, length), q)
    return sorted((s, q, n) for (s, n), q in out.items())


@pytest.mark.parametrize("least", [2, 12])
def test_runs_equal_brute_force(least):
    rng = random.Random(least)
    for _ in range(1500):
        n, letters = rng.randint(0, 60), rng.choice([1, 2, 3, 5])
        word = [rng.randrange(letters) for _ in range(n)]
        if n and rng.random() < 0.5:
            a = rng.randrange(n)
            p = 1 + (n - a) // rng.randint(2, 8)
            word = [word[i if i < a else a + (i - a) % p] for i in range(n)]
        assert [(r.start, r.period, r.length) for r in runs.find(word, least)] == brute_runs(word, least)


def test_runs_of_a_fibonacci_word_and_of_one_word():
    a, b = [0], [0, 1]
    while len(b) < 600:
        a, b = b, b + a
    assert [(r.start, r.period, r.length) for r in runs.find(b, 2)] == brute_runs(b, 2)
    assert runs.find([7] * 50_000) == [runs.Run(0, 50_000, 1)]


def test_refinement_moves_positions_a_logarithmic_number_of_times():
    class Counted(runs._Classes):
        moved = 0

        def _take(self, number, group, length):
            Counted.moved += len(group)
            super()._take(number, group, length)

    n, rng = 4000, random.Random(5)
    for word in ([i % 7 for i in range(n)], [rng.randrange(2) for _ in range(n)]):
        Counted.moved, classes, length = 0, Counted(word), 2
        while classes.splitting:
            length += 1
            classes.refine(length)
        assert Counted.moved <= n * math.log2(n)


def test_runs_agree_with_sql(spark, sf_dir):
    got = runs.op11_runs(spark, sf_dir)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    expected = con.sql(f"SELECT {', '.join(got.columns)} FROM ({runs.sql()})").fetchall()
    assert Counter(map(tuple, got.collect())) == Counter(expected)
    assert any(r[1] for r in expected)


def test_runs_of_odd_rows(spark, odd, empty):
    rows = [r.asDict() for r in runs.digest(runs.map_runs(odd, rewrite=True)).collect()]
    assert len(rows) == 10
    nothing = sha256(b"").hexdigest()
    for r in rows:
        if r["doc_id"] in (3, 4, 5):
            assert (r["n_words"], r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"], r["runs_sha256"], r["collapsed_sha256"]) == (0, 0, None, None, None, None, nothing, nothing)
    long = next(r for r in rows if r["doc_id"] == 7)
    assert (long["n_runs"], long["start"], long["length"], long["period"], long["exponent_milli"]) == (1, 0, 240_000, 8, 30_000_000)
    no_id = next(r for r in rows if r["doc_id"] is None)
    assert (no_id["n_runs"], no_id["length"], no_id["period"]) == (1, 30, 10)
    assert runs.map_runs(empty).count() == 0
    # Two longest runs: the smaller start is told.
    both = [b"a", b"b"] * 6 + [b"x"] + [b"c", b"d"] * 6
    assert runs.find(runs.numbers(both)) == [runs.Run(0, 12, 2), runs.Run(13, 12, 2)]
    assert b" ".join(runs.collapse(both, runs.find(runs.numbers(both)))) == b"a b x c d"


# --- language model ---------------------------------------------------------------------------------


def small_network(seed=0, dtype=np.float64):
    rng = np.random.default_rng(seed)
    net = lm.Network.start(rng.integers(1, 50, 10 + lm.REST).astype(float), state=4, class_size=3)
    for k in ("class", "word"):
        net.weights[k] = rng.normal(0, 0.5, net.weights[k].shape)
    net.weights = {k: v.astype(dtype) for k, v in net.weights.items()}
    return net


def test_gradient_equals_differences():
    rng, net = np.random.default_rng(1), small_network()
    x, y = rng.integers(0, 26, (5, 3)), rng.integers(0, 26, (5, 3))
    x[0], x[3, 1] = net.symbols, net.symbols
    used = np.ones((5, 3), bool)
    used[4, 2] = False
    h = rng.normal(0, 0.3, (4, 3))
    grad, _, total = net.gradient(x, y, used, h)
    loss = lambda: -net.log_probability(lm.places(net.forward(x, h), used), y[used]).mean()
    assert loss() * used.sum() == pytest.approx(-total)
    for k, w in net.weights.items():
        for _ in range(12):
            at = tuple(rng.integers(0, n) for n in w.shape)
            was = w[at]
            w[at] = was + 1e-6
            more = loss()
            w[at] = was - 1e-6
            less = loss()
            w[at] = was
            assert (more - less) / 2e-6 == pytest.approx(grad[k][at], abs=1e-6)


def plain_log(net, symbols):
    """One document, symbol by symbol, by the definitions."""
    w, n = net.weights, net.state
    sigmoid = lambda v: 1 / (1 + np.exp(-v))
    h, before, total = np.zeros(n), net.symbols, 0.0
    for s in symbols:
        read, looped = w["read"][before], h @ w["loop"] + w["loop_bias"]
        update, reset = sigmoid(read[:n] + looped[:n]), sigmoid(read[n : 2 * n] + looped[n : 2 * n])
        h = (1 - update) * np.tanh(read[2 * n :] + reset * looped[2 * n :]) + update * h
        classes = np.exp(h @ w["class"] + w["class_bias"])
        k = int(net.class_of(np.array([s]))[0])
        total += math.log(classes[k] / classes.sum())
        if s < net.words:
            low, high = k * net.class_size, min((k + 1) * net.class_size, net.words)
            inner = np.exp(w["word"][low:high] @ h + w["word_bias"][low:high])
            total += math.log(inner[s - low] / inner.sum())
        before = s
    return total


def test_lanes_score_whole_documents_as_one_by_one():
    rng, net = np.random.default_rng(2), small_network(dtype=np.float32)
    texts = [rng.integers(0, 26, n).astype(np.int32) for n in (1, 1, 70, 3, 9, 64, 8, 200, 2, 16, 17)]
    found = {t.row: t.log for t in lm.score((lm.Text(s, k) for k, s in enumerate(texts)), net, steps=8, lanes=3)}
    assert sorted(found) == list(range(len(texts)))
    for k, s in enumerate(texts):
        assert found[k] == pytest.approx(plain_log(net, s), rel=1e-4)


def test_lanes_end_together(monkeypatch):
    """A long document behind many short ones starts with them, not after them, so that it doesn't go on alone."""
    rng, net, seen = np.random.default_rng(5), small_network(dtype=np.float32), []
    texts = [rng.integers(0, 26, n).astype(np.int32) for n in [*[10] * 120, 400]]
    forward = lm.Network.forward
    monkeypatch.setattr(lm.Network, "forward", lambda self, x, *more: seen.append(x.shape) or forward(self, x, *more))
    assert len(list(lm.score(map(lm.Text, texts), net, steps=8, lanes=4))) == len(texts)
    assert len(seen) == 400 // 8 and set(seen) == {(8, 4)}
    seen.clear()
    assert lm.learn(map(lm.Text, texts), net, steps=8, lanes=4) == sum(map(len, texts)) and len(seen) == 400 // 8


def test_scores_do_not_depend_on_what_is_held(monkeypatch):
    rng, net = np.random.default_rng(6), small_network(dtype=np.float32)
    texts = [rng.integers(0, 26, n).astype(np.int32) for n in rng.integers(1, 40, 60)]
    found = lambda: {t.row: t.log for t in lm.score((lm.Text(s, k) for k, s in enumerate(texts)), net, steps=8, lanes=3)}
    whole = found()
    monkeypatch.setattr(lm, "HELD", 300)
    parts = found()
    assert [parts[k] for k in range(60)] == pytest.approx([whole[k] for k in range(60)], rel=1e-5)


def test_batches_are_gathered(monkeypatch):
    monkeypatch.setattr(lm, "GATHERED", 1000)
    texts = ["a" * n for n in (10, 20, 2000, 30, 300, 300, 300, 300, 5)]
    parts = list(lm.gathered(pa.RecordBatch.from_arrays([pa.array([t])], ["text"]) for t in texts))
    assert [t for p in parts for t in p.column(0).to_pylist()] == texts
    assert [p.num_rows for p in parts] == [2, 1, 4, 2] and list(lm.gathered([])) == []


def test_large_logits():
    """Logits too large for their exponentials give the same as small ones that differ by a constant."""
    rng, net = np.random.default_rng(7), small_network()
    x, y, h = rng.integers(0, 26, (5, 3)), rng.integers(0, 26, (5, 3)), np.zeros((4, 3))
    used = np.ones((5, 3), bool)
    grad, _, total = net.gradient(x, y, used, h)
    for k in ("class_bias", "word_bias"):
        net.weights[k] = net.weights[k] + 2000.0
    more, _, again = net.gradient(x, y, used, h)
    assert again == pytest.approx(total)
    for k, g in grad.items():
        assert np.allclose(g, more[k], atol=1e-9)


def test_probabilities_sum_to_one():
    net = small_network()
    h = np.random.default_rng(3).normal(0, 0.5, (4, 1)).repeat(net.symbols, 1)
    assert np.exp(net.log_probability(h, np.arange(net.symbols))).sum() == pytest.approx(1)


def test_repeated_rows_until_there_are_enough_tokens():
    one, two = np.zeros(4, np.int32), np.zeros(3, np.int32)
    count = lambda items, least: sum(len(t.symbols) for t in lm.repeated(items, least))
    assert (count([one, two], 7), count([one, two], 8), count([one], 10), count([], 5)) == (7, 14, 12, 0)


def brute_scores(rows):
    words = [(i, lm.tokens((t or "").encode()), zlib.crc32((str(i) if i is not None else "").encode()) % 7 == 2) for i, t in rows]
    counts = Counter(w for _, ws, held in words if not held for w in [*ws, None])
    total, distinct = sum(counts.values()), len(counts)
    for i, ws, held in words:
        yield i, held, len(ws) + 1, sum(counts[w] > 0 for w in [*ws, None]), total, sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in [*ws, None])


def compare(got, rows):
    got = sorted(got.collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"], r["n_tokens"]))
    expected = sorted(brute_scores(rows), key=lambda r: (r[0] is None, r[0], r[2]))
    assert [tuple(r)[:5] for r in got] == [e[:5] for e in expected]
    for r, e in zip(got, expected):
        assert r["base_score"] == pytest.approx(e[5], rel=1e-9)
        assert r["score"] <= 0 and math.isfinite(r["score"])
    return got


def test_scores_and_held_out_gain(spark, sf_dir, doc_rows):
    got = compare(lm.op12_lm_scores(spark, sf_dir), doc_rows)
    for held in (True, False):
        assert sum(r["score"] for r in got if r["held_out"] == held) > sum(r["base_score"] for r in got if r["held_out"] == held)


def test_words_beyond_the_list_are_joined(spark, docs, doc_rows):
    """With few listed words nearly all counts come from the join; scores are the same but for rounding."""
    few = compare(lm.score_documents(docs, words=20, listed=25, rounds=0), doc_rows)
    many = compare(lm.score_documents(docs, words=20, rounds=0), doc_rows)
    for a, b in zip(few, many):
        assert a["score"] == pytest.approx(b["score"], rel=1e-9)


def test_all_training_rows_train_the_network(spark, monkeypatch):
    rows = [(k if k % 5 else None, "a b c " * (k % 3)) for k in range(60)]
    texts, seen, average = spark.createDataFrame(rows, "doc_id long, text string"), [], lm._average
    monkeypatch.setattr(lm, "_average", lambda parts: seen.append(sum(r["weight"] for r in parts.collect())) or average(parts))
    lm.train(texts, lm.vocabulary(lm.count_words(texts)), least=0)
    assert len(seen) == lm.ROUNDS and sum(seen) == sum(len(t.split()) + 1 for _, t in rows)


def test_averages_by_groups(spark):
    rng = np.random.default_rng(4)
    vectors, weights = rng.normal(size=(300, 7)), rng.integers(1, 9, 300).astype(float)
    rows = [(k, float(w), (v * w).tobytes()) for k, (v, w) in enumerate(zip(vectors, weights))]
    got = lm._average(spark.createDataFrame(rows, "part long, weight double, vector binary"))
    assert np.allclose(got, np.average(vectors, axis=0, weights=weights))
    assert lm._average(spark.createDataFrame([], "part long, weight double, vector binary")) is None


def test_scores_of_odd_rows(spark, odd, empty):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    compare(lm.score_documents(odd), rows)
    assert lm.score_documents(empty).count() == 0
    # All rows are held out: nothing is known, and each token is as likely as the others.
    alone = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    row = lm.score_documents(spark.createDataFrame([(alone, "a b")], "doc_id long, text string")).first()
    assert (row["n_known"], row["train_tokens"], row["base_score"]) == (0, 0, 0.0) and row["score"] < 0


# --- whitening --------------------------------------------------------------------------------------


def exact(vectors):
    x = [[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    y = [[n * c - s for c, s in zip(v, sums)] for v in x]
    return n, y, [[float(Fraction(sum(v[i] * v[j] for v in y), n**3)) for j in range(len(sums))] for i in range(len(sums))]


def check_whitened(rows, vectors, components):
    n, y, cov = exact([v for _, v in vectors])
    values, axes = np.linalg.eigh(np.array(cov))
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    z = np.array([[float(Fraction(c, n)) for c in v] for v in y]) @ axes / np.sqrt(values)
    found = {(r["vec_id"], r["component"]): r for r in rows}
    signs = {}
    for (vec_id, _), its, values_z in zip(vectors, y, z):
        for k in range(components):
            r = found[vec_id, k + 1]
            assert (r["n"], r["deviation"]) == (n, sum(c * c for c in its))
            assert abs(r["whitened"]) == pytest.approx(abs(values_z[k]), abs=1e-8)
            if abs(values_z[k]) > 1e-6:
                assert signs.setdefault(k, np.sign(r["whitened"] * values_z[k])) == np.sign(r["whitened"] * values_z[k])
            assert r["explained"] == pytest.approx(values[k] / np.trace(cov), rel=1e-9)
            assert r["identity_error"] <= 1e-9
    assert len(rows) == len(vectors) * components


def test_whitening_equals_fractions(spark, sf_dir):
    given = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    check_whitened(whitening.op13_whitening(spark, sf_dir).collect(), given, 8)


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(6)
    good = [(k, [float(c) for c in rng.normal(0, [3, 1, 0.2])]) for k in range(40)]
    good += [(0, good[0][1]), (None, [1e9, -2e9, 0.0])]  # a repeated row, one without an id and far away
    bad = [(90, None), (91, []), (92, [1.0, None, 2.0]), (93, [1.0, math.nan, 2.0]), (94, [1.0, math.inf, 2.0]), (95, [1.0, 2.0]), (96, [1e300, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in [*good, *bad]], "vec_id long, embedding array<double>, component int, x string")
    rows = whitening.whiten(df).collect()
    assert {r["vec_id"] for r in rows} == {i for i, _ in good}
    far = [r for r in rows if r["vec_id"] is None]
    assert far[0]["n"] == 42 and far[0]["deviation"] is None  # beyond 64 bits
    near = df.where("vec_id IS NOT NULL AND vec_id < 90")
    check_whitened([r for r in whitening.whiten(near.dropDuplicates(["vec_id"])).collect()], [g for g in good[:40]], 3)
    for few in (df.limit(0), df.where("vec_id = 3"), df.where("vec_id = 91")):
        assert whitening.whiten(few).count() == 0


def test_residues_reconstruct_wide_integers():
    rng = random.Random(7)
    x = np.array([[rng.randrange(-(1 << 40), 1 << 40) for _ in range(4)] for _ in range(9000)])
    n, sums = len(x), [int(c) for c in x.sum(0)]
    rows = [[n * int(c) - s for c, s in zip(v, sums)] for v in x]
    moduli = whitening.primes(2 * n * max(abs(c) for v in rows for c in v) ** 2)
    parts = [whitening.scatter_residues(x, n, sums, p) for p in moduli]
    for i in range(4):
        for j in range(4):
            assert whitening.reconstruct([int(p[i, j]) for p in parts], moduli) == sum(v[i] * v[j] for v in rows)
