"""Operators over the whole corpus, held against brute force: substrings, decontamination, lines, near-duplicates."""

import hashlib
import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from visloom.llm import components, decontaminate, linededup, neardup, substrings, suffixes

# --- suffixes and substrings ------------------------------------------------------------------------


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.binary(max_size=200), st.text("ab", max_size=200).map(str.encode)))
def test_suffix_array_is_sorted(text):
    text = text.replace(b"\xff", b"\xfe")
    block = np.frombuffer(text, np.uint8)
    order = suffixes.suffix_array(block).tolist()
    assert sorted(order) == list(range(len(text)))
    keys = [text[i : i + suffixes.DEPTH] for i in order]
    assert keys == sorted(keys)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.text("ab", max_size=30), st.integers(0, 4)), min_size=1, max_size=8), st.sampled_from([3, 9]))
def test_covered_starts(rows, length):
    texts, owners = [t.encode() for t, _ in rows], np.array([o for _, o in rows])
    got = suffixes.covered_starts(texts, owners, length)
    for i, t in enumerate(texts):
        assert got[i].tolist() == [s for s in range(len(t) - length + 1) if any(t[s : s + length] in u for j, u in enumerate(texts) if owners[j] < owners[i])]


def brute_substrings(rows, length=50):
    """{(doc_id, text): (n_bytes, n_removed, n_spans, sha256)}; rows without an id cover nothing."""
    held = defaultdict(set)
    for i, t in rows:
        b = (t or "").encode()
        if i is not None:
            for s in range(len(b) - length + 1):
                held[b[s : s + length]].add(i)
    least = {k: min(v) for k, v in held.items()}
    out = {}
    for i, t in rows:
        b = (t or "").encode()
        mark = np.zeros(len(b) + 1, int)
        for s in range(len(b) - length + 1):
            if i is not None and least[b[s : s + length]] < i:
                mark[s] += 1
                mark[s + length] -= 1
        gone = np.cumsum(mark)[:-1] > 0
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out[(i, t)] = (len(b), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


def planted(n=40, seed=5):
    """Short texts that share pieces of each other at all offsets, runs of one character, and copies."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
    base = [" ".join(word() for _ in range(60)) for _ in range(5)] + ["=" * 300, "ab" * 200, "é漢😀" * 60]
    rows = []
    for i in rng.sample(range(1000), n):
        parts = []
        for _ in range(rng.randint(1, 4)):
            t = rng.choice(base)
            a = rng.randint(0, len(t) - 60)
            parts.append(t[a : a + rng.randint(30, 200)])
        rows.append((i, rng.choice([" ", "\n", ""]).join(parts)))
    i, t = rows[3]
    return [*rows, (i, t), (rows[4][0], rows[5][1]), (None, rows[0][1]), (2000, rows[1][1]), (2001, None), (2002, "")]


def check_substrings(spark, rows):
    got = substrings.dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    expected = Counter()
    brute = brute_substrings(rows)
    for row in rows:
        expected[(row[0], *brute[row])] += 1
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got.collect()) == expected


def test_substrings_match_brute_force(spark):
    check_substrings(spark, planted())


def test_substrings_without_broadcast_and_with_anchors_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(substrings, "BROADCAST_ANCHORS", 0)
    monkeypatch.setattr(substrings, "BLOCK_SLICES", 3)
    monkeypatch.setattr(substrings, "BATCH_BYTES", 500)
    check_substrings(spark, planted(30, 6))


def test_filter_of_numbers():
    """A filter lets all of its numbers pass, and few others; its size is bounded."""
    rng = np.random.default_rng(4)
    value = rng.integers(0, 1 << 48, 60_000, dtype=np.uint64)
    for slices in (1, 7):
        size = substrings.Filter.size(len(value), slices)
        own = substrings.Filter(np.concatenate([substrings.Filter.slice(value[value % np.uint64(slices) == k], size) for k in range(slices)]), slices)
        assert own.among(value).all() and own.among(rng.integers(0, 1 << 48, 60_000, dtype=np.uint64)).mean() < 0.01
    assert substrings.Filter.size(10**12, 7) * 7 <= substrings.FILTER_BYTES and not own.among(value[:0]).size


def test_anchors_of_texts():
    """Each pair of an anchor and a text once, with empty texts between and more texts than a piece holds."""
    texts = [b"", b"x" * 80, b"short", b"", b"x" * 80 + bytes(range(60, 180)), *[b""] * 70_000, bytes(range(60, 180)), b""]
    got = Counter((int(v), int(t)) for values, numbers in substrings.text_anchors(texts) for v, t in zip(values, numbers, strict=True))
    assert set(got.values()) == {1} and set(got) == {(int(v), t) for t, x in enumerate(texts) for v in substrings.anchors(np.frombuffer(x, np.uint8))}


def test_substrings_with_a_filter_that_lets_others_pass(spark, monkeypatch):
    monkeypatch.setattr(substrings, "FILTER_BYTES", 8)
    monkeypatch.setattr(substrings, "PIECE_BYTES", 300)
    check_substrings(spark, planted(30, 7))


def test_many_shared_anchors_are_not_joined_to_documents(spark, monkeypatch):
    """More of them than one array could hold before are sent as a filter, and neither documents nor segments move for it."""
    monkeypatch.setattr(substrings.Filter, "size", staticmethod(lambda n, slices: 64))
    rows = spark.createDataFrame([(k, k, b"y" * 40 + bytes(range(60, 180))) for k in range(3)], "owner long, tag long, data binary")
    shared = substrings.shared_anchors(rows, 2).withColumn("n", F.lit(20_000_000).cast("long"))
    look = substrings._Lookup(rows, shared, 2)
    assert "Exchange" not in look.rows._jdf.queryExecution().executedPlan().toString() and look.filter is not None


def test_substrings_on_documents(spark, docs, doc_rows):
    brute = brute_substrings(doc_rows)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in substrings.dedup(docs).collect()}
    assert got == {i: brute[(i, t)] for i, t in doc_rows}


def test_substrings_edges(odd, empty):
    assert substrings.dedup(odd).count() == odd.count()
    assert substrings.dedup(empty).count() == 0


# --- decontamination --------------------------------------------------------------------------------


def test_retrieval_equals_exhaustive_scores():
    rng = random.Random(2)
    vocab = [f"w{k}" for k in range(60)]
    items = [(k, " ".join(rng.choice(vocab[: rng.choice([5, 60])]) for _ in range(rng.randint(1, 15)))) for k in range(70)]
    frequency = Counter(w for _, t in items for w in set(t.split()))
    index = decontaminate.build(items, frequency, len(items), 8.0, 64)
    passages = [rng.sample(vocab, rng.randint(1, 40)) for _ in range(60)]
    rows = [(p, index.terms[w]) for p, words in enumerate(passages) for w in words if w in index.terms]
    for threshold in (0.2, 0.5, 0.9):
        p, i, s = index.retrieve(np.array([a for a, _ in rows]), np.array([b for _, b in rows]), threshold)
        got = {(a, b): c for a, b, c in zip(p.tolist(), i.tolist(), s.tolist(), strict=True)}
        full = defaultdict(float)
        for a, term in rows:
            for k in range(index.run_at[index.block_at[term]], index.run_at[index.block_at[term + 1]]):
                full[(a, int(index.items[k]))] += index.impacts[k]
        wanted = {k: v for k, v in full.items() if v >= threshold - 1e-9}
        assert got.keys() == wanted.keys() and all(abs(got[k] - v) < 1e-9 for k, v in wanted.items())


def test_decontamination_finds_planted_items(spark, docs, doc_rows, sf_dir):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = [(r["item_id"], decontaminate.words_of(r["text"])) for r in benchmark.collect()]
    texts = {i: " ".join(["", *decontaminate.words_of(t), ""]) for i, t in doc_rows}
    expected = {(i, k) for i, t in texts.items() for k, words in items if words and f" {' '.join(words)} " in t}
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(docs, benchmark).collect()}
    assert expected and got == expected
    clean = decontaminate.keep_clean(docs, benchmark)
    assert clean.columns == docs.columns and {r["doc_id"] for r in clean.collect()} == set(texts) - {i for i, _ in expected}


def test_decontamination_shards_agree(spark, docs, sf_dir, monkeypatch):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    whole = Counter((r["doc_id"], r["item_id"], round(r["score"], 6)) for r in decontaminate.matches(docs, benchmark).collect())
    shards = list(decontaminate.indexes(benchmark, shard_bytes=3000))
    assert len(shards) > 1
    parts = Counter()
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for index in shards:
        parts.update((texts[n][0], i, round(s, 6)) for n, i, s in decontaminate.found([t for _, t in texts], index))
    assert parts == whole
    assert whole == Counter((r["doc_id"], r["item_id"], round(r["score"], 6)) for r in decontaminate.matches(docs, benchmark, shard_bytes=12_000).collect())
    assert {r["doc_id"] for r in decontaminate.keep_clean(docs, benchmark, shard_bytes=12_000).collect()} == {i for i, _ in texts} - {i for i, _, _ in whole}


def test_decontamination_edges(spark, odd, empty):
    item = "The quick brown fox jumps over the lazy dog near the old river bank today. A second line of words."
    benchmark = spark.createDataFrame([(1, item), (2, None), (3, ""), (1, item), (4, "...")], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(odd, benchmark).collect()} == {(1, 1), (2, 1)}
    kept = decontaminate.keep_clean(odd, benchmark)
    assert kept.columns == odd.columns and 1 not in {r["doc_id"] for r in kept.collect()} and kept.count() == odd.count() - 3
    assert decontaminate.matches(empty, benchmark).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.matches(odd, none).count() == 0 and decontaminate.keep_clean(odd, none).count() == odd.count()
    half = "The quick brown fox jumps over the lazy dog."
    assert decontaminate.question_and_answer("One two. Three?\nFour five!") == (["one", "two", "three"], ["four", "five"])
    assert decontaminate.overlap(decontaminate.words_of(item), decontaminate.words_of(half)) < 0.5


def test_decontamination_by_items_without_an_id(spark, odd):
    item = "The quick brown fox jumps over the lazy dog near the old river bank today. A second line of words."
    benchmark = spark.createDataFrame([(None, item), (None, "Something else that no document has in it. Nor this."), (None, None)], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(odd, benchmark).collect()} == {(1, None), (2, None)}
    kept = decontaminate.keep_clean(odd, benchmark)
    assert not {1, 2} & {r["doc_id"] for r in kept.collect()} and kept.count() == odd.count() - 3


# --- line dedup -------------------------------------------------------------------------------------


def brute_lines(rows):
    """{row: kept text}: the first (doc_id, chunk number) of equal chunks stays."""
    first = {}
    for i, t in rows:
        if i is not None:
            for no, _, chunk in linededup._parts(t):
                first[chunk] = min(first.get(chunk, (i, no)), (i, no))
    out = {}
    for i, t in rows:
        gone = {no for no, _, chunk in linededup._parts(t) if i is not None and first[chunk] != (i, no)}
        out[(i, t)] = linededup.strip(t, gone)[0]
    return out


def line_rows(seed=3):
    rng = random.Random(seed)
    line = lambda: " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "Ω", ""]) for _ in range(3))
    pool = [[line() for _ in range(rng.randint(4, 12))] for _ in range(4)]
    rows = [(i, "\n".join([line() for _ in range(rng.randint(0, 3))] + rng.choice(pool) + [line() for _ in range(rng.randint(0, 3))])) for i in range(40)]
    return [*rows, rows[0], (50, None), (51, ""), (52, "\n\n\n"), (None, rows[1][1]), (53, rows[1][1])]


@pytest.mark.parametrize("bound", [linededup.BROADCAST_DOCS, 0])
def test_line_dedup_matches_brute_force(spark, monkeypatch, bound):
    monkeypatch.setattr(linededup, "BROADCAST_DOCS", bound)
    rows = line_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    brute = brute_lines(rows)
    assert any((brute[r] or "") != (r[1] or "") for r in rows)
    got = Counter((r["doc_id"], r["text"]) for r in linededup.remove_repeats(df).collect())
    assert got == Counter((r[0], brute[r]) for r in rows)
    reported = Counter((r["doc_id"], r["kept_sha256"]) for r in linededup.report(df).collect())
    assert reported == Counter((r[0], hashlib.sha256((brute[r] or "").encode()).hexdigest()) for r in rows)


def test_chunk_boundaries_resist_shifts():
    rng = random.Random(4)
    lines = [f"line {rng.random()}" for _ in range(200)]
    cut = lambda x: {"\n".join(x[a:b]) for a, b, _ in linededup.chunks("\n".join(x))}
    assert len(cut(lines) & cut(["new", *lines])) >= len(cut(lines)) - 2
    assert max(b - a for a, b, _ in linededup.chunks("same\n" * 1000)) <= linededup.MOST_LINES


def test_line_dedup_on_documents_and_edges(docs, doc_rows, odd, empty):
    brute = brute_lines(doc_rows)
    got = {r["doc_id"]: r["text"] for r in linededup.remove_repeats(docs).collect()}
    assert got == {i: brute[(i, t)] for i, t in doc_rows}
    kept = linededup.remove_repeats(odd, drop_emptied=True)
    assert kept.columns == odd.columns and kept.count() <= odd.count()
    assert {r["doc_id"] for r in kept.collect()} >= {1, 3, 4, 5, 6, 7, 8}
    assert linededup.remove_repeats(empty).count() == 0 and linededup.report(empty).count() == 0


def brute_passages(rows):
    """{doc_id: kept text}: without the lines of any passage of two or more lines with a word that stands earlier."""
    first, passages = {}, []
    for i, t in sorted(rows):
        lines = t.split("\n")
        worded = [k for k, line in enumerate(lines) if line.strip()]
        for a, b in itertools.combinations(worded, 2):
            passages.append((i, a, b, "\n".join(lines[a : b + 1])))
            first.setdefault(passages[-1][3], (i, a))
    away = {(i, k) for i, a, b, p in passages if first[p] < (i, a) for k in range(a, b + 1)}
    return {i: "\n".join(line for k, line in enumerate(t.split("\n")) if (i, k) not in away) for i, t in rows}


def long_line(rng):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 8))) for _ in range(rng.randint(18, 40)))


def test_line_dedup_removes_whole_repeated_passages(spark):
    """Passages of 2 to 4 long lines, each in two documents between other lines, some with blank lines."""
    rng = random.Random(8)
    rows, planted = [], []
    for k in range(30):
        passage = "\n".join(rng.choice(["", "\n"]) + long_line(rng) for _ in range(rng.randint(2, 4))).strip("\n")
        planted.append(passage)
        for i in (k, 100 + k):
            rows.append((i, "\n".join([long_line(rng) for _ in range(rng.randint(0, 4))] + [passage] + [long_line(rng) for _ in range(rng.randint(0, 4))])))
    rows += [(300, "one\none\none\ntwo"), (301, "two\n" + rows[0][1].split("\n")[0])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in linededup.remove_repeats(df).collect()}
    assert got == brute_passages(rows)
    assert all(p in got[k] and not set(p.split("\n")) - {""} & set(got[100 + k].split("\n")) for k, p in enumerate(planted))


def test_line_dedup_leaves_no_stubs_of_copies(spark, sf_dir, docs, doc_rows):
    """Exact copies of several lines are dropped by the pipeline's stage, near copies keep their own lines, and no line is lost."""
    lines_of = lambda t: [line for line in (t or "").split("\n") if line.strip()]
    several = [(i, t) for i, t in doc_rows if len(set(lines_of(t))) >= 5]
    top = max(i for i, _ in doc_rows)
    exact = {top + 1 + k: t for k, (_, t) in enumerate(several)}
    near = {2 * top + len(several) + k: "\n".join([*t.split("\n")[:-1], f"own line {k}"]) for k, (_, t) in enumerate(several)}
    rows = [*doc_rows, *exact.items(), *near.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup(spark, df, sf_dir).collect()}
    assert several and not exact.keys() & got.keys()
    assert all(lines_of(got[i]) == lines_of(t)[-1:] for i, t in near.items())
    assert {x for t in got.values() for x in lines_of(t)} == {x for _, t in rows for x in lines_of(t)}


# --- near-duplicates --------------------------------------------------------------------------------


def brute_near(rows, size, percent):
    sets = {}
    for i, t in rows:
        w = (t or "").translate({k: k + 32 for k in range(65, 91)}).encode().split()
        sets.setdefault(i, set(zip(*(w[k:] for k in range(size)), strict=False)) if len(w) >= size else {tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(sorted(i for i, s in sets.items() if s), 2):
        x, y = sets[a], sets[b]
        if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)) and 100 * len(x & y) >= percent * len(x | y):
            p, q = top(a), top(b)
            parent[max(p, q)] = min(p, q)
    return {i: (len(s), top(i)) for i, s in sets.items()}


def near_rows(seed=9, groups=3, copies=25):
    """Groups of copies with edits, near and beyond the threshold, so that chains of links matter."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    rows = []
    for _ in range(groups):
        base = [word() for _ in range(60)]
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randint(0, 9)):
                w[rng.randrange(len(w))] = word()
            rows.append(" ".join(w))
    rows += [" ".join(word() for _ in range(50)) for _ in range(10)] + [rows[0].upper(), "one", "ONE", "two", "", None, " "]
    return list(zip(rng.sample(range(10_000), len(rows)), rows, strict=True))


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_match_brute_force(spark, size):
    rows = near_rows()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=size).collect()}
    assert got == brute_near(rows, size, 80)


def test_near_duplicates_by_the_exact_rest(spark, monkeypatch):
    """Heavily edited copies lie apart from their pivots, and sets are joined by shuffle."""
    monkeypatch.setattr(neardup, "BROADCAST_IDS", 0)
    rows = near_rows(11, 2, 40)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    brute = brute_near(rows, 2, 80)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(df, size=2).collect()} == brute
    assert {r["doc_id"] for r in neardup.keep_first(df, size=2).collect()} == {i for i, (_, c) in brute.items() if i == c}


@pytest.mark.parametrize("size", [2, 5])
def test_bounds_leave_every_link_to_the_outside(spark, size):
    """With each member a component of its own in one cell, the candidates hold all links, and not nearly all pairs."""
    rows = [(i, t) for i, t in near_rows(13, 2, 40) if t and t.strip()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    classes = neardup.classes_of(neardup.signatures(df, size))
    cell = min(r["rep"] for r in classes.collect())
    cells = classes.selectExpr(f"CAST({cell} AS BIGINT) AS cell", "rep", "rep AS component", "n_shingles AS n")
    found = {tuple(sorted((r["x"], r["y"]))) for r in neardup._candidates(cells, df, size, 80).collect()}
    sets = {r["id"]: np.frombuffer(r["shingles"], "<u8") for r in neardup.shingle_sets(df, classes.selectExpr("rep AS id"), size).collect()}
    every = set(itertools.combinations(sorted(sets), 2))
    links = {(a, b) for a, b in every if neardup.similar(sets[a], sets[b], 80)}
    assert links and links <= found and len(found) < len(every) / 2


def spread_rows(m, seed=4):
    """Edits of one text, of which few pairs reach the threshold and most come to about half."""
    rng = random.Random(seed)
    out = []
    for k in range(m):
        words = [f"b{i}" for i in range(200)]
        for at in rng.sample(range(200), rng.randint(6, 27)):
            words[at] = f"e{k}x{at}"
        out.append((k, " ".join(words)))
    return out


def reachable(links):
    """Smallest node that each node is linked with, by way of others too."""
    parent = {x: x for link in links for x in link}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        p, q = sorted((top(a), top(b)))
        parent[q] = p
    return {x: top(x) for x in parent}


def test_candidates_grow_with_links_not_with_pairs(spark):
    """Groups of near copies most of whose pairs lie below the threshold: candidates stay near the links."""
    for m in (100, 200, 400):
        df = spark.createDataFrame(spread_rows(m), "doc_id long, text string")
        cells = neardup.classes_of(neardup.signatures(df, 2)).selectExpr("0L AS cell", "rep", "rep AS component", "n_shingles AS n")
        found = {tuple(sorted((r["x"], r["y"]))) for r in neardup._candidates(cells, df, 2, 80).collect()}
        sets = {r["id"]: np.frombuffer(r["shingles"], "<u8") for r in neardup.shingle_sets(df, cells.selectExpr("rep AS id"), 2).collect()}
        links = {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if neardup.similar(sets[a], sets[b], 80)}
        # a certain pair may be left to the links of both with the lightest member
        assert reachable(links & found) == reachable(links) and len(found) <= 2 * len(links) + m


def test_near_duplicates_edges(odd, empty):
    rows = neardup.near_duplicates(odd, size=2).collect()
    got = {r["doc_id"]: r.asDict() for r in rows}
    assert len(rows) == odd.count() and got[2]["component_id"] == 1 and not got[2]["kept"]
    assert all(got[i]["n_shingles"] == 0 and got[i]["kept"] and got[i]["component_id"] == i for i in (3, 4, 5))
    assert got[None]["component_id"] is None and got[None]["kept"]
    kept = neardup.keep_first(odd, size=2)
    assert kept.columns == odd.columns and 2 not in {r["doc_id"] for r in kept.collect()}
    assert neardup.near_duplicates(empty).count() == 0 and neardup.keep_first(empty).count() == 0


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(50)]
    parent = {}

    def top(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        p, q = top(a), top(b)
        parent[max(p, q)] = min(p, q)
    got = {r["node"]: r["component"] for r in components.connected(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got.get(x, x) == top(x) for e in edges for x in e)
    assert components.connected(spark.createDataFrame([], "u long, v long")).count() == 0
