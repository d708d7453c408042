"""Operators that work row by row: licenses, quality, tokens, languages, archives, mixing."""

import math
import random
import re
import statistics
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from visloom.llm import langid, licenses, mixing, quality, tokens, warc


def rows_of(df, key="doc_id"):
    return {r[key]: r.asDict() for r in df.collect()}


# --- licenses ---------------------------------------------------------------------------------------


def base_scan(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places = [(i, label) for phrase, label in licenses.BASE for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def check_scan(df, texts):
    found = rows_of(licenses.scan(df))
    for i, text in texts:
        r = found[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == base_scan(text), i
        assert set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) | {""} and 0 <= r["score"] <= 1
        assert r["labels"] == ",".join(sorted(set(r["labels"].split(","))))


def test_license_base_matches_brute_force(docs, doc_rows, odd):
    check_scan(docs, doc_rows)
    check_scan(odd, [(r["doc_id"], r["text"]) for r in odd.collect()])


LICENSES = {
    1: ("mit license MIT LICENSE, mit license", "mit"),
    2: ("xmit license; mit licenses; Mit-License", "mit"),
    3: ("GNU Lesser General Public License, version 2.1", "gpl,lgpl"),
    4: ("SPDX-License-Identifier: AGPL-3.0-only", "agpl"),
    5: ("Licensed under CC BY-NC-SA 4.0.", "cc-by-nc-sa"),
    6: ("Licensed under CC BY 4.0. Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc"),
    7: ("This is free and unencumbered software released into the public domain.", "unlicense"),
    8: ("no terms at all", ""),
    9: ("Licensed under the Apache License, Version 2.0.", "apache"),
    10: ("mit license " * 3000, "mit"),
}


def test_license_rules(spark):
    assert len(licenses.signature_rules()) > 200
    df = spark.createDataFrame([(i, t) for i, (t, _) in LICENSES.items()], "doc_id long, text string")
    check_scan(df, [(i, t) for i, (t, _) in LICENSES.items()])
    found = rows_of(licenses.scan(df))
    assert {i: r["labels"] for i, r in found.items()} == {i: x for i, (_, x) in LICENSES.items()}
    assert found[9]["n_suppressed"] >= 2 and found[10]["n_base"] == 3000


def test_license_rules_fire_on_their_own_texts(spark):
    """Each rule's first, last and some texts between find the rule behind its gate, and gates change no scan."""
    rows = []
    for n, (_, expression, _, _, _) in enumerate(licenses.signature_rules()):
        inner = expression.removeprefix("(?<= )(?:").removesuffix(")(?= )")
        texts = licenses._matches(inner)
        for t in {texts[k * (len(texts) - 1) // 5] for k in range(6)}:
            t = t.replace("\x00", "3").replace("\x01", "7")
            assert re.fullmatch(inner, t)
            rows.append((len(rows), n, f" of {t} so "))
    df = spark.createDataFrame(rows, "doc_id long, rule int, text string")
    found = df.select("rule", "text", licenses.detections(licenses.F.col("text"), licenses.held_keywords(licenses.F.col("text")))["rule"].alias("fired"))
    assert not [(r["rule"], r["text"]) for r in found.collect() if r["rule"] not in r["fired"]]
    assert rows_of(licenses.scan(df)) == rows_of(licenses.scan(df, gated=False))


def test_license_gates_need_no_word_of_license(spark, docs):
    texts = {
        1: ("It is distributed under the GPL.", "gpl"),
        2: ("Released under CC BY 4.0", "cc-by"),
        3: ("available under CC BY-NC 4.0", "cc-by-nc"),
        4: ("Proprietary and confidential", "proprietary"),
        5: ("SPDX-License-Identifier: BSL-1.0", "boost"),
        6: ("SPDX-License-Identifier: EPL-2.0", "eclipse"),
        7: ("SPDX-License-Identifier: FTL", "freetype"),
        8: ("SPDX-License-Identifier: PSF-2.0", "psf"),
        9: ("code is GPLv3 here, LGPLv2 there, AGPLv3 elsewhere", "agpl,gpl,lgpl"),
    }
    df = spark.createDataFrame([(i, t) for i, (t, _) in texts.items()], "doc_id long, text string")
    assert {i: r["labels"] for i, r in rows_of(licenses.scan(df)).items()} == {i: x for i, (_, x) in texts.items()}
    some = docs.limit(200)
    assert rows_of(licenses.scan(some)) == rows_of(licenses.scan(some, gated=False))


def test_license_rules_have_no_fillers(spark):
    """No SPDX form is made up, and bodies of licenses are found where no title stands."""
    fillers = "bsd berkeley|creative commons by.*|cddl common|gpl general|lgpl (?:lesser|library)|mit granted|mpl mozilla|proprietary rights|unlicense unencumbered|"
    rules = licenses.signature_rules()
    assert not [r[1] for r in rules if re.fullmatch(f"spdx license identifier (?:{fillers})", r[1].removeprefix("(?<= )(?:").removesuffix(")(?= )"))]
    assert len(rules) == 3 * len(licenses.FAMILIES) + sum(bool(f[2]) for f in licenses.FAMILIES) + len(licenses.BODIES)
    texts = {
        1: ("Redistributions of source code must retain the above copyright\n   notice, this list of conditions", "bsd"),
        2: ("Altered source versions must be plainly marked as such, and", "zlib"),
        3: ("you may not use this file except in compliance with the License.", "apache"),
    }
    df = spark.createDataFrame([(i, t) for i, (t, _) in texts.items()], "doc_id long, text string")
    assert {i: r["labels"] for i, r in rows_of(licenses.scan(df)).items()} == {i: x for i, (_, x) in texts.items()}


# --- quality ----------------------------------------------------------------------------------------


def base_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in twice for k in range(5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def test_quality_statistics(spark, docs, odd, doc_rows, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    forest = quality.fit(docs, labels)
    both = quality.judge(docs, forest).union(quality.judge(odd, forest)).collect()
    expected = [(i, t) for i, t in doc_rows] + [(r["doc_id"], r["text"]) for r in odd.collect()]
    wanted = Counter()
    for i, t in expected:
        s = base_statistics(t)
        wanted[(i, *s, s[0] < 10 or 100 * s[4] > 20 * s[0])] += 1
    assert Counter((r["doc_id"], *(r[c] for c in quality.STATISTICS), r["base_failed"]) for r in both) == wanted
    assert not any(r["kept"] and r["base_failed"] for r in both)
    kept = {r["doc_id"]: r["kept"] for r in both}
    good = [kept[r["doc_id"]] for r in labels.collect() if r["quality"] == 1]
    assert statistics.mean(good) > 0.9


def brute_path(x, row, forest, t):
    node = 0
    while forest.feature[t, node] >= 0:
        node = 2 * node + 1 + int(x[row, forest.feature[t, node]] > forest.split[t, node])
    return forest.path[t, node]


def test_forest_isolates_outliers():
    x = np.random.default_rng(0).normal(0.1, 0.02, (600, 4))
    forest = quality.grow(x, trees=40, tree_rows=64)
    probe = np.array([[0.1] * 4, [0.9] * 4, [0.1, 0.1, 0.1, 0.6]])
    mean = [statistics.mean(brute_path(probe, r, forest, t) for t in range(40)) for r in range(3)]
    assert np.allclose(forest.scores(probe), [2 ** (-m / forest.norm) for m in mean])
    assert forest.scores(probe)[0] < forest.scores(probe)[2] < forest.scores(probe)[1]
    clean, low = np.linspace(0.2, 0.4, 1000), np.linspace(0.6, 0.7, 100)
    assert 0.4 <= quality.calibrate(clean, low) <= 0.61 and quality.calibrate(np.zeros(0), low) == float("inf")


def test_quality_separates_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    forest = quality.fit(docs.where("doc_id % 3 <> 0"), labels.where("doc_id % 3 <> 0"))
    got = quality.judge(docs, forest).join(labels.where("doc_id % 3 = 0"), "doc_id").where("NOT base_failed").collect()
    good, low = [r["kept"] for r in got if r["quality"]], [r["kept"] for r in got if not r["quality"]]
    assert statistics.mean(good) > 0.95 and (not low or statistics.mean(low) < 0.3)


def test_quality_edge_tables(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id long, quality int")
    forest = quality.fit(odd, none)
    assert quality.judge(empty, forest).count() == 0 and quality.keep(empty, forest).count() == 0
    kept = quality.keep(odd, forest)
    assert kept.schema == odd.schema and {r["doc_id"] for r in kept.collect()} >= {1, 2}


# --- tokens -----------------------------------------------------------------------------------------


def test_tokens_match_the_library(docs, odd, doc_rows, empty):
    sentencepiece = pytest.importorskip("sentencepiece")
    paths = pytest.importorskip("public_tokenizers")
    model = sentencepiece.SentencePieceProcessor(model_file=str(paths.path(tokens.MODEL)))
    for df, texts in ((docs, doc_rows), (odd, [(r["doc_id"], r["text"]) for r in odd.collect()])):
        # Short parts make splits common.
        found = rows_of(tokens.count_tokens(df, long_bytes=64, batch_bytes=4096))
        for i, t in texts:
            n = len(model.encode(t or ""))
            assert (found[i]["n_bytes"], found[i]["n_tokens"], found[i]["over_limit"]) == (len((t or "").encode()), n, n > 4096)
    assert tokens.count_tokens(empty).count() == 0


def test_tokens_split_at_safe_places():
    for text in ("a  b   c " * 50, "▁a ▁ b" * 40, "x" * 500, " lead " * 60, "é😀 ñ\n b" * 40):
        assert " ".join(tokens.split_long(text, 10)) == text
    assert tokens.split_long("x" * 500, 10) == ["x" * 500]


# --- languages --------------------------------------------------------------------------------------


def test_language_held_out_accuracy(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = rows_of(langid.predict(df, langid.fit(df)))
    truth = {r["doc_id"]: r["lang"] for r in df.collect()}
    out = [found[i]["lang_pred"] == lang for i, lang in truth.items() if found[i]["held_out"]]
    assert len(out) > 150 and statistics.mean(out) > 0.98
    import zlib

    assert all(found[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in truth)


def test_language_edges(odd, empty, docs):
    model = langid.fit(docs)
    found = rows_of(langid.predict(odd, model))
    assert all(found[i]["lang_pred"] == "und" and found[i]["score"] == 0 for i in (3, 4, 5))
    assert all(found[i]["lang_pred"] in model.languages and 0 <= found[i]["score"] <= 1 for i in (1, 6, 7, 8))
    assert langid.predict(empty, model).count() == 0
    assert {r["lang_pred"] for r in langid.predict(odd, langid.fit(empty)).collect()} == {"und"}


# --- mixing -----------------------------------------------------------------------------------------


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, open_, left = {}, set(names), 1.5 * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > 2 * sizes[s] + 1e-9}
        for s in over or open_:
            target[s] = 2.0 * sizes[s] if over else left * weight[s] / total
        left -= sum(target[s] for s in over)
        open_ = open_ - over if over else set()
    return target


def test_mixing_targets(spark, docs, odd, empty):
    for df in (docs, odd):
        got = mixing.plan(df).collect()
        sizes = Counter()
        for r in df.collect():
            sizes[r["source"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
        target = brute_targets(dict(sizes))
        for r in got:
            assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
            assert r["taken"] in (r["size"] * int(r["rate"]), r["size"] * (int(r["rate"]) + 1)) and r["taken"] <= 2 * r["size"]
        assert sorted(got, key=str) == sorted(mixing.plan(df).collect(), key=str)
        emitted = mixing.emit(df)
        assert emitted.columns == df.columns
        copies = Counter((r["doc_id"], r["source"]) for r in emitted.collect())
        rows = Counter((r["doc_id"], r["source"]) for r in df.collect())
        assert all(copies[r["doc_id"], r["source"]] == r["copies"] * rows[r["doc_id"], r["source"]] for r in got)
    assert mixing.plan(empty).count() == 0 and mixing.emit(empty).count() == 0


def test_mixing_comes_near_targets(spark):
    got = mixing.plan(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).groupBy("source").agg({"taken": "sum", "target": "max"}).collect()
    assert all(abs(r["sum(taken)"] - r["max(target)"]) < 0.1 * r["max(target)"] for r in got)


def test_many_sources_join_by_shuffle(docs, odd, monkeypatch):
    tables = [docs, odd.withColumn("salt", F.lit(1))]
    few = [[sorted(made(df).collect(), key=str) for made in (mixing.plan, mixing.emit)] for df in tables]
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert [[sorted(made(df).collect(), key=str) for made in (mixing.plan, mixing.emit)] for df in tables] == few


def test_a_hot_source_joins_in_parts(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 2000, "hot").otherwise(F.col("id").cast("string")).alias("source"))
    joined = mixing.by_source(rows, rows.select("source").distinct(), id_col="doc_id")
    assert joined.count() == 3000 and joined.columns == rows.columns
    parts = rows.where("source = 'hot'").groupBy(F.pmod(F.xxhash64("doc_id"), F.lit(mixing.SALTS))).count().agg(F.max("count")).first()[0]
    assert parts < 3000 / 20


# --- archives ---------------------------------------------------------------------------------------

HTML = "<html>" + "x" * 120 + "é</html>"
PAGES = [(1, "http://a.example/x y", HTML), (2, None, HTML), (3, "http://b.example/", None), (4, "", ""), (5, "http://c.example/", "short"), (6, "http://d.example/", "short"), (2, None, HTML), (None, "http://e.example/", HTML), (1, "http://a.example/x y", HTML), (7, "http://f.example/", "\r\n\r\nHTTP/1.1 WARC/1.0\n" * 20)]


def test_archives_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(*p, "v") for p in PAGES], "page_id long, url string, html string, payload string").repartition(3)
    arc, out = str(tmp_path / "arc"), str(tmp_path / "warc")
    warc.write_arc(pages, arc)
    records = warc.to_warc(warc.read_arc(spark, arc))
    warc.write_warc(records, out)
    back = warc.read_warc(spark, out)
    assert back.where("problem IS NOT NULL").count() == 0
    got = Counter((int(r["key"]) if r["key"] else None, r["payload_bytes"], r["payload_digest"], r["type"], int(r["refers_to_key"]) if r["refers_to_key"] else None) for r in back.where("type <> 'warcinfo'").collect())
    import hashlib

    expected = Counter()
    for k, _, html in PAGES:
        data = (html or "").encode()
        first = min((p[0] for p in PAGES if (p[2] or "") == (html or "") and p[0] is not None), default=None)
        again = len(data) >= 100 and (k is None or k > first)
        expected[(k, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first if again else None)] += 1
    assert got == expected
    ids = [r["id"] for r in back.collect()]
    assert all(re.fullmatch(r"<urn:uuid:[0-9a-f-]{36}>", i) for i in ids)
    assert {r["date"] for r in back.collect()} == {"2024-01-01T00:00:00Z"}
    by_id = {r["id"]: r for r in back.collect()}
    assert all(by_id[r["refers_to"]]["type"] == "response" for r in back.where("type = 'revisit'").collect())
    versions = {r["version"] for r in warc.read_arc(spark, arc).collect()}
    assert versions == {1, 2}


def test_archive_edges(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_arc(none, str(tmp_path / "a"))
    warc.write_warc(warc.to_warc(warc.read_arc(spark, str(tmp_path / "a"))), str(tmp_path / "w"))
    assert warc.read_warc(spark, str(tmp_path / "w")).where("type <> 'warcinfo'").count() == 0
    good = b"http://x.example/a b 1.2.3.4 20010203040506 text/plain 5\nhello\n"
    first = b"filedesc://f 0.0.0.0 19970101 text/plain 4\n1 0 \n"
    parsed = list(warc.parse_arc(first + good + b"broken line\n"))
    assert [p.get("payload") for p in parsed] == [b"1 0 ", b"hello", None] and parsed[2]["problem"] and parsed[1]["url"] == "http://x.example/a b"
    assert list(warc.parse_arc(first + good[:-4]))[-1]["problem"]


def test_archives_with_a_hot_payload(spark, tmp_path, monkeypatch):
    """A third of the pages share a payload; revisits are broadcast or joined by place."""
    pages = spark.createDataFrame([(k, f"http://x.example/{k}", HTML if k % 3 == 0 else HTML * 2 if k % 7 == 0 else f"{HTML}{k}") for k in range(1, 100)], "page_id long, url string, html string")
    warc.write_arc(pages.repartition(4), str(tmp_path / "arc"))
    for bound in (50_000, 0):
        monkeypatch.setattr(warc, "BROADCAST_REVISITS", bound)
        rows = warc.to_warc(warc.read_arc(spark, str(tmp_path / "arc"))).where("type <> 'warcinfo'").collect()
        assert {r["key"]: r["refers_to_key"] for r in rows} == {k: 3 if k % 3 == 0 and k > 3 else 7 if k % 3 and k % 7 == 0 and k > 7 else None for k in range(1, 100)}
        first = next(r for r in rows if r["key"] == 3)
        assert all((r["refers_to"], r["refers_to_uri"], r["refers_to_date"], r["payload"]) == (first["id"], first["uri"], first["date"], b"") for r in rows if r["refers_to_key"] == 3)


def test_language_equals_plain_nearest_centroid(spark, docs):
    """Grams, weights and cosines one by one, for some texts of each kind."""
    model = langid.fit(docs)
    texts = ["", None, "123 !", "Été à la mer", "நல்ல தமிழ் உரை", *[r["text"] for r in docs.orderBy("doc_id").limit(25).collect()]]
    for text, (lang, score, rejected) in zip(texts, model.predict(texts), strict=True):
        letters = " ".join("".join(c if c.isalpha() or (c.isalnum() and not c.isdecimal()) or c in langid._MARKS else " " for c in (text or "").lower()).split())
        if not any(map(str.isalpha, letters)):
            assert (lang, score, rejected) == ("und", 0.0, True)
            continue
        data, grams = f" {letters} ".encode(), Counter()
        for n in (1, 2, 3):
            for k in range(len(data) - n + 1):
                gram = int.from_bytes(data[k : k + n], "big") | n << 24
                grams[(gram * 2654435761 % 2**32) >> 21] += 1
        vector = {d: math.log1p(c) * float(model.idf[d]) for d, c in grams.items()}
        norm = math.sqrt(sum(v * v for v in vector.values()))
        cosines = [sum(v * float(row[d]) for d, v in vector.items()) / norm for row in model.vectors]
        best = max(range(len(cosines)), key=cosines.__getitem__)
        assert lang == model.languages[best] and abs(score - cosines[best]) < 1e-4, text


def test_calibration_matches_brute_force():
    rng = random.Random(4)
    for _ in range(20):
        clean, low = sorted(rng.random() * 0.6 for _ in range(40)), sorted(rng.random() for _ in range(30))
        got = quality.calibrate(np.array(clean), np.array(low), 0.9)
        floor = next(c for c in clean if sum(x <= c for x in clean) - 1 >= 0.9 * 39)
        above = [x for x in low if x > floor]
        assert got == pytest.approx((floor + above[int(0.02 * len(above))]) / 2 if above else clean[-1])
        assert sum(c <= got for c in clean) >= 0.9 * 39


def test_repeated_labelled_ids_stay_bounded(spark):
    text = " ".join(f"word{k}" for k in range(30))
    docs = spark.createDataFrame([(1, text)] * 50 + [(2, "# $ % & " * 20)] * 50, "doc_id long, text string")
    forest = quality.fit(docs, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int"), rows=10)
    assert len(forest.feature)
    model = langid.fit(docs.selectExpr("doc_id", "text", "'en' AS lang"), train_rows=5)
    assert set(model.languages) <= {"en"}


def test_parts_of_long_texts_are_balanced_by_bytes():
    text = "漢字 " * 4000
    assert max(len(p.encode()) for p in tokens.split_long(text, 3000)) < 3100
    assert "".join(p + " " for p in tokens.split_long(text.strip(), 3000)).strip() == text.strip()
    assert tokens.split_long("a\t b\u00a0 c" * 50, 10) == ["a\t b\u00a0 c" * 50]
