"""The pipeline's stages against brute force on a small corpus, and the queries' SQL."""

import re
from collections import Counter

import duckdb

import corpus_pipeline
from visloom.llm import decontaminate, mixing, quality, queries

from .test_corpus import brute_lines, brute_near


def test_stages(spark, sf_dir, docs, doc_rows):
    out, kept = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, out, sf_dir)
        assert out.columns == docs.columns, name
        out = spark.createDataFrame(out.collect(), docs.schema)
        kept[name] = [(r["doc_id"], r["text"]) for r in out.collect()]

    forest = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    first = [(i, t) for i, t in doc_rows if plain_kept(t, forest)]
    assert sorted(kept["quality_rules"]) == sorted(first)
    stripped = {r: t for r, t in brute_lines(first).items() if t.strip()}
    assert sorted(kept["line_dedup"]) == sorted((i, t) for (i, _), t in stripped.items())
    near = brute_near(kept["line_dedup"], 5, 80)
    assert sorted(kept["near_dedup"]) == sorted(x for x in kept["line_dedup"] if near[x[0]][1] == x[0])
    items = [" ".join(["", *decontaminate.words_of(r["text"]), ""]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = [(i, t) for i, t in kept["near_dedup"] if not any(x in " ".join(["", *decontaminate.words_of(t), ""]) for x in items if x.strip())]
    assert sorted(kept["decontamination"]) == sorted(clean)
    con, sources = duckdb.connect(), {r["doc_id"]: r["source"] for r in docs.collect()}
    con.execute("CREATE TABLE last (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO last VALUES (?, ?, ?)", [(i, t, sources[i]) for i, t in kept["decontamination"]])
    rates = dict(con.sql(f"SELECT doc_id, copies FROM ({mixing.sql('last')})").fetchall())
    assert Counter(i for i, _ in kept["mixing"]) == Counter({i: n for i, n in rates.items() if n})
    assert Counter((r["doc_id"], r["text"]) for r in corpus_pipeline.run(spark, sf_dir).collect()) == Counter(kept["mixing"])


def plain_kept(text, forest):
    """The verdict by walking each tree, one text at a time."""
    counts, features = quality.count(text)
    if quality.base_failed(counts[0], counts[4]):
        return False
    total = 0.0
    for feature, split, path in zip(forest.feature, forest.split, forest.path, strict=True):
        node = 0
        while feature[node] >= 0:
            node = 2 * node + (2 if features[feature[node]] > split[node] else 1)
        total += path[node]
    return 2.0 ** (-total / len(forest.feature) / forest.norm) <= forest.threshold


def test_queries_are_named_and_covered():
    assert sorted(int(re.match(r"op(\d+)_", k)[1]) for k in queries.QUERIES) == list(range(1, 14))
    assert set(queries.SQL) <= set(queries.QUERIES)


def test_sql_agrees(spark, sf_dir):
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    for name, text in queries.SQL.items():
        got = queries.QUERIES[name](spark, sf_dir)
        columns = sorted(got.columns)
        expected = con.sql(f"SELECT {', '.join(columns)} FROM ({text})").fetchall()
        rounded = lambda rows: Counter(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows)
        assert rounded(expected) == rounded(tuple(r[c] for c in columns) for r in got.collect()), name
