"""Benchmark decontamination: a BM25 index of test items with block-max WAND, queried by every passage.

Every training text is cut into overlapping passages, long enough that any item lies whole in one. A
passage is a query, the items are the indexed documents. An item's score is the share of its own BM25
mass that the passage's words carry, so one threshold fits items of any length, and all items above it
are retrieved; there is no top k. The bounds of block-max WAND decide which items are scored at all, here
over the passages of a whole batch at once: frequent terms never drive retrieval (their total is a bound
of each block); the maxima of a passage's other terms are added up by block of items, from the blocks' heads
alone; of each term's postings, frequent terms included, only the runs in blocks that can reach the threshold
are read, and all others are skipped whole. Retrieved items are verified:
the word n-grams of the item's question and those of its answer (its last sentence) must be in the passage.

Items are indexed in shards of at most ``SHARD_BYTES`` of text; each shard is broadcast and queried by all
passages. If there are several, each one's matches are written, and its broadcast is destroyed, before the next is built. Document frequencies and the mean length cover all items.

Defined cases: items without a word never match; null and empty texts have no passage; an item of one
sentence is its own question and answer; items that share an id match if any does; those without an id are
one such group, reported by ``matches`` with a null item_id, and ``keep_clean`` drops what holds them; rows that share an id
are judged together in ``matches``, by themselves in ``keep_clean``; an empty benchmark matches
nothing; other columns, whatever their names, pass through ``keep_clean``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

THRESHOLD = 0.75
OVERLAP = 0.8
NGRAM = 5
#: Passages have twice so many words as the longest item, or as this, and start at every half.
LEAST_STRIDE = 64
BLOCK = 16
K1, B = 1.2, 0.75
#: A term in more than this share of the items is frequent.
FREQUENT = 0.05
SHARD_BYTES = 16 << 20
BATCH_WORDS = 1 << 18
_WORD = re.compile(r"[^\W_]+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The words before the last sentence, and its own; the whole item twice if it is one sentence."""
    parts = [w for w in (words_of(s) for s in _SENTENCE.split(text or "")) if w]
    if len(parts) < 2:
        return (parts[0], parts[0]) if parts else ([], [])
    return [w for p in parts[:-1] for w in p], parts[-1]


def overlap(part: list[str], passage: list[str], size: int = NGRAM) -> float:
    """Share of the part's distinct n-grams that the passage holds; n is smaller for shorter parts."""
    n = min(size, len(part))
    own = set(zip(*(part[k:] for k in range(n)), strict=False))
    return len(own & set(zip(*(passage[k:] for k in range(n)), strict=False))) / len(own) if own else 0.0


@dataclass
class Index:
    """A shard. Items are numbered from 0; block b holds the items from b * BLOCK on. A term's block heads start at ``block_at``; a head
    has its block, its largest impact, and the start of its run of postings, ``run_at``."""

    ids: list[int | None]
    parts: list[tuple[list[str], list[str]]]
    terms: dict[str, int]
    items: np.ndarray
    impacts: np.ndarray
    block_at: np.ndarray
    blocks: np.ndarray
    maxima: np.ndarray
    run_at: np.ndarray
    frequent: np.ndarray
    frequent_bound: np.ndarray  # by block: the most that frequent terms add to one of its items
    stride: int

    def retrieve(self, passage: np.ndarray, term: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(passage, item, score) at or above the threshold, of distinct (passage, term) rows."""
        n_blocks, n_items = len(self.frequent_bound), len(self.ids)
        rare = ~self.frequent[term]
        asked, head = _expand(passage[rare], term[rare], self.block_at)
        key, bound = _summed(asked * n_blocks + self.blocks[head], self.maxima[head])
        alive = key[bound + self.frequent_bound[key % n_blocks] >= threshold]
        # Without any rare term only a block whose frequent terms alone suffice can be reached.
        if (self.frequent_bound >= threshold).any():
            rest = np.flatnonzero(self.frequent_bound >= threshold)
            alive = np.unique(np.concatenate([alive, (np.unique(passage)[:, None] * n_blocks + rest).ravel()]))
        if not len(alive):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        reached = np.isin(passage, np.unique(alive // n_blocks))
        asked, head = _expand(passage[reached], term[reached], self.block_at)
        open_ = np.isin(asked * n_blocks + self.blocks[head], alive)
        asked, posting = _expand(asked[open_], head[open_], self.run_at)
        key, score = _summed(asked * n_items + self.items[posting], self.impacts[posting])
        hit = score >= threshold - 1e-9
        return key[hit] // n_items, key[hit] % n_items, score[hit]


def _expand(passage, row, at):
    """(passage, index) for each of the entries at[row] to at[row + 1]."""
    n = at[row + 1] - at[row]
    start = np.repeat(at[row] - (np.cumsum(n) - n), n)
    return np.repeat(passage, n), start + np.arange(n.sum())


def _summed(key, weight):
    distinct, inverse = np.unique(key, return_inverse=True)
    return distinct, np.bincount(inverse, weight, len(distinct))


def build(items: list[tuple[int, str]], frequency: dict[str, int], n_items: int, mean_words: float, stride: int) -> Index:
    """The index of one shard; frequencies, number and mean length are those of all items."""
    items = [(i, t) for i, t in items if words_of(t)]
    counted = [Counter(words_of(t)) for _, t in items]
    terms = {w: k for k, w in enumerate(sorted({w for c in counted for w in c}))}
    idf = {w: math.log(1 + (n_items - frequency[w] + 0.5) / (frequency[w] + 0.5)) for w in terms}
    posted: list[list[tuple[int, float]]] = [[] for _ in terms]
    common_terms = np.array([frequency[w] > FREQUENT * n_items and frequency[w] > 1 for w in terms], bool)
    bound = np.zeros(-(-len(items) // BLOCK))
    for k, c in enumerate(counted):
        length = sum(c.values())
        impact = {w: idf[w] * n * (K1 + 1) / (n + K1 * (1 - B + B * length / mean_words)) for w, n in c.items()}
        whole = sum(impact.values())
        for w, x in impact.items():
            posted[terms[w]].append((k, x / whole))
        bound[k // BLOCK] = max(bound[k // BLOCK], sum(x for w, x in impact.items() if common_terms[terms[w]]) / whole)
    # Postings are in order of items, so that those of a block are one run.
    flat = [(t, k, x) for t, p in enumerate(posted) for k, x in p]
    term_of, item, impact = (np.array([f[j] for f in flat], kind) for j, kind in enumerate((np.int64, np.int64, float)))
    head = np.ones(len(flat), bool)
    head[1:] = (term_of[1:] != term_of[:-1]) | (item[1:] // BLOCK != item[:-1] // BLOCK)
    runs = np.flatnonzero(head)
    maxima = np.maximum.reduceat(impact, runs) if len(runs) else np.zeros(0)
    block_at = np.searchsorted(term_of[runs], np.arange(len(terms) + 1))
    return Index([i for i, _ in items], [question_and_answer(t) for _, t in items], terms, item, impact, block_at, item[runs] // BLOCK, maxima, np.append(runs, len(flat)), common_terms, bound, stride)


def found(texts: list[str | None], index: Index, threshold: float = THRESHOLD, least: float = OVERLAP) -> list[tuple[int, int | None, float]]:
    """(text number, item id, best score) of the verified matches."""
    best: dict[tuple[int, int | None], float] = {}
    held: list[tuple[int, list[str]]] = []
    size = 0

    def flush() -> None:
        nonlocal held, size
        owners, starts, parts, terms = [], [], [], []
        for n, words in held:
            ids = np.array([index.terms.get(w, -1) for w in words], np.int64)
            for start in range(0, max(1, len(words) - index.stride), index.stride):
                part = ids[start : start + 2 * index.stride]
                part = np.unique(part[part >= 0])
                terms.append(part)
                parts.append(np.full(len(part), len(owners)))
                owners.append((n, words))
                starts.append(start)
        if terms:
            passage, item, score = index.retrieve(np.concatenate(parts), np.concatenate(terms), threshold)
            for p, i, s in zip(passage.tolist(), item.tolist(), score.tolist(), strict=True):
                n, words = owners[p]
                key = (n, index.ids[i])
                if s > best.get(key, 0.0):
                    text = words[starts[p] : starts[p] + 2 * index.stride]
                    if min(overlap(x, text) for x in index.parts[i]) >= least:
                        best[key] = s
        held, size = [], 0

    for n, text in enumerate(texts):
        words = words_of(text)
        if words:
            held.append((n, words))
            size += len(words)
            if size >= BATCH_WORDS:
                flush()
    flush()
    return [(n, i, s) for (n, i), s in best.items()]


def indexes(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> Iterator[Index]:
    """The index, shard by shard, each built when it is asked for."""
    rows = benchmark.select(F.col(id_col).cast("long").alias("id"), common.text_or_empty(text_col).alias("text")).distinct()
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count: Counter = Counter()
            for t in batch.column(0).to_pylist():
                words = words_of(t)
                if words:
                    count.update(set(words))
                    count["\n items"] += 1
                    count["\n words"] += len(words)
                    yield pa.RecordBatch.from_arrays([pa.array(["\n longest"]), pa.array([len(words)], pa.int64())], ["term", "n"])
            yield pa.RecordBatch.from_arrays([pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())], ["term", "n"])

    stats = common.map_arrow(rows.select("text"), terms, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"), F.max("n").alias("most"))
    stats = common.cut(stats)
    whole = {r["term"]: r for r in stats.where(F.col("term").startswith("\n")).collect()}
    n_items = whole["\n items"]["n"] if "\n items" in whole else 0
    if not n_items:
        return
    mean = whole["\n words"]["n"] / n_items
    stride = max(LEAST_STRIDE, whole["\n longest"]["most"])
    for k in range(shards):
        part = [(r["id"], r["text"]) for r in rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(shards)) == k).orderBy("id", "text").collect()]
        own = {w for _, t in part for w in words_of(t)}
        counted = {r["term"]: r["n"] for r in stats.join(F.broadcast(stats.sparkSession.createDataFrame([(w,) for w in own], "term string")), "term").collect()} if shards > 1 else {r["term"]: r["n"] for r in stats.collect()}
        yield build(part, counted, n_items, mean, stride)


def matches(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, least: float = OVERLAP, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, item_id, score): the verified matches, one row for a document and an item."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = spark.createDataFrame([], "doc_id long, item_id long, score double")
    shared = None
    for index in indexes(benchmark, shard_bytes=shard_bytes):
        if shared is not None:
            out = common.cut(out)
            shared.destroy()
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(0).to_pylist()
                hits = found(batch.column(1).to_pylist(), shared.value, threshold, least)
                yield pa.RecordBatch.from_arrays([pa.array([ids[n] for n, _, _ in hits], pa.int64()), pa.array([i for _, i, _ in hits], pa.int64()), pa.array([s for _, _, s in hits], pa.float64())], ["doc_id", "item_id", "score"])

        out = out.union(common.map_arrow(rows, run, "doc_id long, item_id long, score double"))
    return out.groupBy("doc_id", "item_id").agg(F.max("score").alias("score"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, least: float = OVERLAP, text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The documents without a verified match, with all their columns."""
    at, shared = docs.columns.index(text_col), None
    for index in indexes(benchmark, shard_bytes=shard_bytes):
        if shared is not None:
            docs = common.cut(docs)
            shared.destroy()
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hit = {n for n, _, _ in found(batch.column(at).to_pylist(), shared.value, threshold, least)}
                yield batch.filter(pa.array([n not in hit for n in range(batch.num_rows)], pa.bool_()))

        docs = common.map_arrow(docs, run, docs.schema)
    return docs


def op4_decontamination(spark, sf_dir: str) -> DataFrame:
    return matches(common.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
