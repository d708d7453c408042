"""Language identification by the nearest of several centroids per language.

A text becomes the counts of its letters' byte n-grams (one to three bytes of the lower-cased text, all
other characters as single spaces), hashed to ``DIMENSIONS`` and damped by a logarithm, times inverse
document frequency, at length 1. Each language's training vectors are clustered by spherical k-means;
prediction is the language of the centroid with the highest cosine. A text farther from its centroid than
nearly all of the centroid's own training texts is marked ``rejected``, beside the nearest language.

Training reads at most ``PER_LANGUAGE`` rows of a language and ``TRAIN_ROWS`` in all, those with the
smallest hashes of their ids, however often an id is repeated; predictions cover whole texts of all rows.

Defined cases: null texts and those without a letter are ``und`` with score 0 and rejected; without any
training row every text is ``und``; ties go to the language first in code point order; each row is
predicted by itself, repeats included; a null id is not held out; other columns are not read.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

DIMENSIONS = 2048
PER_LANGUAGE = 1000
TRAIN_ROWS = 16384
CLUSTERS = 3
ROUNDS = 10
#: Share of a centroid's own training texts that lies beyond its rejection distance.
REJECT_SHARE = 0.005
BATCH = 256
SEED = 42
#: Combining marks belong to the letters before them, such as vowel signs.
_MARKS = "".join(c for c in map(chr, range(0x300, 0x1F000)) if unicodedata.category(c) in ("Mn", "Mc"))
_OTHER = re.compile(rf"(?:[^\w{_MARKS}]|[\d_])+")


def counts(text: str | None) -> np.ndarray | None:
    """Hashed n-gram counts; None without a letter."""
    letters = _OTHER.sub(" ", (text or "").lower()).strip()
    if not any(map(str.isalpha, letters)):
        return None
    one = np.frombuffer(f" {letters} ".encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    two = one[:-1] << 8 | one[1:]
    three = two[:-1] << 8 | one[2:]
    # Multiplicative hashing; the top bits choose the dimension.
    grams = np.concatenate([one | 1 << 24, two | 2 << 24, three | 3 << 24])
    return np.bincount((grams * np.uint32(2654435761)) >> np.uint32(21), minlength=DIMENSIONS).astype(np.float32)


@dataclass
class Centroids:
    languages: list[str]  # of each centroid
    vectors: np.ndarray
    idf: np.ndarray
    least: np.ndarray  # the lowest cosine that isn't rejected

    def vectorise(self, rows: np.ndarray) -> np.ndarray:
        out = np.log1p(rows) * self.idf
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        out: list[tuple[str, float, bool]] = [("und", 0.0, True)] * len(texts)
        if not self.languages:
            return out
        for start in range(0, len(texts), BATCH):
            found = [(i, c) for i in range(start, min(start + BATCH, len(texts))) if (c := counts(texts[i])) is not None]
            if found:
                cosine = self.vectorise(np.stack([c for _, c in found])) @ self.vectors.T
                best = cosine.argmax(1)
                for (i, _), k, row in zip(found, best, cosine, strict=True):
                    out[i] = (self.languages[k], float(min(max(row[k], 0.0), 1.0)), bool(row[k] < self.least[k]))
        return out


def cluster(x: np.ndarray, k: int, rounds: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means: centroids of length 1, and each row's own."""
    rng = np.random.default_rng(seed)
    centre = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        own = (x @ centre.T).argmax(1)
        sums = np.stack([x[own == j].sum(0) if (own == j).any() else centre[j] for j in range(len(centre))])
        centre = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    return centre, (x @ centre.T).argmax(1)


def train(rows: np.ndarray, languages: list[str], clusters: int = CLUSTERS, seed: int = SEED) -> Centroids:
    """Centroids from n-gram counts and their languages."""
    if not len(rows):
        return Centroids([], np.zeros((0, DIMENSIONS), np.float32), np.ones(DIMENSIONS, np.float32), np.zeros(0))
    idf = np.log((1 + len(rows)) / (1 + (rows > 0).sum(0))).astype(np.float32) + 1
    model = Centroids([], np.zeros((0, DIMENSIONS), np.float32), idf, np.zeros(0))
    x, names = model.vectorise(rows), np.array(languages, object)
    vectors, least = [], []
    for language in sorted(set(languages)):
        own_rows = x[names == language]
        centre, own = cluster(own_rows, clusters, ROUNDS, seed)
        for j, c in enumerate(centre):
            if (own == j).any():
                model.languages.append(language)
                vectors.append(c)
                least.append(float(np.quantile(own_rows[own == j] @ c, REJECT_SHARE)))
    return Centroids(model.languages, np.stack(vectors).astype(np.float32), idf, np.array(least))


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, train_rows: int = TRAIN_ROWS) -> Centroids:
    """Train on a bounded sample of rows with a language that are not held out."""
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "lang")
    # Of a large language only ids with small hashes get to its window: some times the rows wanted, however many there are.
    totals = known.groupBy("lang").agg(F.count("*").alias("rows")).orderBy("lang").limit(train_rows)
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    few = known.join(F.broadcast(totals), "lang").where(share * F.col("rows") < 2.0 * per_language)
    order = Window.partitionBy("lang").orderBy(share, "doc_id")
    ids = few.withColumn("n", F.row_number().over(order)).where(F.col("n") <= per_language).orderBy("n", "lang").limit(train_rows)
    ids = F.broadcast(ids.select(F.col("doc_id").alias("__id"), F.col("lang").alias("__lang")).distinct())
    picked = docs.select("doc_id", "lang", "text").join(ids, (F.col("doc_id") == F.col("__id")) & (F.col("lang") == F.col("__lang"))).select("doc_id", "lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [counts(t) for t in batch.column(2).to_pylist()]
            keep = pa.array([m is not None for m in made], pa.bool_())
            grams = pa.array([m.astype(np.uint32).tobytes() for m in made if m is not None], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep), grams], ["doc_id", "lang", "grams"])

    got = common.map_arrow(picked, run, "doc_id long, lang string, grams binary").orderBy("doc_id", "lang", "grams").limit(train_rows).toPandas()
    rows = np.stack([np.frombuffer(g, np.uint32) for g in got["grams"]]).astype(np.float32) if len(got) else np.zeros((0, DIMENSIONS), np.float32)
    return train(rows, list(got["lang"]))


def predict(docs: DataFrame, model: Centroids, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = shared.value.predict(batch.column(2).to_pylist())
            columns = [pa.array([m[k] for m in made], t) for k, t in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    return common.map_arrow(rows, run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def op7_language(spark, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    return predict(docs, fit(docs))
