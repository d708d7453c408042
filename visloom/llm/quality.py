"""Quality rules: an isolation forest on rule statistics, its threshold calibrated on labelled rows.

``statistics`` counts over whole texts. ``fit`` grows random trees on the statistics' ratios of clean
labelled rows; a document that few random splits set apart has a short mean path, and an anomaly score
near 1. The threshold is the one that rejects most low-quality labelled rows while it keeps
``KEEP_SHARE`` of the clean ones. Fitting takes at most ``FIT_ROWS`` labelled rows, those with the smallest
hashes of their ids, however often an id is repeated; all other counts and verdicts cover every document.

Defined cases: a null text counts as no words; fewer than ``MIN_WORDS`` words, or repeated 5-word windows
over more than ``REPEAT_PERCENT`` percent of the words, fail the base rules; without clean labelled rows
nothing is anomalous, and without low-quality ones only what lies beyond all clean ones; a document
labelled twice counts as low quality if one label says so; each row is judged by itself, repeats
included; other columns, whatever their names, pass through ``keep`` untouched.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

MIN_WORDS = 10
REPEAT_PERCENT = 20
WINDOW = 5
#: At most so many labelled rows are used for the fit. Those of half of the ids, by a hash, grow the trees; the others calibrate the threshold.
FIT_ROWS = 8192
TREES = 128
TREE_ROWS = 256
KEEP_SHARE = 0.998
SEED = 42
FEATURES = ("symbol_share", "upper_share", "repeat_share", "dup_line_share", "mark_share", "digit_share", "word_length", "top_word_share")
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

_BYTES = np.arange(256)
_SPACE = np.isin(_BYTES, list(b" \t\n\r\x0b\x0c"))
_SYMBOL = np.isin(_BYTES, list(b"#*$%&|<>"))
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_LETTER = _UPPER | ((_BYTES >= 97) & (_BYTES <= 122))
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_MARK = (_BYTES > 32) & (_BYTES < 127) & ~_LETTER & ~_DIGIT
_STARTS = (_BYTES < 0x80) | (_BYTES > 0xBF)
_CLASSES = np.stack([_STARTS & ~_SPACE, _SYMBOL, _UPPER, _LETTER, _DIGIT, _MARK]).astype(np.int64)


def repeat_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words inside windows that are found twice or more, the first place included."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    windows = list(zip(*(words[i:] for i in range(size)), strict=False))
    if len(set(windows)) == n:
        return 0
    counts = Counter(windows)
    mark = np.zeros(len(words) + 1, np.int64)
    for i, window in enumerate(windows):
        if counts[window] > 1:
            mark[i] += 1
            mark[i + size] -= 1
    return int((np.cumsum(mark)[:-1] > 0).sum())


def count(text: str | None) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """The statistics of a text, and the features that the forest sees."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    chars, symbols, upper, letters, digits, marks = (int(x) for x in _CLASSES @ np.bincount(np.frombuffer(data, np.uint8), minlength=256))
    lines = [x for x in data.split(b"\n") if x.strip()]
    dup_lines = len(lines) - len(set(lines))
    repeats = repeat_words(words)
    n = max(len(words), 1)
    top = max(Counter(words).values(), default=0)
    features = (
        symbols / max(chars, 1), upper / max(letters, 1), repeats / n, dup_lines / max(len(lines), 1), marks / max(chars, 1), digits / max(chars, 1), chars / n,
        # How far the commonest word goes beyond what chance gives a short text.
        max(0.0, top - 3.0 * math.sqrt(n)) / n,
    )
    return (len(words), chars, symbols, dup_lines, repeats), features


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > REPEAT_PERCENT * n_words


# --- the forest -------------------------------------------------------------------------------------


def mean_path(n: float) -> float:
    """Mean length of an unsuccessful search in a binary tree of n rows."""
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


@dataclass
class Forest:
    feature: np.ndarray  # trees x nodes; -1 at leaves
    split: np.ndarray
    path: np.ndarray  # depth of a leaf plus the mean path below it
    norm: float
    threshold: float = math.inf

    def scores(self, x: np.ndarray) -> np.ndarray:
        """2 ^ (-mean path / norm): near 1 for what few splits isolate."""
        if not len(self.feature) or not len(x):
            return np.zeros(len(x))
        total, rows = np.zeros(len(x)), np.arange(len(x))
        depth = int(math.log2(self.feature.shape[1] + 1))
        for feature, split, path in zip(self.feature, self.split, self.path, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth - 1):
                f = feature[node]
                inner = f >= 0
                right = x[rows, np.maximum(f, 0)] > split[node]
                node = np.where(inner, 2 * node + 1 + right, node)
            total += path[node]
        return 2.0 ** (-total / len(self.feature) / self.norm)


def grow(x: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = SEED) -> Forest:
    """Random trees over subsamples. Splits lie uniformly in a range a little wider than the rows', so that values beyond all of them are set apart too."""
    rng = np.random.default_rng(seed)
    rows = min(tree_rows, len(x))
    height = max(1, math.ceil(math.log2(max(rows, 2)))) + 2
    nodes = 2 ** (height + 1) - 1
    feature, split, path = np.full((trees, nodes), -1), np.zeros((trees, nodes)), np.zeros((trees, nodes))
    width = np.maximum(x.max(0) - x.min(0), 0.05) if len(x) else np.zeros(0)

    def build(t: int, node: int, depth: int, part: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        if depth == height or len(part) <= 1 and depth >= 2:
            path[t, node] = depth + mean_path(len(part))
            return
        f = int(rng.integers(x.shape[1]))
        at = rng.uniform(low[f], high[f])
        feature[t, node], split[t, node] = f, at
        over = part[:, f] > at
        for k, (rest, lo, hi) in enumerate(((part[~over], low, _with(high, f, at)), (part[over], _with(low, f, at), high))):
            build(t, 2 * node + 1 + k, depth + 1, rest, lo, hi)

    for t in range(trees if len(x) else 0):
        part = x[rng.choice(len(x), rows, replace=False)]
        build(t, 0, 0, part, part.min(0) - 0.5 * width, part.max(0) + 0.5 * width)
    return Forest(feature[: trees if len(x) else 0], split, path, max(mean_path(rows), 1.0))


def _with(bounds: np.ndarray, f: int, at: float) -> np.ndarray:
    out = bounds.copy()
    out[f] = at
    return out


def calibrate(clean: np.ndarray, low: np.ndarray, keep_share: float = KEEP_SHARE) -> float:
    """Scores above the result are anomalous: best balanced accuracy among those that keep enough clean rows."""
    if not len(clean):
        return math.inf
    floor = float(np.quantile(clean, keep_share, method="higher"))
    above = np.sort(low[low > floor])
    if not len(above):
        return float(clean.max())
    # Half way from the clean rows to the low-quality ones beyond, without giving up more than a few of those.
    return float((floor + above[int(0.02 * len(above))]) / 2)


# --- Spark ------------------------------------------------------------------------------------------


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the statistics and the features of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [count(t) for t in batch.column(1).to_pylist()]
            columns = [pa.array([m[0][k] for m in made], pa.int64()) for k in range(len(STATISTICS))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, pa.array([list(m[1]) for m in made], pa.list_(pa.float64()))], ["doc_id", *STATISTICS, "features"])

    return common.map_arrow(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), run, "doc_id long, " + ", ".join(f"{s} long" for s in STATISTICS) + ", features array<double>")


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, keep_share: float = KEEP_SHARE, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> Forest:
    """Grow and calibrate on at most ``rows`` labelled rows."""
    one = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    picked = F.broadcast(one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).select(F.col("doc_id").alias("__id"), "quality"))
    joined = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(picked, F.col("doc_id") == F.col("__id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [count(t) for t in batch.column(1).to_pylist()]
            failed = [base_failed(m[0][0], m[0][4]) for m in made]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2).cast(pa.int64()), pa.array(failed), pa.array([list(m[1]) for m in made], pa.list_(pa.float64()))], ["doc_id", "quality", "failed", "features"])

    got = common.map_arrow(joined.select("doc_id", "text", F.col("quality").cast("long").alias("quality")), run, "doc_id long, quality long, failed boolean, features array<double>").where("NOT failed")
    got = got.withColumn("order", F.xxhash64("doc_id")).orderBy("order", "doc_id", "features").limit(rows).toPandas()
    x = np.array(got["features"].tolist(), float).reshape(len(got), len(FEATURES))
    good = got["quality"].to_numpy() > 0
    half = got["order"].to_numpy() % 2 == 0
    forest = grow(x[good & half] if (good & half).any() else x[good], seed=seed)
    forest.threshold = calibrate(forest.scores(x[good & ~half] if (good & ~half).any() else x[good]), forest.scores(x[~good]), keep_share)
    return forest


def judge(docs: DataFrame, forest: Forest, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the statistics, base_failed, kept and the anomaly score of each row."""
    model = docs.sparkSession.sparkContext.broadcast(forest)
    schema = "doc_id long, " + ", ".join(f"{s} long" for s in STATISTICS) + ", base_failed boolean, kept boolean, anomaly double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [count(t) for t in batch.column(1).to_pylist()]
            score = model.value.scores(np.array([m[1] for m in made], float).reshape(len(made), len(FEATURES)))
            failed = [base_failed(m[0][0], m[0][4]) for m in made]
            kept = [not f and bool(s <= model.value.threshold) for f, s in zip(failed, score, strict=True)]
            counts = [pa.array([m[0][k] for m in made], pa.int64()) for k in range(len(STATISTICS))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, pa.array(failed, pa.bool_()), pa.array(kept, pa.bool_()), pa.array(score, pa.float64())], ["doc_id", *STATISTICS, "base_failed", "kept", "anomaly"])

    return common.map_arrow(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), run, schema)


def keep(docs: DataFrame, forest: Forest, text_col: str = "text") -> DataFrame:
    """The rows that pass, with all their columns."""
    model = docs.sparkSession.sparkContext.broadcast(forest)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [count(t) for t in batch.column(at).to_pylist()]
            x = np.array([m[1] for m in made], float).reshape(len(made), len(FEATURES))
            fine = model.value.scores(x) <= model.value.threshold
            yield batch.filter(pa.array([bool(f) and not base_failed(m[0][0], m[0][4]) for f, m in zip(fine, made, strict=True)], pa.bool_()))

    return common.map_arrow(docs, run, docs.schema)


def op2_quality(spark, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    forest = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judge(docs, forest)
