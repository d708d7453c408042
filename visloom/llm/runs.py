"""Periodic runs of words, by Crochemore's partition refinement.

A run is a stretch of consecutive words with smallest period q that is at least twice q long and that no
neighbouring word extends. Positions of a text fall into classes by the factor of a given number of words that
starts there. Classes of longer factors come from those of shorter ones: a class only has to be split by where
the next position's class was split, and of each split class's parts all but one of the largest do that, so a position is
moved O(log n) times. Neighbours within a class whose distance equals the factors' length are squares; squares that start
at successive positions make a run. Neighbours suffice, as between the ends of a square of a repeated root others of
its class lie, and the root's own square stands for it.

Every document is refined by itself in a task. Memory and time follow its own words, O(n) and O(n log n).

Defined cases: a null or blank text has no words and no run; of the longest runs the one with the smallest start, then
period, is reported; each row is taken by itself, repeats included; a null id counts as the empty string in the checksum of
``rewritten`` and is never rewritten; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from hashlib import sha256
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

LEAST = 12


class Run(NamedTuple):
    start: int
    length: int
    period: int


def numbers(words: list[bytes]) -> list[int]:
    """Equal numbers for equal words."""
    seen: defaultdict[bytes, int] = defaultdict()
    seen.default_factory = seen.__len__
    return [seen[w] for w in words]


class _Classes:
    """Positions by the factor that starts there, each class a linked list in the order of positions. Classes of one have number -1 and no list."""

    def __init__(self, word: list[int]):
        """Classes of factors of two words."""
        n = self.n = len(word)
        groups: defaultdict[tuple[int, int], list[int]] = defaultdict(list)
        for i, pair in enumerate(zip(word, [*word[1:], -1])):
            groups[pair].append(i)
        self.of, self.before, self.after = [-1] * n, [-1] * n, [-1] * n
        self.first: list[int] = []
        self.size: list[int] = []
        #: Starts of neighbours by their distance, for the time when factors are as long. Entries are checked then, as neighbours may part.
        self.apart: defaultdict[int, list[int]] = defaultdict(list)
        parents: defaultdict[int, list[list[int]]] = defaultdict(list)
        for (a, _), group in groups.items():
            parents[a].append(group)
            if len(group) > 1:
                self._make(group, 2)
        #: Classes that split those of the positions before them. The end of the text is one of its own.
        self.splitting = [[n]]
        for parts in parents.values():
            self._choose(parts)

    def _choose(self, parts: list[list[int]]) -> None:
        if len(parts) > 1:
            largest = max(range(len(parts)), key=lambda k: len(parts[k]))
            self.splitting += [p for k, p in enumerate(parts) if k != largest]

    def _make(self, group: list[int], length: int) -> None:
        """A class of its own for these positions, in order."""
        if len(group) == 1:
            self.of[group[0]] = self.before[group[0]] = self.after[group[0]] = -1
            return
        number, last = len(self.first), -1
        self.first.append(group[0])
        self.size.append(len(group))
        for i in group:
            self.of[i], self.before[i] = number, last
            if last >= 0:
                self.after[last] = i
                if i - last >= length:
                    self.apart[i - last].append(last)
            last = i
        self.after[last] = -1

    def _take(self, number: int, group: list[int], length: int) -> None:
        """Take positions out of a class that keeps others."""
        before, after = self.before, self.after
        for i in group:
            a, b = before[i], after[i]
            if a >= 0:
                after[a] = b
            else:
                self.first[number] = b
            if b >= 0:
                before[b] = a
                if a >= 0 and b - a >= length:
                    self.apart[b - a].append(a)
        self.size[number] -= len(group)

    def refine(self, length: int) -> None:
        """To factors of ``length`` words, from those of one less."""
        of = self.of
        touched: defaultdict[int, dict[int, list[int]]] = defaultdict(dict)
        for k, splitter in enumerate(self.splitting):
            for j in splitter:
                if j and (c := of[j - 1]) >= 0:
                    touched[c].setdefault(k, []).append(j - 1)
        self.splitting = []
        for number, by_splitter in touched.items():
            parts = list(by_splitter.values())
            rest = self.size[number] - sum(map(len, parts))
            if not rest:
                # The largest part keeps the class; if it is the only one, nothing splits.
                keep = max(range(len(parts)), key=lambda k: len(parts[k]))
                parts.pop(keep)
                self.splitting += parts
            elif rest >= max(map(len, parts)):
                self.splitting += parts
            for part in parts:
                self._take(number, part, length)
            if rest and rest < max(map(len, parts)):
                self._choose([*parts, self._members(number)])
            for part in parts:
                self._make(part, length)
            if self.size[number] == 1:
                self._make([self.first[number]], length)

    def _members(self, number: int) -> list[int]:
        out, i = [], self.first[number]
        while i >= 0:
            out.append(i)
            i = self.after[i]
        return out

    def squares(self, length: int) -> list[int]:
        """Starts of squares of two factors of ``length`` words, in order."""
        return sorted({i for i in self.apart.pop(length, ()) if self.of[i] >= 0 and self.after[i] == i + length})


def _merge(starts: list[int], period: int, least: int) -> Iterator[Run]:
    k = 0
    while k < len(starts):
        first = k
        while k + 1 < len(starts) and starts[k + 1] == starts[k] + 1:
            k += 1
        length = starts[k] - starts[first] + 2 * period
        if length >= least:
            yield Run(starts[first], length, period)
        k += 1


def find(word: list[int], least: int = LEAST) -> list[Run]:
    """All runs of at least ``least`` words, by start, then period."""
    if len(word) < max(2, least):
        return []
    out = list(_merge([i for i, (a, b) in enumerate(zip(word, word[1:])) if a == b], 1, least))
    classes, length = _Classes(word), 2
    while True:
        out += _merge(classes.squares(length), length, least)
        if not classes.splitting:
            return sorted(out, key=lambda r: (r.start, r.period))
        length += 1
        classes.refine(length)


def collapse(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    kept, at = [], 0
    for start, end in sorted((r.start + r.period, r.start + r.length) for r in runs):
        if end > at:
            kept += words[at : max(at, start)]
            at = end
    return kept + words[at:]


def rewritten(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """One document in ten, by the checksum of its id, goes on periodically from some word."""
    h, n = zlib.crc32(b"" if doc_id is None else b"%d" % doc_id), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


def map_runs(docs: DataFrame, least: int = LEAST, rewrite: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, runs (array of start, length, period), collapsed (the kept words, joined by single spaces)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, found, texts = [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = (text.as_buffer().to_pybytes() if text.is_valid else b"").split()
                if rewrite:
                    words = rewritten(words, doc_id)
                its = find(numbers(words), least)
                counts.append(len(words))
                found.append([r._asdict() for r in its])
                texts.append(b" ".join(collapse(words, its)))
            kind = pa.list_(pa.struct([(c, pa.int64()) for c in Run._fields]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(found, kind), pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return common.map_arrow(rows, run, "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def digest(found: DataFrame) -> DataFrame:
    """The number of runs, the longest one and checksums in place of runs and texts."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("less"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    out = found.withColumn("longest", longest)
    return out.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.back")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.less")).alias("period"),
        F.floor(F.lit(1000) * F.col("longest.length") / -F.col("longest.less")).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        "n_words",
    )


def op11_runs(spark, sf_dir: str) -> DataFrame:
    return digest(map_runs(common.documents(spark, sf_dir), rewrite=True))


def sql(table: str = "documents", least: int = LEAST) -> str:
    """DuckDB SQL for op11_runs: stretches of words that equal those one period before, by distances between equal words."""
    crc = "xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)), lambda x, c: list_reduce([xor(x, c)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0], lambda y, z: CASE WHEN y % 2 = 1 THEN xor(y // 2, 3988292384) ELSE y // 2 END)), 4294967295)"
    return f"""
WITH given AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words, coalesce({crc}, 1) AS h FROM {table}),
placed AS (SELECT r, doc_id, words, len(words) AS n, h % 10 = 0 AND len(words) > 0 AS again, (h // 10) % greatest(len(words), 1) AS a, h // 10 AS g FROM given),
paced AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM placed),
docs AS (SELECT r, doc_id, n, CASE WHEN again THEN list_transform(range(n), lambda i: words[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END]) ELSE words END AS words FROM paced),
tokens AS (SELECT r, n, unnest(words) AS word, unnest(range(n)) AS i FROM docs),
equal AS (SELECT x.r, y.i - x.i AS q, x.i FROM tokens x JOIN tokens y ON x.r = y.r AND x.word = y.word AND x.i < y.i AND 2 * (y.i - x.i) <= x.n),
stretches AS (
  SELECT r, q, min(i) AS start, max(i) - min(i) + 1 + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM equal) GROUP BY r, q, island),
runs AS (SELECT r, start, length, min(q) AS period FROM stretches WHERE length >= greatest({least}, 2 * q) GROUP BY r, start, length),
reach AS (
  SELECT r, i, max(stop) OVER (PARTITION BY r ORDER BY i, stop ROWS UNBOUNDED PRECEDING) AS stop
  FROM (SELECT r, start + period AS i, start + length AS stop FROM runs)),
covered AS (SELECT r, i, max(stop) AS stop FROM reach GROUP BY r, i),
kept AS (
  SELECT t.r, string_agg(t.word, ' ' ORDER BY t.i) AS collapsed
  FROM tokens t ASOF LEFT JOIN covered c ON t.r = c.r AND t.i >= c.i WHERE c.stop IS NULL OR t.i >= c.stop GROUP BY t.r),
told AS (
  SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
    max({{'length': length, 'back': -start, 'less': -period}}) AS best FROM runs GROUP BY r)
SELECT d.doc_id, coalesce(t.n_runs, 0) AS n_runs, CAST(-t.best.back AS BIGINT) AS start, CAST(t.best.length AS BIGINT) AS length, CAST(-t.best.less AS BIGINT) AS period,
  CAST(1000 * t.best.length // -t.best.less AS BIGINT) AS exponent_milli, sha256(coalesce(t.lines, '')) AS runs_sha256, sha256(coalesce(k.collapsed, '')) AS collapsed_sha256, CAST(d.n AS BIGINT) AS n_words
FROM docs d LEFT JOIN told t ON d.r = t.r LEFT JOIN kept k ON d.r = k.r"""
