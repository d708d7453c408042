"""Line dedup: passages of several lines that stand earlier in the corpus are removed whole.

The chunks of a text are the overlapping pairs of successive lines that have a word, with the blank lines
between. Contents alone say where they begin and end, so they move with the lines when a text is shifted, and
every repeated passage of two or more such lines is covered wholly by repeated chunks: what longer chunks, cut by
whatever rolling hash, could find is the union of theirs. Chunks are compared by a 128-bit hash over all
documents; those whose hash is found twice or more are then grouped by their bytes too, and of equal ones all but
the first, by doc_id and place, are repeats. Lines of repeats are removed. Chunks that differ although their hashes
agree stay.

The first place of a line stays in any case, as each chunk around it is the first of its kind. So no line is lost
to the corpus, and a copy of a text with two or more such lines loses all its words.

Only hashes of chunks move for the first step, and only bytes of chunks with a repeated hash for the second, where
equal ones become one row in each task before they move. The last step goes by hash again. A chunk that very many
documents share is a row a document there, in a join that Spark can split.

Defined cases: null and empty texts have no chunk and stay as they are; a line with words that stands alone
among new ones is never removed; passages that differ in their blank lines differ; rows that share an id and a
text count as one, so that none is the repeat of the other; rows without an id neither lose chunks nor cause
losses; other columns, whatever their names, pass through ``remove_repeats``.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Lines with a word in a chunk: the fewest that make a passage.
LEAST_LINES = MOST_LINES = 2
#: Up to so many documents' lists are broadcast; more are joined by shuffle.
BROADCAST_DOCS = 500_000


def chunks(text: str | None) -> list[tuple[int, int, int]]:
    """(first line, end line, lines with a word) of each chunk of the text's \\n-split lines, in order."""
    worded = [i for i, line in enumerate((text or "").split("\n")) if line.strip()]
    return [(a, b + 1, LEAST_LINES) for a, b in itertools.pairwise(worded)]


def _name(chunk: bytes) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(chunk)


def _parts(text: str | None) -> Iterator[tuple[int, tuple[int, int, int], bytes]]:
    """(number, extent, bytes) of the chunks that may repeat."""
    lines = (text or "").split("\n")
    for no, (a, b, words) in enumerate(chunks(text)):
        yield no, (a, b, words), "\n".join(lines[a:b]).encode("utf-8", "surrogatepass")


def near(small: DataFrame, bound: int) -> DataFrame:
    """``small`` with a broadcast hint if it has at most ``bound`` rows; else it joins by shuffle."""
    return F.broadcast(small) if small.limit(bound + 1).count() <= bound else small


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, gone): the chunks that each document loses, as an array of (no, name)."""
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, nos, found = [], [], []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for no, _, chunk in _parts(text):
                    ids.append(i)
                    nos.append(no)
                    found.append(_name(chunk))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(nos, pa.int32()), pa.array(found, pa.binary())], ["id", "no", "name"])

    named = common.cut(common.map_arrow(rows, names, "id long, no int, name binary"))
    shared = common.cut(named.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name"))
    wanted = common.cut(named.join(near(shared, BROADCAST_DOCS), "name"))
    wishes = common.cut(wanted.groupBy(F.col("id").alias("wanted_id")).agg(F.collect_set("no").alias("nos")))

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, nos, found = [], [], []
            for i, text, wish in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                wish = set(wish)
                for no, _, chunk in _parts(text):
                    if no in wish:
                        ids.append(i)
                        nos.append(no)
                        found.append(chunk)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(nos, pa.int32()), pa.array([_name(c) for c in found], pa.binary()), pa.array(found, pa.binary())], ["id", "no", "name", "chunk"])

    given = rows.join(near(wishes, BROADCAST_DOCS), F.col("id") == F.col("wanted_id")).select("id", "text", "nos")
    # The comparison of bytes: a name that two different chunks have is left alone.
    whole = common.map_arrow(given, texts, "id long, no int, name binary, chunk binary")
    place = F.struct("id", "no")
    equal = whole.groupBy("name", "chunk").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    first = equal.groupBy("name").agg(F.count("*").alias("n"), F.min("first").alias("first"), F.max("last").alias("last")).where("n = 1 AND first <> last")
    first = common.cut(first.select("name", "first"))
    lost = wanted.join(near(first, BROADCAST_DOCS), "name").where(place != F.col("first"))
    return lost.groupBy("id").agg(F.collect_set("no").alias("gone"))


def strip(text: str | None, gone: set[int]) -> tuple[str | None, dict[str, int]]:
    """The text without the lines of its lost chunks, and counts."""
    extents = chunks(text)
    lines = text.split("\n") if text else []
    lost = [e for no, e in enumerate(extents) if no in gone]
    away = {k for a, b, _ in lost for k in range(a, b)}
    report = {"n_lines": len(lines), "n_chunks": len(extents), "n_removed_chunks": len(lost), "n_removed_lines": len(away)}
    if lost:
        text = "\n".join(line for k, line in enumerate(lines) if k not in away)
    return text, report


REPORT = ("n_lines", "n_chunks", "n_removed_chunks", "n_removed_lines")


def _with_lists(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The documents' columns, then the list of lost chunks."""
    key, gone = common.free(docs.columns, "its_id"), common.free(docs.columns, "gone")
    with common.scratch(docs.sparkSession) as keep:
        lists = keep(repeats(docs, id_col, text_col)).select(F.col("id").alias(key), F.col("gone").alias(gone))
    return docs.join(near(lists, BROADCAST_DOCS), F.col(id_col).cast("long") == F.col(key), "left").drop(key)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", drop_emptied: bool = False) -> DataFrame:
    """The documents without their repeated chunks; on wish, without those that lose all their words thereby."""
    at = docs.columns.index(text_col)
    joined = _with_lists(docs, id_col, text_col)
    schema = T.StructType([*docs.schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keep = [], []
            for text, gone in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
                new = strip(text, set(gone))[0] if gone else text
                texts.append(new)
                keep.append(not (drop_emptied and gone and not new.strip()))
            columns = [pa.array(texts, batch.schema.field(at).type) if k == at else batch.column(k) for k in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1]).filter(pa.array(keep, pa.bool_()))

    return common.map_arrow(joined, run, schema)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, counts of lines and chunks and of removed ones, bytes kept and their SHA-256, for each row."""
    joined = _with_lists(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, sizes, digests = [], [], []
            for text, gone in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                new, counts = strip(text, set(gone or ()))
                data = (new or "").encode("utf-8", "surrogatepass")
                made.append(counts)
                sizes.append(len(data))
                digests.append(hashlib.sha256(data).hexdigest())
            columns = [pa.array([m[c] for m in made], pa.int64()) for c in REPORT]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, pa.array(sizes, pa.int64()), pa.array(digests)], ["doc_id", *REPORT, "kept_bytes", "kept_sha256"])

    return common.map_arrow(joined, run, "doc_id long, " + ", ".join(f"{c} long" for c in REPORT) + ", kept_bytes long, kept_sha256 string")


def op6_line_dedup(spark, sf_dir: str) -> DataFrame:
    return report(common.documents(spark, sf_dir))
