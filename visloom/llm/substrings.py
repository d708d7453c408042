"""Suffix-array dedup: bytes covered by a 50-byte string that also starts in an earlier document.

Equal strings of ``LENGTH`` bytes have the same anchor, the smallest hash among the string's ``GRAM``-byte
grams. So only strings whose anchor is found in two documents can repeat, and all equal strings meet in
one anchor's group.

1. Every text's anchors, without repeats and packed by hash range, are counted over all documents.
2. Texts are cut into segments, runs of strings with shared anchors that end where an anchor's own bits say
   so. Equal segments of many documents become one, held by the smallest doc_id: in all other documents the
   whole segment goes.
3. Of the distinct segments, held by their first documents, anchors are counted again. What still has a
   shared anchor is cut into slices, at most ``MOST_STRINGS`` strings of one anchor each. Equal slices become
   one, like equal segments; distinct ones are dealt out by anchor into blocks. An anchor with more slices
   than ``BLOCK_SLICES`` is dealt over several.
4. A block's suffixes are sorted in two stages (``suffixes``), and adjacent common prefixes of ``LENGTH``
   bytes or more join equal strings; those of a larger doc_id than the group's smallest are covered.
5. Where an anchor lies in several blocks, the first holders of each block's strings are compared across
   blocks, by the strings' bytes. So a string comes there once a block, however many slices hold it.
6. The covered runs of each document are joined to its text.

Which segments and slices are equal is told by 128 bits of hash, and by 63 beside an anchor's 48. Shorter keys decide
nothing wrong: ``kind`` tells segments of one document apart, and a place that ``_semi`` takes for another one brings
a segment more, whose bytes its document does hold.

Defined cases: null and empty texts have 0 bytes and nothing to remove; strings repeated only within a
document stay; rows that share an id are told apart by their texts, and do not cover one another; rows
without an id neither lose bytes nor cover any; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .suffixes import repeated_starts

LENGTH = 50
GRAM = 20
MOST_STRINGS = 64
#: Segments end at one in so many anchors, so that near copies have most of theirs in common.
PIECE_ANCHORS = 12
#: Slices in a block, on average and at most of one anchor.
BLOCK_SLICES = 8_000
#: One hash range for so many bytes of text.
RANGE_BYTES = 8 << 20
#: Texts are hashed by pieces of so many bytes: eight bytes of hash for each are to fit a core's own cache.
PIECE_BYTES = 64 << 10
#: Segments are handed on once they hold so many bytes.
BATCH_BYTES = 4 << 20
#: Shared anchors up to this number, those of some 14 GB of documents, are broadcast as a filter; more are joined to the documents by shuffle.
BROADCAST_ANCHORS = 128_000_000
#: A filter's bits for each number, and its bytes at most.
FILTER_BITS = 24
FILTER_BYTES = 96 << 20
#: Other tables of up to so many rows are broadcast.
BROADCAST_ROWS = 20_000
#: So are the lists of removed runs, up to so many runs.
BROADCAST_RUNS = 2_000_000

_U = np.uint64
_BYTE_HASH = np.random.default_rng(50).integers(0, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_M = 0x9E3779B97F4A7C15


def gram_hashes(data: np.ndarray, size: int = GRAM) -> np.ndarray:
    """A hash of the ``size`` bytes from each position on: doubled widths, put together."""
    widths = {1: _BYTE_HASH[data]}
    width = 1
    while 2 * width <= size:
        h = widths[width]
        widths[2 * width] = h[:-width] * _U(pow(_M, width, 1 << 64)) + h[width:]
        width *= 2
    out, done = widths[width], width
    for w in sorted(widths, reverse=True):
        if w < width and size - done >= w:
            out = out[: len(out) - w] * _U(pow(_M, w, 1 << 64)) + widths[w][done : done + len(out) - w]
            done += w
    out = (out ^ (out >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return out ^ (out >> _U(29))


def anchors(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """The anchor of the string from each position on, as 48 mixed bits; empty if the data are shorter."""
    if len(data) < length:
        return np.zeros(0, np.uint64)
    least = gram_hashes(data, gram)
    span, width = length - gram + 1, 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        over = span - width
        least = np.minimum(least[:-over], least[over:])
    return (least * _U(0xA0761D6478BD642F)) >> _U(16)


def _pieces(texts: list[bytes]) -> Iterator[tuple[range, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of at most 65,536 texts and, but for one long text, ``PIECE_BYTES``: their numbers, joined bytes, starts, and the anchor of
    each position (-1 as unsigned where a string would cross a text's end)."""
    first = 0
    while first < len(texts):
        end, held = first, 0
        while end < len(texts) and end - first < 1 << 16 and (end == first or held + len(texts[end]) <= PIECE_BYTES):
            held += len(texts[end])
            end += 1
        data = np.frombuffer(b"".join(texts[first:end]), np.uint8)
        sizes = np.array([len(t) for t in texts[first:end]], np.int64)
        starts = np.cumsum(sizes) - sizes
        found = np.full(len(data), np.iinfo(np.uint64).max)
        made = anchors(data)
        found[: len(made)] = made
        for s, n in zip((starts + sizes).tolist(), sizes.tolist(), strict=True):
            found[s - min(n, LENGTH - 1) : s] = np.iinfo(np.uint64).max
        yield range(first, end), data, starts, found
        first = end


NONE = np.iinfo(np.uint64).max


def _heads(found: np.ndarray) -> np.ndarray:
    """Where a run of equal anchors begins."""
    return np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])) if len(found) else np.zeros(0, np.int64)


def text_anchors(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(anchor, text number), each pair once, piece by piece."""
    for numbers, _, starts, found in _pieces(texts):
        at = _heads(found)
        value = found[at]
        at, value = at[value != NONE], value[value != NONE]
        # Of texts at the same start all but the last are empty. An anchor's 48 bits and a text's 16 are one number.
        text = np.searchsorted(starts, at, side="right") - 1
        both = np.sort(value << _U(16) | text.astype(np.uint64))
        if len(both):
            both = both[np.concatenate([[True], both[1:] != both[:-1]])]
        yield both >> _U(16), (both & _U(0xFFFF)).astype(np.int64) + numbers.start


class Filter:
    """Whether numbers are among some: always so of those, and seldom of others. A number has ``PROBES`` bits in the slice that it is dealt to, so slices are made apart."""

    PROBES = tuple(_U(x) for x in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))

    def __init__(self, bits: np.ndarray, slices: int) -> None:
        self.bits, self.slices = bits, slices

    @staticmethod
    def size(n: int, slices: int) -> int:
        """Bytes of a slice for ``n`` numbers in all."""
        return max(8, min(n * FILTER_BITS // 8, FILTER_BYTES) // slices)

    @staticmethod
    def places(value: np.ndarray, size: int, probe: np.uint64) -> np.ndarray:
        return ((value * probe >> _U(32)) * _U(8 * size) >> _U(32)).astype(np.int64)

    @classmethod
    def slice(cls, value: np.ndarray, size: int) -> np.ndarray:
        held = np.zeros(8 * size, bool)
        for probe in cls.PROBES:
            held[cls.places(value, size, probe)] = True
        return np.packbits(held, bitorder="little")

    def among(self, value: np.ndarray) -> np.ndarray:
        """A mask of the ``value`` that may be among the numbers."""
        size, at = len(self.bits) // self.slices, np.arange(len(value))
        for probe in self.PROBES:
            place = self.places(value[at], size, probe)
            byte = self.bits[(value[at] % _U(self.slices)).astype(np.int64) * size + (place >> 3)]
            at = at[byte >> (place & 7).astype(np.uint8) & 1 == 1]
        out = np.zeros(len(value), bool)
        out[at] = True
        return out


def _held(shared: Filter | list[np.ndarray], value: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Which anchors are shared: those that pass a filter, or those listed for their text."""
    held = value != NONE
    if isinstance(shared, Filter):
        return held & shared.among(value)
    for t in np.unique(text).tolist():
        a, b = np.searchsorted(text, [t, t + 1])
        held[a:b] &= np.isin(value[a:b], shared[t])
    return held


def segments(texts: list[bytes], shared: Filter | list[np.ndarray]) -> Iterator[tuple[int, int, int]]:
    """(text number, start, number of strings) of the runs of strings whose anchors are ``shared``, which is a filter or lists by text. Runs are cut where an anchor's own bits say so."""
    for numbers, _, starts, found in _pieces(texts):
        at = _heads(found)
        value = found[at]
        text = np.searchsorted(starts, at, side="right") - 1
        held = _held(shared, value, text + numbers.start)
        # Heads where a segment begins or ends; unmatched places at each text's end keep texts apart.
        before = np.concatenate([[False], held[:-1]])
        first = held & (~before | (value % _U(PIECE_ANCHORS) == 0))
        last = held & np.concatenate([first[1:] | ~held[1:], [True]])[: len(held)]
        ends = np.append(at[1:], len(found))[last]
        for a, b, t in zip(at[first].tolist(), ends.tolist(), text[first].tolist(), strict=True):
            yield numbers.start + t, a - int(starts[t]), b - a


def slices(texts: list[bytes], shared: Filter | list[np.ndarray]) -> Iterator[tuple[int, int, int, bytes]]:
    """(text number, start, anchor, bytes) of the runs of strings with one anchor, if it is shared."""
    for numbers, data, starts, found in _pieces(texts):
        at = _heads(found)
        ends = np.append(at[1:], len(found))
        value = found[at]
        text = np.searchsorted(starts, at, side="right") - 1
        held = _held(shared, value, text + numbers.start)
        raw = data.tobytes()
        for a, b, v, t in zip(at[held].tolist(), ends[held].tolist(), value[held].tolist(), text[held].tolist(), strict=True):
            for s in range(a, b, MOST_STRINGS):
                yield numbers.start + t, s - int(starts[t]), v, raw[s : min(b, s + MOST_STRINGS) + LENGTH - 1]


# --- Spark ------------------------------------------------------------------------------------------


def shared_anchors(rows: DataFrame, ranges: int) -> DataFrame:
    """(r, packed, n): the anchors found in two rows or more of (owner, tag, data), sorted, by hash range."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held: list[np.ndarray]) -> pa.RecordBatch:
            # The lowest bit says that two rows here have the anchor.
            value, counts = np.unique(np.concatenate(held), return_counts=True)
            value = value << _U(1) | (counts > 1).astype(np.uint64)
            r = (value >> _U(1)) % _U(ranges)
            by = np.argsort(r, kind="stable")
            value, r = value[by], r[by]
            cuts = np.flatnonzero(np.diff(r)) + 1
            heads = r[np.concatenate([[0], cuts])].astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(heads), pa.array([_thin(x) for x in np.split(value, cuts)], pa.binary())], ["r", "packed"])

        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for value, _ in text_anchors(batch.column(0).to_pylist()):
                if len(value):
                    held.append(value)
                    size += len(value)
                if size > 1 << 20:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    def join(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        value = np.sort(np.concatenate([_thick(x) for x in table.column("packed").to_pylist()]))
        anchor = value >> _U(1)
        twice = np.concatenate([anchor[1:] == anchor[:-1], [False]]) | (value & _U(1) == 1)
        out = np.unique(anchor[twice])
        return pa.table({"r": pa.array([key[0].as_py()], pa.int64()), "packed": pa.array([out.astype("<u8").tobytes()], pa.binary()), "n": pa.array([len(out)], pa.int64())})

    return common.map_arrow(rows.select("data"), pack, "r long, packed binary").groupBy("r").applyInArrow(join, "r long, packed binary, n long")


def _thin(value: np.ndarray) -> bytes:
    """Numbers of at most 56 bits in seven bytes each, as hash bits don't compress."""
    return np.ascontiguousarray(value.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7]).tobytes()


def _thick(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 7, 8), np.uint8)
    out[:, :7] = np.frombuffer(data, np.uint8).reshape(-1, 7)
    return out.view("<u8").ravel()


def _filter(packed: DataFrame, n: int, slices: int) -> Broadcast:
    """A filter of the numbers in (r, packed), arrays of 8 bytes each dealt by their remainder r; of ``FILTER_BYTES`` at most, whatever their number."""
    size = Filter.size(n, slices)

    def make(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        value = np.frombuffer(b"".join(table.column("packed").to_pylist()), "<u8")
        return pa.table({"r": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([Filter.slice(value, size).tobytes()], pa.binary())})

    bits = np.zeros(size * slices, np.uint8)
    for row in packed.select("r", "packed").groupBy("r").applyInArrow(make, "r long, bits binary").toLocalIterator(prefetchPartitions=True):
        bits[row["r"] * size : (row["r"] + 1) * size] = np.frombuffer(row["bits"], np.uint8)
    return packed.sparkSession.sparkContext.broadcast(Filter(bits, slices))


class _Lookup:
    """The shared anchors, as a broadcast filter that lets few others pass, or listed for each row by a join where a filter would let many pass.
    Others do no harm: their strings are compared, too."""

    def __init__(self, rows: DataFrame, shared: DataFrame, ranges: int) -> None:
        n = shared.agg(F.sum("n")).first()[0] or 0
        self.filter = None
        if n <= BROADCAST_ANCHORS:
            self.filter = _filter(shared, n, ranges)
            self.rows = rows.select("owner", "tag", "data", F.lit(None).cast("array<long>").alias("wanted"))
            return

        def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for packed in batch.column(0).to_pylist():
                    yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(packed, "<u8").astype(np.int64))], ["anchor"])

        def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for value, text in text_anchors(batch.column(2).to_pylist()):
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(text)), batch.column(1).take(pa.array(text)), pa.array(value.astype(np.int64))], ["o", "g", "anchor"])

        anchors_of = common.map_arrow(rows.select("owner", "tag", "data"), listed, "o long, g long, anchor long")
        wanted = anchors_of.join(common.map_arrow(shared.select("packed"), flat, "anchor long"), "anchor").groupBy("o", "g").agg(F.collect_set("anchor").alias("wanted"))
        self.rows = rows.join(wanted, (F.col("owner") == F.col("o")) & (F.col("tag") == F.col("g"))).select("owner", "tag", "data", "wanted")

    def of(self, batch: pa.RecordBatch):
        if self.filter is not None:
            return self.filter.value
        return [np.sort(np.array(x, np.int64).astype(np.uint64)) for x in batch.column(3).to_pylist()]

    def __getstate__(self):
        return {"filter": self.filter}


def covered(docs: DataFrame) -> DataFrame:
    """(owner, tag, start, n): runs of strings that also start in a row of a smaller owner. ``docs`` has owner, tag, data."""
    total = docs.agg(F.sum(F.length("data"))).first()[0] or 0
    if not total:
        return docs.sparkSession.createDataFrame([], "owner long, tag long, start long, n long")
    ranges = 1 + total // RANGE_BYTES
    look = _Lookup(docs, common.cut(shared_anchors(docs, ranges)), ranges)

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            texts = batch.column(2).to_pylist()
            held: list[tuple] = []
            size = 0

            def flush(held=held, batch=batch):
                number = pa.array([h[0] for h in held], pa.int64())
                return pa.RecordBatch.from_arrays([batch.column(0).take(number), batch.column(1).take(number), pa.array([h[1] for h in held], pa.int64()), pa.array([h[2] for h in held], pa.int64()), pa.array([xxhash.xxh3_128_digest(h[3]) for h in held], pa.binary()), pa.array([h[3] for h in held], pa.binary())], ["owner", "tag", "start", "n", "name", "data"])

            for t, start, n in segments(texts, look.of(batch)):
                piece = texts[t][start : start + n + LENGTH - 1]
                held.append((t, start, n, piece))
                size += len(piece)
                if size >= BATCH_BYTES:
                    yield flush()
                    held.clear()
                    size = 0
            if held:
                yield flush()

    # What carries text is deleted as soon as the next step has what it needs.
    with common.scratch(docs.sparkSession) as keep:
        found = common.cut(common.map_arrow(look.rows, cut_up, "owner long, tag long, start long, n long, name binary, data binary"))
        at = F.xxhash64("owner", "tag", "start").alias("key")
        firsts = common.cut(found.groupBy("name").agg(F.min("owner").alias("least"), F.min_by(at, "owner").alias("key")))
        placed = found.select("owner", "tag", "start", "n", "name").join(_near(firsts.select("name", "least")), "name")
        kind = F.when(F.col("owner") == F.col("least"), F.xxhash64("name")).alias("kind")
        placed = keep(placed.select("owner", "tag", "start", "n", kind))
        # What the first holders of distinct segments share with one another: segments in the place of texts.
        kinds = _semi(found.select(at, "owner", F.xxhash64("name").alias("tag"), "data"), firsts.select("key"))
        kinds = keep(kinds.select("owner", "tag", "data"))
    with common.scratch(docs.sparkSession) as keep:
        inside = keep(_inside(kinds)).select(F.col("owner").alias("first"), F.col("tag").alias("its_kind"), F.col("start").alias("inner"), F.col("n").alias("m"))
    repeated = placed.where("kind IS NULL").select("owner", "tag", "start", "n")
    own = placed.where("kind IS NOT NULL")
    partly = own.join(inside, (own["owner"] == inside["first"]) & (own["kind"] == inside["its_kind"])).select("owner", "tag", (F.col("start") + F.col("inner")).alias("start"), F.col("m").alias("n"))
    return repeated.union(partly)


def _near(small: DataFrame) -> DataFrame:
    """A table of few rows is broadcast; else it joins by shuffle."""
    return F.broadcast(small) if small.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else small


def _semi(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose 64-bit ``key`` is among the keys, and perhaps a few more. As many keys as a filter has room for are sent as one, so that the rows do not move."""
    n = keys.count()
    if n > BROADCAST_ANCHORS:
        return rows.join(keys, "key", "left_semi")
    parts = 1 + n * FILTER_BITS // (8 * RANGE_BYTES)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            r = key % _U(parts)
            found = np.unique(r)
            yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), pa.array([key[r == k].astype("<u8").tobytes() for k in found], pa.binary())], ["r", "packed"])

    wanted = _filter(common.map_arrow(keys, pack, "r long, packed binary"), n, parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(wanted.value.among(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))))

    return common.map_arrow(rows, run, rows.schema)


def _inside(kinds: DataFrame) -> DataFrame:
    """(owner, tag, start, n): runs of strings in the distinct segments (owner, tag, data) that a smaller owner's segment holds."""
    size = kinds.agg(F.sum(F.length("data"))).first()[0] or 0
    ranges = 1 + size // RANGE_BYTES
    look = _Lookup(kinds, common.cut(shared_anchors(kinds, ranges)), ranges)
    # Equal slices are one, like equal segments, and only hashes of slices move for that.
    cut_slices = common.cut(common.map_arrow(look.rows, _slicer(look), "owner long, tag long, start long, n long, anchor long, name long"))
    at = F.xxhash64("owner", "tag", "start")
    distinct = common.cut(cut_slices.groupBy("anchor", "name").agg(F.min("owner").alias("least"), F.min_by(at, "owner").alias("key")))
    of_slice = cut_slices.join(distinct, ["anchor", "name"])
    # Slices of a first holder keep their names, for what the blocks find in them; one of them stands for all.
    first = F.col("owner") == F.col("least")
    of_slice = common.cut(of_slice.select("owner", "tag", "start", "n", F.when(first, F.col("anchor")).alias("anchor"), F.when(first, F.col("name")).alias("name"), (at == F.col("key")).alias("stands")))
    repeated = of_slice.where("name IS NULL").select("owner", "tag", "start", "n")

    # An anchor with one distinct slice has nothing left to compare.
    counts = common.cut(distinct.groupBy("anchor").agg(F.count("*").alias("slices")).where("slices > 1"))
    wanted = of_slice.where("stands").join(counts, "anchor").select(F.col("owner").alias("o"), F.col("tag").alias("g"), "start", "n", "anchor", "name")
    piece = F.substring("data", F.col("start").cast("int") + 1, F.col("n").cast("int") + (LENGTH - 1)).alias("slice")
    texts = common.cut(kinds.join(_near(wanted), (F.col("owner") == F.col("o")) & (F.col("tag") == F.col("g"))).select("owner", "anchor", "name", piece))
    blocks = 1 + texts.count() // BLOCK_SLICES
    wide = counts.where(F.col("slices") > BLOCK_SLICES).select("anchor", F.ceil(F.col("slices") / BLOCK_SLICES).cast("long").alias("parts"))

    def sort_block(table: pa.Table) -> pa.Table:
        slices_, owners = table.column("slice").to_pylist(), table.column("owner").to_numpy()
        covered_, others = repeated_starts(slices_, owners, LENGTH)
        runs = [(*r, None) for r in _runs(covered_)]
        # What is open across blocks: one row a string, with its bytes.
        spread = np.flatnonzero(table.column("spread").to_numpy())
        runs += [(t, k, 1, slices_[t][k : k + LENGTH]) for t in spread.tolist() for k in others[t].tolist()]
        number = pa.array([r[0] for r in runs], pa.int64())
        named = [table.column(c).take(number) for c in ("owner", "anchor", "name")]
        return pa.table([*named, pa.array([r[1] for r in runs], pa.int64()), pa.array([r[2] for r in runs], pa.int64()), pa.array([r[3] for r in runs], pa.binary())], ["owner", "anchor", "name", "inner", "m", "string"])

    dealt = texts.join(_near(wide), "anchor", "left")
    part = F.when(F.col("parts").isNotNull(), F.pmod("name", "parts"))
    dealt = dealt.select("owner", "anchor", "name", "slice", F.col("parts").isNotNull().alias("spread"), F.pmod(F.xxhash64("anchor", part), F.lit(blocks)).alias("block"))
    sorted_ = common.cut(dealt.groupBy("block").applyInArrow(sort_block, "owner long, anchor long, name long, inner long, m long, string binary"))
    runs = sorted_.where("string IS NULL").select("anchor", "name", "inner", "m")
    open_ = sorted_.where("string IS NOT NULL")
    least = open_.groupBy("string").agg(F.min("owner").alias("least"))
    across = open_.join(least, "string").where("owner > least").select("anchor", "name", "inner", "m")
    runs = runs.union(across)
    own = of_slice.where("name IS NOT NULL").join(runs, ["anchor", "name"]).select("owner", "tag", (F.col("start") + F.col("inner")).alias("start"), F.col("m").alias("n"))
    return repeated.union(own)


def _slicer(look: _Lookup):
    """A function for mapInArrow over (owner, tag, data, ...): the slices with a shared anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            held: list[tuple] = []

            def flush(held=held, batch=batch):
                number = pa.array([h[0] for h in held], pa.int64())
                return pa.RecordBatch.from_arrays([batch.column(0).take(number), batch.column(1).take(number), *(pa.array([h[k] for h in held], pa.int64()) for k in range(1, 5))], ["owner", "tag", "start", "n", "anchor", "name"])

            for t, start, anchor, piece in slices(batch.column(2).to_pylist(), look.of(batch)):
                # Signed 63-bit names; slices are told apart by anchor and name together.
                held.append((t, start, len(piece) - LENGTH + 1, anchor, xxhash.xxh3_64_intdigest(piece) >> 1))
                if len(held) >= 50_000:
                    yield flush()
                    held.clear()
            if held:
                yield flush()

    return run


def _runs(starts: list[np.ndarray]) -> list[tuple[int, int, int]]:
    """(number, first, length) of the runs of consecutive places."""
    out = []
    for number, at in enumerate(starts):
        if len(at):
            cuts = np.flatnonzero(np.diff(at) > 1) + 1
            out += [(number, int(x[0]), len(x)) for x in np.split(at, cuts)]
    return out


def remove(data: bytes, runs: list[tuple[int, int]]) -> tuple[bytes, int]:
    """The bytes outside the runs of strings (start, n), and the number of maximal removed runs."""
    if not runs:
        return data, 0
    kept, at, spans = [], 0, 0
    for start, n in sorted(runs):
        end = start + n + LENGTH - 1
        if start > at or not spans:
            kept.append(data[at:start])
            spans += 1
        at = max(at, end)
    kept.append(data[at:])
    return b"".join(kept), spans


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs that touch or overlap within a row's list as one."""
    for batch in batches:
        lists = []
        for runs in batch.column(2).to_pylist():
            out: list[list[int]] = []
            for start, end in sorted((x["start"], x["start"] + x["n"]) for x in runs):
                if out and start <= out[-1][1]:
                    out[-1][1] = max(out[-1][1], end)
                else:
                    out.append([start, end])
            lists.append([{"start": a, "n": b - a} for a, b in out])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lists, batch.column(2).type)], batch.schema.names)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes of each row."""
    data = common.text_or_empty(text_col).cast("binary")
    rows = docs.select(F.col(id_col).cast("long").alias("owner"), F.xxhash64(data).alias("tag"), data.alias("data"))
    with common.scratch(docs.sparkSession) as keep:
        lost = covered(rows.where("owner IS NOT NULL")).groupBy("owner", "tag").agg(F.collect_set(F.struct("start", "n")).alias("lost"))
        lost = lost.select(F.col("owner").alias("o"), F.col("tag").alias("g"), "lost")
        lost = keep(common.map_arrow(lost, _merged, lost.schema))
    few = (lost.agg(F.sum(F.size("lost"))).first()[0] or 0) <= BROADCAST_RUNS
    joined = rows.join(F.broadcast(lost) if few else lost, (F.col("owner") == F.col("o")) & (F.col("tag") == F.col("g")), "left").select("owner", "data", "lost")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [remove(d, [(x["start"], x["n"]) for x in lost or ()]) + (len(d),) for d, lost in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([n for _, _, n in made], pa.int64()), pa.array([n - len(k) for k, _, n in made], pa.int64()), pa.array([s for _, s, _ in made], pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for k, _, _ in made]), pa.array([k for k, _, _ in made], pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return common.map_arrow(joined, run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def op3_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup(common.documents(spark, sf_dir)).drop("kept")
