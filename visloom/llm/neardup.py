"""Near-duplicates: many universal hash minima with banding, verification, and connected components.

1. ``signatures``: the shingle set of each whole text, its size, a 128-bit hash of the set, and the low 16
   bits of ``HASHES`` hash minima. Equal sets are one class from here on, named by its smallest id.
2. Classes that agree on the ``ROWS`` minima of any of ``BANDS`` bands share a bucket. At a similarity of
   0.8 a pair shares none with a probability below 1e-7.
3. In a bucket all members are compared with one pivot, the smallest id, not with one another. Pairs whose
   signatures nearly agree are confirmed on their full sets, and joined to components by large-star and
   small-star rounds. That settles buckets of two, and most members of the others.
4. The rest is exact. Members of a bucket that lie in several components go to the cell of the bucket's largest
   one. Shingles that half of a cell's members have are its consensus. Two sets' intersection is the consensus
   without what either lacks of it, plus what both lack, plus what both have beside it. So a pair is similar if and
   only if it shares as many items, things lacked or had beside, as the sum of two weights, one of each member.
   Weights that cancel need no shared item; all such members are similar to the lightest one, and get one link with
   it. Others are found by a join on the rarest of their items, and no pair within one component is made.

Defined cases: null or empty texts have an empty set, are linked with nothing and kept; a text with fewer
words than a shingle is one shingle; rows that share an id share its component; a null id is left alone
(its component is null, and it is kept); other columns, whatever their names, pass through ``keep_first``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .components import connected

HASHES = 128
ROWS = 4
BANDS = HASHES // ROWS
#: A pair at the threshold falls below this share of equal minima with a probability under 1e-6.
MARGIN = 0.18
#: A cell's members have so many steps of weight.
WEIGHT_STEPS = 8
#: Items left to a member beyond the first that a pair must share: a candidate shares so many more.
MORE_ITEMS = 2
#: Members of a cell that meet its consensus in one part.
PART_MEMBERS = 5_000
#: Weights are sums of multiples of a fraction; what is below this is rounding.
ROUNDING = 1e-6
#: Up to so many ids are broadcast to pick the texts that pairs need; more are joined by shuffle.
BROADCAST_IDS = 1_000_000
#: Hashes of so many words are held by a worker.
KNOWN_WORDS = 20_000
SEED = 7

_RNG = np.random.default_rng(SEED)
_A = _RNG.integers(1, 2**63, HASHES, dtype=np.uint64) | np.uint64(1)
_B = _RNG.integers(0, 2**63, HASHES, dtype=np.uint64)
_WORD_A = np.random.default_rng(SEED + 1).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def shingles(text: str | None, size: int, known: dict[bytes, int]) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles. ``known`` holds hashes of words between calls."""
    import xxhash

    words = common.ascii_lower(text or "").encode("utf-8", "surrogatepass").split()
    if not words:
        return np.zeros(0, np.uint64)
    hashed = np.empty(len(words), np.uint64)
    for i, w in enumerate(words):
        h = known.get(w)
        if h is None:
            if len(known) >= KNOWN_WORDS:
                known.clear()
            h = known[w] = xxhash.xxh3_64_intdigest(w)
        hashed[i] = h
    size = min(size, len(words))
    n = len(words) - size + 1
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = (out ^ (out >> np.uint64(29))) * _WORD_A[k % 64] + hashed[k : k + n]
    out = (out ^ (out >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return np.unique(out ^ (out >> np.uint64(29)))


def minima(hashes: np.ndarray) -> np.ndarray:
    """The smallest value under each universal hash function, as its low 16 bits."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(hashes), 2048):
        part = hashes[start : start + 2048]
        np.minimum(least, ((part[:, None] * _A + _B) >> np.uint64(24)).min(0), out=least)
    return (least & np.uint64(0xFFFF)).astype("<u2")


def signatures(docs: DataFrame, size: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, set_hash, minima of each row; the last two null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        known: dict[bytes, int] = {}
        for batch in batches:
            sizes, names, least = [], [], []
            for text in batch.column(1).to_pylist():
                s = shingles(text, size, known)
                sizes.append(len(s))
                names.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                least.append(minima(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(names, pa.binary()), pa.array(least, pa.binary())], ["doc_id", "n_shingles", "set_hash", "minima"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return common.map_arrow(rows, run, "doc_id long, n_shingles long, set_hash binary, minima binary")


def shingle_sets(docs: DataFrame, ids: DataFrame, size: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, shingles) of the documents in ``ids`` (a column ``id`` without repeats), a row an id."""
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = rows.join(F.broadcast(ids) if few else ids, "id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            sets = [shingles(t, size, known).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["id", "shingles"])

    return common.map_arrow(rows, run, "id long, shingles binary")


def _few(small: DataFrame) -> DataFrame:
    """Narrow rows with a broadcast hint if they are at most ``BROADCAST_IDS``; else they join by shuffle."""
    return F.broadcast(small) if small.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else small


def _passing(pairs: DataFrame, dtype: str, test) -> DataFrame:
    """The pairs (a, b, x, y) whose binary columns x and y pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [test(np.frombuffer(x, dtype), np.frombuffer(y, dtype)) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return common.map_arrow(pairs.select("a", "b", "x", "y"), run, "a long, b long")


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, for sorted distinct values."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = np.sort(np.concatenate([x, y]), kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(x) + len(y) - shared)


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, size: int, percent: int, **names) -> DataFrame:
    """The candidate pairs (a, b) that are similar: by signature first, then on full sets."""
    side = lambda s, i, c: classes.select(F.col("rep").alias(i), F.col("minima").alias(c))
    least = percent / 100 - MARGIN
    near = _passing(pairs.join(side(classes, "a", "x"), "a").join(side(classes, "b", "y"), "b"), "<u2", lambda x, y: (x == y).mean() >= least)
    near = common.cut(near)
    ids = near.select(F.col("a").alias("id")).union(near.select(F.col("b").alias("id"))).distinct()
    sets = common.cut(shingle_sets(docs, ids, size, **names).dropDuplicates(["id"]))
    both = near.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a").join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b")
    return _passing(both, "<u8", lambda x, y: similar(x, y, percent))


def _sets_of_cells(cells: DataFrame, docs: DataFrame, size: int, **names) -> DataFrame:
    """(cell, rep, component, members, n, part, shingles): the members of cells with their sets. Cells of many members are in parts."""
    sizes = common.cut(cells.groupBy("cell").agg(F.count("*").alias("members")))
    sets = shingle_sets(docs, cells.select(F.col("rep").alias("id")).distinct(), size, **names).dropDuplicates(["id"])
    rows = cells.join(_few(sizes), "cell").join(sets.select(F.col("id").alias("rep"), "shingles"), "rep")
    return rows.withColumn("part", F.expr(f"pmod(rep, 1 + members div {PART_MEMBERS})"))


def _consensus(rows: DataFrame) -> DataFrame:
    """(cell, part, agreed): the shingles that half of a cell's members have, once for each part of the cell."""

    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell, members, data in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                values = np.frombuffer(data, "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), cell)), pa.array(np.full(len(values), members)), pa.array(values)], ["cell", "members", "shingle"])

    held = common.map_arrow(rows.select("cell", "members", "shingles"), flat, "cell long, members long, shingle long")
    agreed = held.groupBy("cell", "members", "shingle").agg(F.count("*").alias("df")).where("2 * df >= members")
    whole = agreed.groupBy("cell", "members").agg(F.collect_list("shingle").alias("agreed"))
    return whole.select("cell", F.explode(F.expr(f"sequence(0L, members div {PART_MEMBERS})")).alias("part"), "agreed")


def _differences(rows: DataFrame, agreed: DataFrame) -> DataFrame:
    """(cell, rep, component, weight, item): a row with a null item for each member, and one for each shingle that
    it lacks of the consensus or has beside it. Two members' sets have at least the intersection that similar ones
    need if and only if they share as many items as their weights' sum."""
    kept = ["cell", "rep", "component"]

    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, data in enumerate(batch.column(4).to_pylist()):
                own = np.frombuffer(data, "<i8")
                core = batch.column(6)[k].values.to_numpy() if batch.column(6)[k].is_valid else np.zeros(0, np.int64)
                items = np.setxor1d(own, core, assume_unique=True)
                # what sets of these sizes have in common: half the consensus each, without what each lacks of it
                shared = (len(own) + len(core) - len(items)) // 2
                weight = batch.column(5)[k].as_py() * len(own) + len(core) / 2 - shared
                n = len(items) + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, batch.column(j)[k].as_py())) for j in range(3)]
                    + [pa.array(np.full(n, weight)), pa.concat_arrays([pa.nulls(1, pa.int64()), pa.array(items, pa.int64())])],
                    [*kept, "weight", "item"],
                )

    return common.map_arrow(rows.join(agreed, ["cell", "part"], "left").select(*kept, "n", "shingles", "share", "agreed"), flat, "cell long, rep long, component long, weight double, item long")


def _candidates(cells: DataFrame, docs: DataFrame, size: int, percent: int, **names) -> DataFrame:
    """Pairs (x, y) of a cell's members, in different components and one of them outside the cell's own, that can
    be similar by what they lack of the cell's consensus and have beside it. cells: (cell, rep, component, n)
    without repeats."""
    rows = common.cut(_sets_of_cells(cells, docs, size, **names).withColumn("share", F.lit(percent / (100 + percent))))
    apart = common.cut(_differences(rows, _consensus(rows)))
    spread = apart.where("item IS NOT NULL").groupBy("cell", "item").agg(F.count("*").alias("df"), (F.min("component") != F.max("component")).alias("across")).where("df > 1 AND across")
    marked = common.cut(apart.join(spread.drop("across"), ["cell", "item"]))
    counts = marked.groupBy("cell", "rep").agg(F.count("*").alias("items"))
    own = common.cut(apart.where("item IS NULL").drop("item").join(counts, ["cell", "rep"], "left").fillna(0, ["items"]))

    # Weights that cancel make a pair certain; then each of the two is similar to the lightest member, so links with it do.
    lightest = F.struct("weight", "rep", "component")
    bounds = common.cut(own.groupBy("cell").agg(F.min(lightest).alias("light"), F.max("weight").alias("most")))
    bounds = bounds.select("cell", F.col("light.weight").alias("least"), F.col("light.rep").alias("light"), F.col("light.component").alias("light_component"), F.greatest((F.col("most") - F.col("light.weight")) / WEIGHT_STEPS, F.lit(1.0)).alias("width"))
    own = own.join(_few(bounds), "cell")
    certain = own.where(f"component <> light_component AND weight + least <= {ROUNDING}").select(F.col("light").alias("x"), F.col("rep").alias("y"))

    # The others share an item among those that each has left without its commonest ones, one fewer than both need: that
    # number is stated for each step of the partner's weight. Some items more are left, so that a pair has to share several.
    own = own.withColumn("mine", F.least(F.floor((F.col("weight") - F.col("least")) / F.col("width")), F.lit(WEIGHT_STEPS - 1)))
    needs = F.transform(F.sequence(F.lit(0), F.lit(WEIGHT_STEPS - 1)), lambda s: F.struct(s.cast("long").alias("theirs"), F.greatest(F.ceil(F.col("weight") + F.col("least") + s * F.col("width") - ROUNDING), F.lit(1)).alias("need")))
    own = common.cut(own.withColumn("needs", F.filter(needs, lambda s: s.need <= F.col("items"))).where("size(needs) > 0").select("cell", "rep", "weight", "items", "mine", "needs"))
    ranked = marked.drop("weight").join(own, ["cell", "rep"]).withColumn("place", F.row_number().over(Window.partitionBy("cell", "rep").orderBy(F.desc("df"), "item")))
    probes = ranked.withColumn("step", F.explode("needs")).withColumn("skip", F.greatest(F.col("step.need") - 1 - MORE_ITEMS, F.lit(0))).where("place > skip")
    probes = common.cut(probes.select("cell", "item", "mine", F.col("step.theirs").alias("theirs"), "rep", "component", "weight", "items", "skip"))
    sides = ("rep", "component", "weight", "items", "skip")
    x = probes.where("component <> cell").select("cell", "item", F.col("mine").alias("one"), F.col("theirs").alias("other"), *[F.col(c).alias(f"x_{c}") for c in sides])
    y = probes.select("cell", "item", F.col("theirs").alias("one"), F.col("mine").alias("other"), *[F.col(c).alias(f"y_{c}") for c in sides])
    least = F.col("x_weight") + F.col("y_weight")
    possible = (F.col("x_component") != F.col("y_component")) & (least > 0) & (F.least("x_items", "y_items") >= least - ROUNDING)
    twice = (F.col("y_component") == F.col("cell")) | (F.col("x_rep") < F.col("y_rep"))
    met = x.join(y, ["cell", "item", "one", "other"]).where(possible & twice)
    met = met.groupBy("cell", "x_rep", "y_rep", "x_weight", "y_weight").agg(F.count("*").alias("both"), F.max(F.greatest("x_skip", "y_skip")).alias("skipped"))
    met = met.where(F.col("both") + F.col("skipped") >= least - ROUNDING)
    return met.select(F.col("x_rep").alias("x"), F.col("y_rep").alias("y")).union(certain)


def classes_of(found: DataFrame) -> DataFrame:
    """Equal sets as one class: set_hash, rep (smallest id), minima, n_shingles."""
    rows = found.where("doc_id IS NOT NULL AND set_hash IS NOT NULL")
    return rows.groupBy("set_hash").agg(F.min("doc_id").alias("rep"), F.min("minima").alias("minima"), F.min("n_shingles").alias("n_shingles"))


def _near_duplicates(docs: DataFrame, size: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    names = {"id_col": id_col, "text_col": text_col}
    found = common.cut(signatures(docs, size, **names))
    classes = common.cut(classes_of(found))
    bands = F.array(*[F.xxhash64(F.lit(b), F.substring("minima", 2 * ROWS * b + 1, 2 * ROWS)) for b in range(BANDS)])
    members = classes.select("rep", F.explode(bands).alias("bucket"))
    shared = common.cut(members.groupBy("bucket").agg(F.count("*").alias("size"), F.min("rep").alias("pivot")).where("size > 1"))
    placed = common.cut(members.join(shared, "bucket"))

    def pairs(a: str, b: str, rows: DataFrame) -> DataFrame:
        return rows.where(f"{a} <> {b}").select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()

    tried = common.cut(pairs("rep", "pivot", placed))
    links = common.cut(confirmed(tried, classes, docs, size, percent, **names).select(F.col("a").alias("u"), F.col("b").alias("v")))
    first = connected(links)

    # The exact rest, over buckets whose members lie in several components.
    where = placed.where("size > 2").select("bucket", "rep").join(first.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    where = common.cut(where)
    counts = where.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    largest = common.cut(counts.groupBy("bucket").agg(F.count("*").alias("components"), F.max_by("component", F.struct("n", "component")).alias("cell")).where("components > 1"))
    cells = where.join(largest.select("bucket", "cell"), "bucket").select("cell", "rep", "component").distinct()
    cells = common.cut(cells.join(classes.select("rep", F.col("n_shingles").alias("n")), "rep"))
    rest = pairs("x", "y", _candidates(cells, docs, size, percent, **names)).join(tried, ["a", "b"], "left_anti")
    more = confirmed(common.cut(rest), classes, docs, size, percent, **names).select(F.col("a").alias("u"), F.col("b").alias("v"))
    joined = connected(first.select(F.col("node").alias("u"), F.col("component").alias("v")).union(more))

    named = classes.select("set_hash", "rep").join(joined.withColumnRenamed("node", "rep"), "rep", "left").select("set_hash", F.coalesce("component", "rep").alias("component"))
    out = found.select("doc_id", "n_shingles", "set_hash").join(named, "set_hash", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept of each row."""
    with common.scratch(docs.sparkSession) as keep:
        return keep(_near_duplicates(docs, size, percent, id_col, text_col))


def keep_first(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without the near-duplicates of others: one id of each group stays."""
    name = common.free(docs.columns, "gone")
    gone = common.cut(near_duplicates(docs, size, percent, id_col, text_col).where("NOT kept").select(F.col("doc_id").alias(name)).distinct())
    few = gone.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return docs.join(F.broadcast(gone) if few else gone, F.col(id_col).cast("long") == F.col(name), "left_anti")


def op8_near_duplicates(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(common.documents(spark, sf_dir), size=2, percent=80)
