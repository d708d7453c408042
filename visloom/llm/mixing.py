"""Mixing sources to target weights, with DataFrame functions only.

Each document's size is its number of words. Sources share a target volume by weight; no target
exceeds ``cap`` times its source's size, and what a capped source cannot take goes to the others by
weight (water-filling, solved in closed form over the table of sources). A source's repetition rate is
its target divided by its size: each document is emitted ``floor(rate)`` times, plus one copy more if
a hash-seeded draw falls below the rate's fraction. Of ``seeds`` fixed seeds, each source uses that
whose draw comes nearest its target, so that long documents do not carry a small source off target.

Defined cases: a null text has size 0; null is a source of its own, last in order; equal doc_ids share
a draw; a source of size 0 has target 0 and rate 0, and its documents are not emitted; an empty table
gives an empty result; other columns, whatever their names, pass through ``emit`` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
SEEDS = 16
#: Tables of at most so many sources are broadcast; larger ones join by shuffle, each source's rows in so many parts.
BROADCAST_SOURCES = 10_000
SALTS = 64


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(common.NONSPACE_WORD)).cast("long")


def draw(doc_id: Column, seed: int | Column) -> Column:
    """A number in [0, 1) from a hash of the id and the seed."""
    seed = seed if isinstance(seed, Column) else F.lit(seed)
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("|"), seed.cast("string")))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(16**12))


def copies(rate: Column, u: Column) -> Column:
    whole = F.floor(rate)
    return (whole + F.when(u < rate - whole, 1).otherwise(0)).cast("long")


def source_targets(
    totals: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP
) -> DataFrame:
    """(source, source_size) to (source, source_size, target, rate). One row per source."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    everywhere = Window.partitionBy(F.lit(1))
    by_fill = Window.partitionBy(F.lit(1)).orderBy("fill")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))).cast("int") + 1)
    t = totals.select("source", "source_size", weight.alias("weight"))
    t = t.select("*", (F.lit(float(cap)) * F.col("source_size")).alias("most"), (F.lit(float(share)) * F.sum("source_size").over(everywhere)).alias("volume"))
    t = t.withColumn("fill", F.col("most") / F.col("weight"))
    upto = by_fill.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    t = t.select("*", (F.sum("weight").over(everywhere) - F.sum("weight").over(upto)).alias("rest"), F.sum("most").over(upto).alias("full"))
    # A source is capped if, with the common level at its own fill, the others do not yet take the volume.
    t = t.withColumn("capped", F.col("full") + F.col("fill") * F.col("rest") <= F.col("volume"))
    given = F.coalesce(F.sum(F.when(F.col("capped"), F.col("most"))).over(everywhere), F.lit(0.0))
    open_weight = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(everywhere)
    target = F.when(F.col("capped"), F.col("most")).otherwise(F.col("weight") * ((F.col("volume") - given) / open_weight))
    t = t.select("source", "source_size", target.alias("target"))
    return t.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))


def rates(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    seeds: int = SEEDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> tuple[DataFrame, DataFrame]:
    """The documents' sizes (doc_id, source, size), and per source: source_size, target, rate, seed. Both are written tables."""
    sized = common.cut(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")))
    targets = common.cut(source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap))
    tried = by_source(sized, targets.select("source", "rate", "target"), id_col="doc_id")
    sums = tried.groupBy("source").agg(
        F.first("target").alias("aim"),
        *[F.sum(F.col("size") * copies(F.col("rate"), draw(F.col("doc_id"), k))).alias(f"t{k}") for k in range(seeds)],
    )
    best = F.array_min(F.array(*[F.struct(F.abs(F.col(f"t{k}") - F.col("aim")).alias("off"), F.lit(k).alias("seed")) for k in range(seeds)]))
    return sized, common.cut(by_source(targets, sums.select("source", best["seed"].alias("seed"))))


def by_source(rows: DataFrame, per_source: DataFrame, source_col: str = "source", id_col: str | None = None) -> DataFrame:
    """Join on the source, null included. A table of few sources is broadcast, so that no row of the large side moves. Of more
    sources, each row of the table is repeated ``SALTS`` times, and a source's rows are dealt out by ``id_col``, as one may hold most."""
    few = per_source.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    taken = [*rows.columns, *per_source.columns]
    name, salt, its_salt = (common.free(taken, x) for x in ("its_source", "salt", "its_salt"))
    right = per_source.withColumnRenamed("source", name)
    same = rows[source_col].eqNullSafe(right[name])
    if few or id_col is None:
        return rows.join(F.broadcast(right) if few else right, same).drop(name)
    right = right.withColumn(its_salt, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    left = rows.withColumn(salt, F.pmod(F.xxhash64(F.col(f"`{id_col}`")), F.lit(SALTS)))
    return left.join(right, left[source_col].eqNullSafe(right[name]) & (left[salt] == right[its_salt])).drop(name, salt, its_salt)


def plan(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, rate, copies, taken."""
    sized, chosen = rates(docs, **options)
    out = by_source(sized, chosen, id_col="doc_id")
    out = out.withColumn("copies", copies(F.col("rate"), draw(F.col("doc_id"), F.col("seed"))))
    return out.select("doc_id", "source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def emit(docs: DataFrame, **options) -> DataFrame:
    """The documents themselves, each as often as its rate and draw say."""
    id_col, source_col = options.get("id_col", "doc_id"), options.get("source_col", "source")
    _, chosen = rates(docs, **options)
    rate, seed, n = (common.free(docs.columns, x) for x in ("rate", "seed", "copies"))
    out = by_source(docs, chosen.select("source", F.col("rate").alias(rate), F.col("seed").alias(seed)), source_col, id_col)
    out = out.withColumn(n, copies(F.col(rate), draw(F.col(id_col), F.col(seed))).cast("int")).where(F.col(n) > 0)
    return out.select(*[f"`{c}`" for c in docs.columns], F.explode(F.sequence(F.lit(1), F.col(n))).alias(n)).drop(n)


def op9_mixing(spark, sf_dir: str) -> DataFrame:
    return plan(common.documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def sql(table: str = "documents", seeds: int = SEEDS) -> str:
    """DuckDB SQL for op9_mixing."""
    u = lambda seed: f"('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || {seed}), 1, 12))::BIGINT / {float(16**12)}"
    n = lambda seed: f"CAST(floor(rate) + CASE WHEN {u(seed)} < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT)"
    return f"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM {table}),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
w AS (
  SELECT *, CAST([{', '.join(map(str, WEIGHTS))}][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} AS INT) + 1] AS DOUBLE) AS weight,
    {CAP} * source_size::DOUBLE AS most, {SHARE} * (sum(source_size) OVER ())::DOUBLE AS volume FROM totals),
f AS (SELECT *, most / weight AS fill FROM w),
g AS (
  SELECT *, sum(weight) OVER () - sum(weight) OVER (ORDER BY fill RANGE UNBOUNDED PRECEDING) AS rest,
    sum(most) OVER (ORDER BY fill RANGE UNBOUNDED PRECEDING) AS full_ FROM f),
c AS (SELECT *, full_ + fill * rest <= volume AS capped FROM g),
t AS (
  SELECT source, source_size, CASE WHEN capped THEN most ELSE weight * ((volume - coalesce(sum(CASE WHEN capped THEN most END) OVER (), 0.0))
    / sum(CASE WHEN NOT capped THEN weight END) OVER ()) END AS target FROM c),
r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM t),
tried AS (
  SELECT s.source, k.seed, abs(sum(s.size * {n('k.seed')})::DOUBLE - any_value(target)) AS off
  FROM sized s JOIN r ON s.source IS NOT DISTINCT FROM r.source CROSS JOIN (SELECT unnest(range({seeds})) AS seed) k GROUP BY ALL),
best AS (SELECT source, arg_min(seed, {{'off': off, 'seed': seed}}) AS seed FROM tried GROUP BY source)
SELECT s.doc_id, s.size, r.source_size, r.target, CAST({n('b.seed')} * s.size AS BIGINT) AS taken, s.source, {n('b.seed')} AS copies
FROM sized s JOIN r ON s.source IS NOT DISTINCT FROM r.source JOIN best b ON s.source IS NOT DISTINCT FROM b.source"""
