"""Whitening of embeddings, from an exact scatter matrix in residue numbers.

Entries become integers, so the sums by dimension are exact. Each partition reduces its centred rows
(n times the row less the sums) modulo several primes and multiplies the residues with themselves in blocks
so small that doubles hold every product exactly; Spark adds the cells up, and Chinese remaindering gives the integers that
they stand for. The covariance is thus rounded once, and decomposed in doubles. The primes are as many as the largest
cell that the sums allow needs; the driver sees one row a dimension or cell, whose number the width sets.

Defined cases: rows whose vector is null, or holds null, non-finite or huge entries (beyond ``WIDEST``, whose
integers would not fit 64 bits), go; so do those of another width than most vectors have (of equally frequent widths, the
smallest counts); components whose variance is nothing but rounding have no rows, so a single or constant vector has none;
``deviation`` is null where it does not fit 64 bits; repeated rows count each, null ids stay, other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import prod

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Entries beyond are no embedding; their integers would not fit.
WIDEST = 2.0**50
#: Residues lie within half a prime of zero, so BLOCK products of two of them stay below 2**53.
PRIMES_BELOW, BLOCK = 1 << 21, 1 << 12


def primes(more_than: int, below: int = PRIMES_BELOW) -> list[int]:
    """The largest primes below ``below`` whose product exceeds ``more_than``."""
    out: list[int] = []
    at = below - 1 | 1
    while prod(out) <= more_than:
        at -= 2
        if all(at % k for k in range(3, int(at**0.5) + 1, 2)):
            out.append(at)
    return out


def centred_residues(x: np.ndarray, n: int, sums: list[int], p: int) -> np.ndarray:
    """n * x - sums modulo ``p``, nearest to zero, as doubles."""
    y = (x % p * (n % p) - np.array([s % p for s in sums], np.int64)) % p
    return np.where(y > p // 2, y - p, y).astype(np.float64)


def scatter_residues(x: np.ndarray, n: int, sums: list[int], p: int) -> np.ndarray:
    """Products of the centred columns, summed over these rows modulo ``p``."""
    out = np.zeros((x.shape[1], x.shape[1]), np.int64)
    for k in range(0, len(x), BLOCK):
        y = centred_residues(x[k : k + BLOCK], n, sums, p)
        out = (out + (y.T @ y).astype(np.int64)) % p
    return out


def reconstruct(residues: list[int], moduli: list[int]) -> int:
    """The integer nearest to zero with these residues."""
    whole, value = prod(moduli), 0
    for r, p in zip(residues, moduli, strict=True):
        rest = whole // p
        value += r * rest * pow(rest, -1, p)
    value %= whole
    return value - whole if value > whole // 2 else value


@dataclass
class Whitening:
    n: int
    sums: list[int]
    vectors: np.ndarray  # components in columns
    variances: np.ndarray
    explained: np.ndarray
    farthest: int  # no entry of n * x - sums is larger

    @property
    def width(self) -> int:
        return len(self.sums)


def usable(vector: str = "embedding") -> Column:
    v = F.transform(vector, lambda c: c.cast("double"))
    fits = F.forall(v, lambda c: F.coalesce(F.abs(c) <= WIDEST, F.lit(False)))
    return F.coalesce(fits & ~F.exists(v, F.isnan), F.lit(False))


def integers(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and x, of usable rows."""
    x = F.transform(vector_col, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + SHIFT)
    return rows.where(usable(vector_col)).select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"))


def _matrix(column: pa.ListArray) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def fit(x: DataFrame, components: int = COMPONENTS) -> tuple[DataFrame, Whitening | None]:
    """The rows of the usual width, and what whitens them; None where there is nothing to whiten."""
    widths = x.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), "width").first()
    if widths is None or not widths["width"]:
        return x.where(F.lit(False)), None
    d, n = widths["width"], widths["count"]
    x = x.where(F.size("x") == d)
    wide = F.col("c").cast("decimal(20,0)")
    per = x.select(F.posexplode("x").alias("k", "c")).groupBy("k").agg(F.sum(wide).alias("s"), F.min("c").alias("low"), F.max("c").alias("high")).orderBy("k").collect()
    sums = [int(r["s"]) for r in per]
    farthest = max(max(abs(n * r["low"] - s), abs(n * r["high"] - s)) for r, s in zip(per, sums, strict=True))
    moduli = primes(2 * n * farthest**2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros((d, d), np.int64) for _ in moduli]
        for batch in batches:
            rows = _matrix(batch.column(0))
            if len(rows):
                totals = [(t + scatter_residues(rows, n, sums, p)) % p for t, p in zip(totals, moduli, strict=True)]
        i, j = np.triu_indices(d)
        for k, t in enumerate(totals):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), k, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(t[i, j])], ["k", "i", "j", "r"])

    parts = common.map_arrow(x.select("x"), run, "k int, i int, j int, r long").groupBy("i", "j", "k").agg(F.sum("r").alias("r"))
    cells = parts.groupBy("i", "j").agg(F.sort_array(F.collect_list(F.struct("k", "r"))).alias("rs")).collect()
    scatter = [[0] * d for _ in range(d)]
    for c in cells:
        scatter[c["i"]][c["j"]] = scatter[c["j"]][c["i"]] = reconstruct([r["r"] % p for r, p in zip(c["rs"], moduli, strict=True)], moduli)
    # Both are integers, so each quotient is rounded once.
    cube, trace = n**3, sum(scatter[k][k] for k in range(d))
    if not trace:
        return x, None
    values, vectors = np.linalg.eigh(np.array([[c / cube for c in row] for row in scatter]))
    values, vectors = values[::-1], vectors[:, ::-1]
    used = min(components, int((values > values[0] * d * 2.0**-50).sum()))
    values, vectors = values[:used], vectors[:, :used]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), range(used)])
    return x, Whitening(n, sums, vectors, values, values / (trace / cube), farthest)


def transform(x: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation and whitened (an array by component) of each row."""
    shared = x.sparkSession.sparkContext.broadcast(model)
    small = model.width * model.farthest**2 < 1 << 63 and model.farthest < 1 << 62

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        sums = np.array(m.sums, np.int64 if small else object)
        onto = m.vectors / np.sqrt(m.variances)
        for batch in batches:
            rows = _matrix(batch.column(1))
            if not len(rows):
                continue
            y = (rows if small else rows.astype(object)) * m.n - sums
            deviation = [int(v) if v < 1 << 63 else None for v in (y * y).sum(1)]
            whitened = (y / m.n).astype(np.float64) @ onto
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * onto.shape[1]), pa.array(whitened.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(deviation, pa.int64()), lists], ["vec_id", "deviation", "whitened"])

    return common.map_arrow(x, run, "vec_id long, deviation long, whitened array<double>")


def identity_error(whitened: DataFrame, components: int) -> float:
    """The largest absolute entry of the whitened rows' covariance less the identity."""
    z = [F.col("whitened")[k] for k in range(components)]
    off = [F.abs(F.covar_pop(z[i], z[j]) - float(i == j)) for i in range(components) for j in range(i, components)]
    return whitened.select(F.array_max(F.array(*off)).alias("e")).first()["e"] if components else 0.0


def whiten(rows: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row per usable vector and component."""
    spark = rows.sparkSession
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    with common.scratch(spark) as keep:
        x, model = fit(common.cut(integers(rows, id_col, vector_col)), components)
        if model is None:
            return spark.createDataFrame([], schema)
        out = keep(transform(x, model))
    error = identity_error(out, len(model.variances))
    explained = F.array(*[F.lit(float(e)) for e in model.explained])
    return out.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", F.element_at(explained, F.col("at") + 1).alias("explained"), F.lit(error).alias("identity_error")
    )


def op13_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
