"""Helpers that several training-data operators share."""

from __future__ import annotations

import contextlib
import contextvars
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A maximal run of characters that are not ASCII white space, for Java's and RE2's regular expressions.
NONSPACE_WORD = r"[^\x20\x09-\x0D]+"
_TO_LOWER = {ord(u): low for u, low in zip(UPPER, LOWER, strict=True)}


def ascii_lower(text: str) -> str:
    """Lower-case A-Z and nothing else."""
    return text.lower() if text.isascii() else text.translate(_TO_LOWER)


def text_or_empty(column: str | Column = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``use``, inside one expression."""
    return F.element_at(F.transform(F.array(value), use), 1)


def free(columns: list[str], name: str) -> str:
    """``name``, lengthened until none of the columns has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, named in spark.checkpoint.dir; one in the warehouse where none is named, as in tests. Never a folder of one machine's own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/shared-{spark.sparkContext.applicationId}"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a compressed table in the shared folder and go on from there, so that what comes after neither recomputes it nor depends on any executor."""
    spark = df.sparkSession
    path = fresh_path(spark, "cut")
    if paths := _SCRATCH.get():
        paths[-1].append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Paths cut so far, by open scratch; each thread has its own.
_SCRATCH: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("scratch", default=())


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Delete what is cut within at the end. What the given function writes stays, for whoever made the next scratch around this one."""
    outer, mine = _SCRATCH.get(), []
    kept: list[str] = []
    token = _SCRATCH.set((*outer, mine))

    def keep(df: DataFrame) -> DataFrame:
        out = cut(df)
        kept.append(mine.pop())
        return out

    try:
        yield keep
    finally:
        _SCRATCH.reset(token)
        for path in mine:
            drop_path(spark, path)
        if outer:
            outer[-1].extend(kept)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{os.urandom(8).hex()}"


def drop_path(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


#: Arrow batches between the JVM and Python workers hold about so many bytes.
BATCH_BYTES = 2 << 20
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """``df.mapInArrow`` with batches bounded by bytes, as ten thousand texts, Spark's own bound, can be a large part of a worker's
    memory. Spark knows no bound by plan, so the session's is set, unless the session has one."""
    spark = df.sparkSession
    if _BATCH_KEY not in spark.conf.getAll:
        spark.conf.set(_BATCH_KEY, str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
