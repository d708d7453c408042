"""The corpus pipeline: quality rules, line dedup, near-dedup, benchmark decontamination, mixing.

Each stage takes the documents that its predecessor kept. Quality rules drop documents they reject. Line
dedup takes repeated chunks out of texts (``n_chars`` follows) and drops documents that lose all their
words thereby, as those words stand in an earlier document. Near-dedup keeps the first document of each
group on five-word shingles at a similarity of 0.8. Decontamination drops documents with a verified
benchmark item. Mixing emits each document as often as its source's rate and its draw say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visloom.llm import common, decontaminate, linededup, mixing, neardup, quality


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = linededup.remove_repeats(docs, drop_emptied=True)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_first(docs, size=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.emit(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mix),
]
#: The forest and the hashed signatures have no SQL; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage. Of what the stages write, only the table that it reads stays."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = common.fresh_path(spark, name)
        with common.scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            common.drop_path(spark, before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
