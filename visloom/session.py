"""Session factory and table loader."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "visloom") -> SparkSession:
    """A session with the settings that the operators count on: UTC, adaptive plans, state in RocksDB."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    builder = builder.config("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A folder that nothing else uses, where driver and executors all reach it: under spark.checkpoint.dir, or the warehouse where that is unset."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/{name}-{os.urandom(8).hex()}"


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written once to a shared folder, as it is read from there."""
    folder = fresh_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def use_rocksdb(spark: SparkSession) -> None:
    """The state store that operators with several states need. Queries started afterwards use it."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
