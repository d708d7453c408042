"""Write-once metadata, attribute lookup along a search path, and output sharding."""

from __future__ import annotations

import contextlib
import io
import json
import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .cadence import mid_timestamp

log = logging.getLogger(__name__)


def normalised(name: str) -> str:
    """Separators of stream names become underscores in keys."""
    return name.replace(".", "_").replace("-", "_")


def lookup(attributes: DataFrame, path: list[str]) -> DataFrame:
    """(key, value): each key's value under the first prefix of the path that has it. ``attributes``: prefix, key, value."""
    order = attributes.sparkSession.createDataFrame([(normalised(p), k) for k, p in enumerate(path)], "prefix string, priority int")
    return attributes.join(F.broadcast(order), "prefix").groupBy("key").agg(F.min_by("value", "priority").alias("value"))


def write_once(existing: DataFrame, new: DataFrame, key: str = "key") -> DataFrame:
    """The rows of ``new`` whose key is not there yet; of several, the first by ``seq``."""
    first = new.groupBy(key).agg(F.min_by("value", "seq").alias("value"))
    return first.join(existing, key, "left_anti")


def sharded(product: DataFrame, shards: int, n_channels: int, channel: str = "channel") -> DataFrame:
    """``substream`` of each row: equal slices of the channels."""
    if n_channels % shards:
        raise ValueError("channels do not divide among the substreams")
    return product.withColumn("substream", F.floor(F.col(channel) / (n_channels // shards)).cast("int"))


def product_rows(product: DataFrame, ratio: int, interval: int, base: int, scale: float, n_channels: int, shards: int = 1, channel0: int = 0) -> DataFrame:
    """A product as it is handed on: ``dump_index``, ``timestamp`` (seconds from the sync time to the middle of the dump), and
    ``substream`` with ``frequency``, the band's number of that slice's first channel. Channels count from the product's start."""
    width = n_channels // shards
    out = sharded(product, shards, n_channels)
    stamps = {"dump_index": F.col("out_idx"), "timestamp": mid_timestamp(F.col("out_idx"), ratio, interval, F.lit(base), scale), "frequency": (F.col("substream") * width + channel0).cast("int")}
    return out.withColumns(stamps).drop("out_idx")


def write_product(rows: DataFrame, path: str) -> None:
    """A folder a substream, so that its reader scans no other."""
    rows.write.partitionBy("substream").mode("append").parquet(path)


#: Bytes of one raw sample (two 32-bit integers), and of one sample of a product (two 32-bit floats, a byte of weight and one of flags).
RAW_BYTES, PRODUCT_BYTES = 8, 10


def observe_samples(flagged: DataFrame, into: Observation) -> DataFrame:
    """The samples; when they have passed, ``into`` has their totals, without a scan of their own."""
    n = F.count("*")
    return flagged.observe(into, n.alias("n_samples"), F.count_if(F.col("flags") != 0).alias("n_flagged"), (n * RAW_BYTES).alias("bytes_in"), F.min("dump").alias("first_dump"), F.max("dump").alias("last_dump"))


def observe_product(product: DataFrame, into: Observation) -> DataFrame:
    n = F.count("*")
    return product.observe(into, n.alias("n_out"), (n * PRODUCT_BYTES).alias("bytes_out"))


#: The attributes that describe a product.
PRODUCT_ATTRIBUTES = (
    "n_chans", "n_chans_per_substream", "n_bls", "bls_ordering", "sync_time", "bandwidth", "center_freq", "channel_range", "int_time", "excise",
    "src_streams", "stream_type", "calibrations_applied", "need_weights_power_scale",
)


def product_attributes(spark, stream: str, values: dict) -> DataFrame:
    """(key, seq, value as JSON) of one product, to be written once. All attributes must be given, and no others."""
    if set(values) != set(PRODUCT_ATTRIBUTES):
        raise ValueError(f"attributes differ: {sorted(set(values) ^ set(PRODUCT_ATTRIBUTES))}")
    rows = [(f"{normalised(stream)}_{k}", n, json.dumps(values[k])) for n, k in enumerate(PRODUCT_ATTRIBUTES)]
    return spark.createDataFrame(rows, "key string, seq long, value string")


#: What a session must know of the system before it starts.
SYSTEM_ATTRIBUTES = ("scale_factor_timestamp", "n_chans", "n_chans_per_substream", "n_accs", "sync_time", "bandwidth", "center_freq", "ticks_between_spectra", "int_time", "bls_ordering", "input_labels")


def system_attributes(attributes: DataFrame, path: list[str], required: tuple[str, ...] = SYSTEM_ATTRIBUTES) -> dict[str, str]:
    """The required attributes along the search path; those that are missing raise. A handful of rows come to the driver."""
    found = {r["key"]: r["value"] for r in lookup(attributes.where(F.col("key").isin(*required)), path).collect()}
    if missing := sorted(set(required) - set(found)):
        raise KeyError(f"no value for {', '.join(missing)}")
    return found


def optional_model(spark, path: str, schema: str) -> DataFrame | None:
    """A model's rows; none, with a warning, if it cannot be found."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        log.warning("no model at %s", path)
        return None


def process_log(name: str, parameters: dict, df: DataFrame) -> str:
    """A reproducible description of a product: its parameters, sorted, its schema and plan."""
    plan = io.StringIO()
    with contextlib.redirect_stdout(plan):
        df.explain("formatted")
    return json.dumps({"name": name, "parameters": parameters, "schema": dict(df.dtypes), "plan": plan.getvalue()}, sort_keys=True, default=str)
