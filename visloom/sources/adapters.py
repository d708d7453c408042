"""Domain relations derived from the supplied star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import INT32_MIN, STATIC

N_ACCS = 64
N_CHANNELS = 32
RATIO = 4
CONT_FACTOR = 8
#: Output number of each input baseline; -1 drops it.
PERMUTATION = (2, 0, 1, 3, 6, -1, 4, 5)
#: Labels of the output baselines: antenna name and one letter of polarisation.
LABELS = (("m0h", "m0h"), ("m0v", "m0v"), ("m1h", "m1h"), ("m0h", "m0v"), ("m0h", "m1h"), ("m0v", "m1v"), ("m0v", "m1h"))
#: Static channels of each mask, and the mask of each output baseline (numbers beyond the last mask mean the last).
MASKS = ((3, 17), (3, 17, 20, 21, 22))
MASK_OF = (0, 1, 2, 0, 1, 2, 0)


def _k():
    return F.get_json_object("props", "$.k").cast("int")


def cube(events: DataFrame) -> DataFrame:
    """(dump, channel, cbf_bl, re, im): raw correlator samples, with missing markers and zeros."""
    k, zero = _k(), (F.col("event_type") == "view") & (_k() % 10 == 0)
    missing = (F.col("event_type") == "error") & (k % 4 == 0)
    return events.select(
        F.floor(F.col("event_id") / 256).cast("long").alias("dump"),
        (F.floor(F.col("event_id") / 8) % N_CHANNELS).cast("int").alias("channel"),
        (F.col("event_id") % 8).cast("int").alias("cbf_bl"),
        F.when(missing, INT32_MIN).when(zero, 0).otherwise(F.floor(F.col("value") * 100 + 0.5).cast("int")).alias("re"),
        F.when(zero, 0).otherwise(k - 50).alias("im"),
    )


def permutation(spark) -> DataFrame:
    return spark.createDataFrame(list(enumerate(PERMUTATION)), "cbf_bl int, bl int").where("bl >= 0")


def baselines(spark) -> DataFrame:
    rows = [(k, a, b, MASK_OF[k]) for k, (a, b) in enumerate(LABELS)]
    return spark.createDataFrame(rows, "bl int, input1 string, input2 string, mask_id int")


def channel_masks(spark) -> DataFrame:
    rows = [(m, c, STATIC) for m, channels in enumerate(MASKS) for c in channels]
    return spark.createDataFrame(rows, "mask_id int, channel int, mask_flags int")


def spectra(embeddings: DataFrame) -> DataFrame:
    """(bl, channel, amp): each embedding as the amplitude spectrum of one baseline."""
    return embeddings.select(F.col("vec_id").alias("bl"), F.posexplode("embedding").alias("channel", "x")).select("bl", "channel", F.abs(F.col("x").cast("double")).alias("amp"))


def heaps(events: DataFrame, by_session: bool = False) -> DataFrame:
    """(arrival_seq, kind, ts_raw, frequency, payload): network records, some late, misaligned, broken or repeated; on wish with a ``session``."""
    k = _k()
    hour = F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / 3600).cast("long")
    kind = (
        F.when((F.col("event_type") == "error") & (k % 4 == 0), "incomplete")
        .when((F.col("event_type") == "signup") & (k % 10 == 0), "metadata")
        .when((F.col("event_type") == "signup") & (k % 10 == 1), "no-descriptor")
        .when((F.col("event_type") == "click") & (k % 40 == 0), "bad-heap")
        .when((F.col("event_type") == "click") & (k % 20 == 0), "bad-item")
        .otherwise("data")
    )
    return events.select(
        F.col("event_id").alias("arrival_seq"),
        kind.alias("kind"),
        (hour - F.when(k % 13 == 0, 9).otherwise(0)).alias("ts_raw"),
        ((F.col("user_id") % 4) * 8 + F.when(k % 17 == 0, 1).otherwise(0)).cast("int").alias("frequency"),
        F.floor(F.col("value") * 100 + 0.5).cast("long").alias("payload"),
        *([F.concat(F.lit("s"), (F.floor(F.col("user_id") / 4) % 8).cast("string")).alias("session")] if by_session else []),
    )


def sensors(events: DataFrame) -> DataFrame:
    """(sensor, ts, seq, value): error events as samples of one sensor per user."""
    return events.where("event_type = 'error'").select(
        F.col("user_id").alias("sensor"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("seq"), F.col("value")
    )


def antennas(supplier: DataFrame) -> DataFrame:
    """(number, antenna, east, north, up) in metres."""
    return supplier.select(F.col("s_suppkey").alias("number"), F.concat(F.lit("m"), F.col("s_suppkey").cast("string")).alias("antenna"), F.col("s_acctbal").alias("east"), (F.col("s_nationkey") * 100.0).alias("north"), F.lit(0.0).alias("up"))


def interference(part: DataFrame) -> DataFrame:
    """(fmin, fmax, max_baseline): interference ranges in frequency, up to a baseline length."""
    return part.select(F.col("p_retailprice").alias("fmin"), (F.col("p_retailprice") + F.col("p_size") / 100.0).alias("fmax"), (F.col("p_size") * 200.0).alias("max_baseline"))


def bulk(lineitem: DataFrame) -> DataFrame:
    """(dump, channel, bl, re, im, flags): a larger cube for throughput."""
    return lineitem.select(
        F.floor(F.col("l_orderkey") / 16).cast("long").alias("dump"),
        (F.col("l_partkey") % 64).cast("int").alias("channel"),
        (F.col("l_suppkey") % 16).cast("int").alias("bl"),
        F.col("l_quantity").cast("int").alias("re"),
        F.floor(F.col("l_discount") * 100 + 0.5).cast("int").alias("im"),
        F.when(F.col("l_returnflag") == "R", 16).otherwise(0).alias("flags"),
    )
