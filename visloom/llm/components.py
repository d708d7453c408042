"""Connected components of an edge table, by alternating large-star and small-star rounds.

Every round is a few joins and aggregations over (node, smallest neighbour) rows, each cut by a checkpoint;
no neighbourhood is gathered. At the end each node that has an edge points at its component's smallest id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to its smallest neighbour or itself."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(u, v) links to (node, component): one row for each node with a link to another."""
    with common.scratch(edges.sparkSession) as keep:
        now = common.cut(edges.where("u <> v").select("u", "v").distinct())
        mark = None
        while True:
            now = common.cut(small_star(large_star(now)))
            seen = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 20)))).first()
            if seen == mark:
                return keep(now.select(F.col("u").alias("node"), F.col("v").alias("component")))
            mark = seen
