"""Connected components of a graph given as an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _directed(e: DataFrame) -> DataFrame:
    return e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _rewired(e: DataFrame, keep) -> DataFrame:
    """Every neighbour b of a that keep() chooses is tied to the smallest of a and a's neighbours instead."""
    least = e.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
    found = e.join(least, F.col("a") == F.col("k"))  # a hub's rows can be split by the join, its minimum is combined on the map side
    return found.where(keep).select(F.col("b").alias("a"), F.col("m").alias("b"))


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, component) for every node with an edge in edges (a, b); the component is its smallest node.

    Rounds are written to the shared folder; only a count and a checksum of a round reach the driver. Loops and
    repeated edges are allowed, null ends are dropped; no edges give no rows.
    """
    now = materialize(edges.select("a", "b").where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    sign = lambda e: e.select(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first()
    before = sign(now)
    for _ in range(rounds):
        large = _rewired(_directed(now), F.col("b") > F.col("a")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("b"))
        small = _rewired(large, F.col("b") != F.col("m")).unionByName(least).distinct()
        now = materialize(small, "edges")
        after = sign(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
