"""Connected components by alternating large-star and small-star steps, each a join and a partial aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def _large(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours point at the least node around it."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours point at the least of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    joined = edges.join(least, "b")
    return joined.select(F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b")).where("a <> b").distinct()


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """(node, component) of every node of the edges (a, b); the component is its least node.

    Each round is checkpointed in the shared folder; rounds end when the edges stay the same.
    """
    edges = common.settled(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct())
    before = None
    for _ in range(most):
        edges = common.settled(_small(_large(edges)))
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not converge")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
