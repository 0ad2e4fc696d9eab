"""Connected components by alternating large-star and small-star steps.

Every step is an aggregation with map-side combine and a join back, so a node with very many
neighbours is split by the skew handling of the join and never collected. A node is a long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.storage import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low"))
    least = least.select("a", F.least("a", "low").alias("low"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b")
    least = down.groupBy("a").agg(F.min("b").alias("low"))
    moved = down.join(least, "a").filter("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionByName(least.select("a", F.col("low").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum"),
    ).first()
    return row["n"], row["sum"]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): root is the smallest node it reaches.

    The steps run until nothing changes; each is stored in the shared folder. Loops are ignored,
    repeated edges are allowed, no edges give no rows.
    """
    stars = materialize(edges.select("a", "b").filter("a <> b").distinct())
    before = _state(stars)
    while before[0]:
        stars = materialize(_small_star(_large_star(stars)))
        now = _state(stars)
        if now == before:
            break
        before = now
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
