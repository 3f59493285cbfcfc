"""Connected components by alternating large-star and small-star rounds, all in DataFrames.

Each round is two partial-aggregated minima and two equi-joins (AQE splits a hot centre), is
written to the shared folder, and ends when the edge set stops changing.  Nothing is collected
but a count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import Stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (a, b). large: a's larger neighbours point at the minimum; small: a and its smaller ones do."""
    if large:
        near = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    joined = near.join(least, "a")
    if large:
        return joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    to_min = joined.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return to_min.union(least.where(F.col("a") != F.col("m")).select("a", F.col("m").alias("b")))


def components(edges: DataFrame, tag: str = "cc") -> DataFrame:
    """edges (a long, b long) -> (node, component): the least node reachable, for nodes with an edge.

    Self-loops and repeats are harmless; an empty input gives an empty result.
    """
    now = Stored(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), tag)
    seen = None
    while True:
        e = now.read()
        mark = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            break
        seen = mark
        nxt = Stored(_star(_star(e, True).distinct(), False).distinct(), tag)
        now.drop()
        now = nxt
    e = now.read()
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
