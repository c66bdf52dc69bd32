"""Connected components of a distributed edge list by alternating large and small stars.

Every step is a pre-aggregated minimum per node joined back to the edges, and each round is written to the
shared folder.  A hub's edges are only streamed past its minimum, never gathered; they meet it in one task until
its partition is large enough for adaptive execution to split the join.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import materialize


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long, not null) that isn't a root itself;
    the root is the component's smallest node.  Loops and repeated edges are allowed."""
    now = materialize(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    mark = None
    while True:
        now = materialize(_small(_large(now)).distinct(), "stars")
        row = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if tuple(row) == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = tuple(row)
