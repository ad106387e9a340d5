"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import written


def _lowest(directed: DataFrame) -> DataFrame:
    return directed.groupBy("a").agg(F.min("b").alias("m"))


def _round(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star over edges with a > b."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    large = (both.join(_lowest(both), "a").where("b > a")
             .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct())
    low = _lowest(large)
    hooked = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hooked.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b long), root the smallest node reachable.

    Every round ends in a written table; two numbers per round reach the driver. The
    rounds end when the edges are stars, which takes about log(longest path) of them.
    """
    edges = written(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    while True:
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if mark == state or not mark[0]:
            break
        state = mark
        edges = written(_round(edges), "stars")
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return leaves.unionByName(leaves.select(F.col("root").alias("node"), "root").distinct())
