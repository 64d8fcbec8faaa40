"""Connected components of a graph given as a DataFrame of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.llm.common import kept


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (columns a, b); the component is its smallest node.

    Alternating large-star and small-star steps: every node's larger (then smaller) neighbours
    are tied to its smallest one, until nothing changes. The number of steps grows with the
    logarithm of the longest path. Each step is written to the shared folder, so that lost
    executors repeat one step at most.
    """
    edges = kept(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(
            lower.select("u", F.col("m").alias("v"))).distinct()
        edges = kept(small, "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).groupBy("node").agg(F.min("component").alias("component"))
