"""Connected components of a link table by alternating star steps (each a grouped minimum and a join)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoframe.llm.storage import checkpointed


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, root)`` of every node with a link; root is the least node of its component.

    Each round hangs larger neighbours, then smaller ones, onto a node's least
    neighbour, until nothing changes (a number of rounds that grows with the
    logarithm of the longest path). A hub's links are never together in one
    task: minima are partial aggregates, and the joins can be split where a
    key is heavy. Every round is a checkpoint.
    """
    edges = checkpointed(links.select(F.least(a, b).alias("v"), F.greatest(a, b).alias("u")).where("u <> v").distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        large = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).where("u <> v").distinct()
        least = _least(large)
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        edges = checkpointed(small)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root")))
