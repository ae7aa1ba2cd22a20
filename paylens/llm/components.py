"""Connected components of a table of links, by alternating star operations.

Large-star links the larger neighbours of every node to its least neighbour,
small-star the smaller ones; repeated, every node ends up linked to the least
node of its component.  Each step is a grouped minimum and a join; nothing is
collected, and a node with many links is only ever reduced to its minimum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.llm.common import saved


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """links: a > b.  Large-star takes all neighbours, small-star the smaller ones."""
    near = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        near = near.unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    moved = near.join(least, "u")
    moved = moved.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")) if large else (
        moved.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))))
    return moved.filter("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, component (its least node) of every node of ``links`` (a, b: long)."""
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    before = None
    edges = saved(edges, "edges")
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()  # a row
        if state == before:
            break
        before = state
        edges = saved(_stars(_stars(edges, True), False), "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
