"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is an aggregate of minima (combined before the shuffle) and a join, so a node with very many
neighbours is never gathered in one task. Minima and edges are written to the shared folder: the joins then
have a shuffle of their own on either side, and the adaptive planner splits the part of a hot node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.session import cut_lineage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: every node's neighbours (larger or smaller ones) are hung onto the least node beside it."""
    if large:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = cut_lineage(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
    hung = both.join(least, "a")
    if large:
        moved = hung.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return moved.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node with an edge; the component is its least node. Edges have columns a and b."""
    current = cut_lineage(edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = _mark(current)
    while mark[0]:
        current = cut_lineage(_star(_star(current, large=True), large=False))
        before, mark = mark, _mark(current)
        if before == mark:
            break
    roots = current.select(F.col("b").alias("node")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
