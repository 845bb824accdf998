"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import checkpoint


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One round on edges (u > v): each vertex hands its (larger or other) neighbours to its least one."""
    if large:
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges
    least = near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = near.join(least, "u")
    moved = joined.where("v > u") if large else joined
    out = moved.select(F.col("v").alias("a"), F.col("m").alias("b"))
    if not large:
        out = out.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()


def components(edges: DataFrame, a: str, b: str, rounds: int = 60) -> DataFrame:
    """(id, component): each vertex of an edge with the least vertex of its component.

    Sums and joins only; the edges of one vertex meet in one task of a join, unless Spark splits it as skewed.  The rounds needed
    grow with the logarithm of the graph's size; running out of them is an error, not a cut.  Rounds end with the first edges that are
    stars already, which another round would leave as they are: each of its stages also costs the driver some megabytes of short-lived heap.
    """
    e = checkpoint(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    for left in range(rounds, -1, -1):
        if _stars(e):
            break
        if not left:
            raise RuntimeError(f"no stable components after {rounds} rounds")
        e = checkpoint(_star(_star(e, large=True), large=False))
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether distinct edges (u > v) are stars: each vertex is either the least of all its edges or the greater end of a single one."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("up")).unionByName(edges.select(F.col("v").alias("id"), F.lit(0).alias("up")))
    each = ends.groupBy("id").agg(F.sum("up").alias("up"), F.min("up").alias("least"))
    # a sum over all vertices, not a search for one: that would go through the partitions job by job
    return not each.agg(F.count_if((F.col("up") > 1) | (F.col("up") > F.col("least"))).alias("n")).first().n
