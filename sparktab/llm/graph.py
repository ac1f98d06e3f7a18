"""Connected components of a large graph by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktab.session import settled


def component_roots(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the links ``a, b`` (long): equal roots, same component.

    Each round points every node at its smallest neighbour, then at that one's, and moves
    the links to the nodes pointed at; links inside a node fall away. Node numbers should
    be hashes: the rounds then grow with the logarithm of the longest chain. Only
    links that are left are shuffled; each round's tables are written, so a lost executor
    costs a read. No links give no rows; repeated links and loops don't matter.
    """
    left = settled(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    roots = None
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        near = settled(both.groupBy("a").agg(F.least("a", F.min("b")).alias("up")), "up")
        above = near.select(F.col("a").alias("up"), F.col("up").alias("top"))
        points = settled(near.join(above, "up", "left").select(F.col("a").alias("node"), F.coalesce("top", "up").alias("root")), "points")
        if roots is None:
            roots = points
        else:
            further = points.select(F.col("node").alias("root"), F.col("root").alias("next"))
            roots = settled(roots.join(further, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "roots")
        moved = left
        for end in ("a", "b"):
            moved = moved.join(points.select(F.col("node").alias(end), F.col("root").alias(f"to_{end}")), end)
        moved = moved.where("to_a <> to_b").select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
        left = settled(moved.distinct(), "links")
    return left.select(F.col("a").alias("node"), F.col("b").alias("root")) if roots is None else roots
