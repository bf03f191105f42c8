"""Connected components of a large graph by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmart.session import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b), both long.

    Each round every node moves to the neighbour of the smallest hash if that is
    smaller than its own, and the links are rewritten to the new ends; ends that
    meet drop out. XXH64 of one long is one-to-one, so there are no ties, and as
    the order is random, rounds grow with the logarithm of a component. Every
    round is written to the shared folder, so a lost executor repeats one round.
    """
    links = materialize(links.select("a", "b").where("a <> b").distinct(), "links")
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    roots = nodes.select("node", F.col("node").alias("root"))
    while not links.isEmpty():
        both = links.union(links.select(F.col("b"), F.col("a")))
        best = F.min_by("b", F.xxhash64("b")).alias("best")
        moves = both.groupBy(F.col("a").alias("at")).agg(best)
        moves = moves.where(F.xxhash64("best") < F.xxhash64("at"))
        moves = materialize(moves.select("at", "best"), "moves")
        left = moves.select(F.col("at").alias("a"), F.col("best").alias("x"))
        right = moves.select(F.col("at").alias("b"), F.col("best").alias("y"))
        moved = links.join(left, "a", "left").join(right, "b", "left")
        x, y = F.coalesce("x", "a"), F.coalesce("y", "b")
        moved = moved.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
        links = materialize(moved.where("a <> b").distinct(), "links")
        step = moves.select(F.col("at").alias("root"), "best")
        roots = roots.join(step, "root", "left").select("node", F.coalesce("best", "root").alias("root"))
    return roots
