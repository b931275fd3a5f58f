"""Connected components of edge tables by hooking and contraction, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written


def contract(edges: DataFrame) -> DataFrame | None:
    """(node, root) of every node of edges (a, b), where root is the smallest node of its component; None without edges.

    Each pass hooks every node to its smallest neighbour if that is smaller (no cycles, since parents decrease), jumps
    pointers twice, and replaces nodes by parents; edges inside a tree vanish. At least every second node of a
    component goes in each pass, so passes grow with the logarithm of the longest path.
    """
    both = edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    both = written(both.distinct(), "edges")
    roots: DataFrame | None = None
    while not both.isEmpty():
        sides = both.union(both.select(F.col("b"), F.col("a"))).toDF("node", "other")
        hooked = written(sides.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("parent")), "hooked")
        parents = hooked
        for _ in range(2):
            up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
            parents = parents.join(up, "parent").select("node", F.col("above").alias("parent"))
        parents = written(parents, "parents")
        if roots is None:
            known, roots = None, written(parents.withColumnRenamed("parent", "root"), "roots")
        else:
            moved = parents.withColumnRenamed("node", "root")
            known, roots = roots, written(roots.join(moved, "root", "left").select("node", F.coalesce("parent", "root").alias("root")), "roots")
        left = parents.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        right = parents.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        last, both = both, both.join(left, "a").join(right, "b").filter("pa <> pb")
        both = written(both.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
        discard(hooked, parents, known, last)
    discard(both)
    return roots
