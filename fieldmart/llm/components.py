"""Connected components of a graph that is a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmart.llm.common import Scratch


def connected(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(vertex, root) for every vertex of an edge (a, b): the root is the smallest vertex reachable.

    Alternates two steps until nothing changes: every vertex links its larger neighbours to its
    smallest one, then its smaller neighbours and itself. The rounds grow with the logarithm of
    the longest path. Smallest neighbours are pre-aggregated; each round is written out.
    """
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    now, state, turn = scratch.pin(now, f"{name}-0"), None, 0
    while True:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        turn += 1
        now = scratch.pin(small.union(least.select("a", F.col("m").alias("b"))).distinct(), f"{name}-{turn}")
        found = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        scratch.drop(f"{name}-{turn - 1}")
        if found == state:
            break
        state = found
    roots = now.select(F.col("b").alias("vertex"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("vertex"), F.col("b").alias("root")).union(roots)
