"""Connected components of an undirected graph in DataFrames: alternating
large-star and small-star steps, which end with every node linked to the
smallest node of its component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.scratch import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    out = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    out = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node of ``edges`` (columns a, b of one orderable
    type): component is the smallest id reachable. Self-links and repeated links
    are harmless; an empty table gives an empty one.

    Each round is written to the shared folder, so lineage doesn't grow and a
    lost executor costs one round at most. The rounds needed grow with the
    logarithm of the number of nodes.
    """
    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = written(edges.select("a", "b").where("a <> b").distinct(), "links")
    seen = state(now)
    while seen[0]:
        now = written(_small_star(_large_star(now)), "links")
        before, seen = seen, state(now)
        if seen == before:
            break
    nodes = now.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return nodes.union(now.select(F.col("b").alias("id"), F.col("b").alias("component"))).distinct()
