"""Connected components by alternating large-star and small-star steps; edges never leave the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootline.llm.common import Stored, hold, keep, scratch, stored


# The least neighbours are stored before they are joined: a node with very many links is then one row on one side, and
# the other side can be split, or isn't shuffled at all where the stored side is small.


def _large_star(edges: DataFrame, label: str) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), f"{label}-least").df
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame, label: str) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = stored(down.groupBy("a").agg(F.min("b").alias("m")), f"{label}-least").df
    return down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))


def _stars(edges: DataFrame) -> bool:
    """Whether each edge (a, b: less than a) is the only one down from a, and none goes down from b: nothing is left to do."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(edges.select("b", F.lit(0), F.lit(1)))
    per = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return per.agg(F.count_if((F.col("down") > 1) | ((F.col("down") > 0) & (F.col("up") > 0)))).first()[0] == 0


def components(edges: DataFrame, label: str = "components", most: int = 60) -> DataFrame:
    """Edges (a, b: long) -> (node, component): the smallest node that each node of an edge reaches.

    Self links and repeated edges are fine; nodes without links have no row. Each round is written to the shared folder,
    so a lost executor costs one round at most. It ends when the edges are stars, without a further round that changes
    nothing. Raises if ``most`` rounds don't make them stars.
    """
    now: Stored = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    for _ in range(most):
        if _stars(now.df):
            break
        with scratch():
            large = stored(_large_star(now.df, label), label)  # as many rows as edges; the small star's are made distinct
            after = stored(_small_star(large.df, label).where("a <> b").distinct(), label)
            keep(after)
        hold(after)
        now.drop()
        now = after
    else:
        if not _stars(now.df):
            raise RuntimeError(f"components: no fixed point after {most} rounds")
    return now.df.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.df.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
