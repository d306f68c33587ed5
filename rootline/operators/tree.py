"""Trees (child, parent) with one parent for each child, in rounds that double the distance looked at.

A round joins each node's pointer, to the ancestor 2^k levels up, with that ancestor's own pointer, so a chain of a million
levels takes 20 rounds and no pair of ancestor and node is ever a row. Sums over subtrees, sums along paths, and the nearest
marked ancestor are carried along. Labels number the nodes depth first: a node's subtree is the range [pre, pre + size), so tests
for ancestors, roll-ups and order are comparisons of numbers.

Nodes on or under a cycle have no root and no label. Null ids are passed over; repeated edges count once.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rootline.operators.shared import shared_table


def _nodes(edges: DataFrame) -> DataFrame:
    """(node, up): each node once, roots without up."""
    own = edges.where("child is not null and parent is not null").select("child", "parent").distinct()
    every = own.select(F.col("child").alias("node"), F.col("parent").alias("up")).union(own.select(F.col("parent").alias("node"), F.lit(None).cast(own.schema["parent"].dataType).alias("up")))
    return every.groupBy("node").agg(F.min("up").alias("up"))


def _doubled(state: DataFrame, merge: dict[str, Callable[[Column, Column], Column]], before: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Rounds until no pointer is left, or as many as a tree of these nodes can need: what then has one is at a cycle.

    state (node, up, ...); ``merge``: how a column takes in that of the node pointed to; ``before``: what else a round does first.
    """
    now = shared_table(state, "tree")
    for _ in range(math.ceil(math.log2(now.count() + 1)) + 1):
        if now.where("up is not null").isEmpty():
            break
        # roots and nodes that have arrived aren't joined: they would all have one key; a stored table looks small enough to be
        # broadcast long after its rows aren't
        there, going = now.where("up is null"), now.where("up is not null")
        target = now.select(F.col("node").alias("up"), F.col("up").alias("_up"), *[F.col(c).alias(f"_{c}") for c in merge])
        moved = going.join(target.hint("merge"), "up").select("node", F.col("_up").alias("up"), *[(merge[c](F.col(c), F.col(f"_{c}")) if c in merge else F.col(c)).alias(c) for c in now.columns[2:]])
        after = there.unionByName(moved)
        now = shared_table(before(now, after) if before else after, "tree")
    return now


def roots(edges: DataFrame) -> DataFrame:
    """(node, root, depth); nodes at a cycle aren't there."""
    state = _nodes(edges).select("node", "up", F.coalesce("up", "node").alias("root"), F.when(F.col("up").isNull(), 0).otherwise(1).cast("long").alias("depth"))
    done = _doubled(state, {"root": lambda _, far: far, "depth": lambda a, b: a + b})
    return done.where("up is null").drop("up")


def subtree_sums(edges: DataFrame, values: DataFrame, value: str) -> DataFrame:
    """(node, total): the sum of a value (node, value) over each node's subtree; nodes without any value below have no row."""
    own = values.groupBy("node").agg(F.sum(value).alias("total"))
    state = _nodes(edges).join(own, "node", "left").select("node", "up", "total")

    def gather(now: DataFrame, after: DataFrame) -> DataFrame:
        """Each node adds what the nodes pointing to it have: the nodes twice as many levels down."""
        more = now.where("up is not null and total is not null").groupBy(F.col("up").alias("node")).agg(F.sum("total").alias("_more"))
        kind = now.schema["total"].dataType
        return after.join(more, "node", "left").select("node", "up", F.when(F.col("total").isNull(), F.col("_more")).otherwise(F.col("total") + F.coalesce("_more", F.lit(0))).cast(kind).alias("total"))

    return _doubled(state, {}, gather).where("up is null and total is not null").drop("up")


def nearest(edges: DataFrame, wanted: DataFrame, strict: bool = True) -> DataFrame:
    """(node, found): the nearest ancestor among the wanted (node) rows; itself only if not strict."""
    marked = wanted.select("node").where("node is not null").distinct()
    mark = lambda df, key, name: df.join(marked.select(F.col("node").alias(key), F.col("node").alias(name)), key, "left")
    state = mark(_nodes(edges), "up", "found")
    if not strict:
        state = mark(state, "node", "_own").withColumn("found", F.coalesce("_own", "found"))
    # who has found one needs to look no further
    state = state.select("node", F.when(F.col("found").isNull(), F.col("up")).alias("up"), "found")
    return _doubled(state, {"found": lambda near, far: F.coalesce(near, far)}).where("up is null and found is not null").drop("up")


def _before(df: DataFrame, group: str, order: str, size: str, name: str) -> DataFrame:
    """The sum of a column over the rows of a group that come earlier: inside parts of a sort by range, and from part to part, so
    that no task needs a whole group."""
    cut = shared_table(df.repartitionByRange(group, order).withColumn("_part", F.spark_partition_id()), "siblings")
    earlier = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    parts = cut.groupBy(group, "_part").agg(F.sum(size).alias("_sum"))
    parts = parts.select(F.col(group).alias("_g"), F.col("_part").alias("_p"), F.coalesce(F.sum("_sum").over(earlier(group, "_part")), F.lit(0)).alias("_start"))
    own = cut.withColumn("_own", F.coalesce(F.sum(size).over(earlier(group, "_part", order)), F.lit(0)))
    met = own.join(parts, own[group].eqNullSafe(parts["_g"]) & (own["_part"] == parts["_p"]))
    return met.withColumn(name, F.col("_own") + F.col("_start")).drop("_own", "_part", "_g", "_p", "_start")


def running(df: DataFrame, order: str, value: str, name: str) -> DataFrame:
    """The sum of a value over all rows that have a lesser place in the order, in parts of a sort by range."""
    total = df.groupBy(order).agg(F.sum(value).alias("_value")).withColumn("_all", F.lit(0))
    return df.join(_before(total, "_all", order, "_value", name).select(order, name), order)


def labels(edges: DataFrame, order: DataFrame | None = None) -> DataFrame:
    """(node, parent, root, depth, pre, size): nodes numbered from 0 depth first, siblings and roots by ``order`` (node, order) or
    by their names; a node's subtree has the numbers from pre to pre + size - 1."""
    have = roots(edges)
    own = _nodes(edges).join(have.select("node", "root", "depth"), "node")
    sizes = subtree_sums(edges, have.select("node", F.lit(1).cast("long").alias("size")), "size").withColumnRenamed("total", "size")
    own = own.join(sizes, "node")
    own = own.withColumn("order", F.col("node")) if order is None else own.join(order.select("node", "order"), "node", "left")
    own = own.withColumn("_order", F.struct("order", "node"))
    own = _before(own, "up", "_order", "size", "earlier").select("node", "up", F.col("up").alias("parent"), "root", "depth", "size", (F.col("earlier") + F.when(F.col("up").isNull(), 0).otherwise(1)).alias("pre"))
    return _doubled(own, {"pre": lambda a, b: a + b}).select("node", "parent", "root", "depth", "pre", "size")


def below(labelled: DataFrame, node) -> DataFrame:
    """The labels of a node's subtree, itself included: a range of numbers."""
    top = labelled.where(F.col("node") == F.lit(node)).select(F.col("pre").alias("_a"), (F.col("pre") + F.col("size")).alias("_z"))
    return labelled.join(F.broadcast(top), (F.col("pre") >= F.col("_a")) & (F.col("pre") < F.col("_z"))).drop("_a", "_z")  # one row


def is_below(a: str, b: str) -> Column:
    """Whether the labels in struct column b are of a's subtree."""
    return (F.col(f"{b}.pre") >= F.col(f"{a}.pre")) & (F.col(f"{b}.pre") < F.col(f"{a}.pre") + F.col(f"{a}.size"))
