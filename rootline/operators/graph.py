"""Trees and DAGs as edge tables (child, parent): closure, ancestors, roll-ups, pruning, extraction, reduction.

Recursion is a loop of joins over the frontier with an anti-join against what has been reached, so diamonds and
cycles end. Each round is written to the shared folder (spark.checkpoint.dir), which cuts the lineage and survives
lost executors.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rootline.operators.shared import shared_table


def _shared(df: DataFrame) -> DataFrame:
    return shared_table(df, "graph")


def _merged(reached: DataFrame, level: int) -> DataFrame:
    """Every 16th level what was reached becomes one table, so that the plan stays short on deep graphs."""
    return _shared(reached) if level % 16 == 0 else reached


def closure(edges: DataFrame, seeds: DataFrame | None = None, down: bool = True, most: int | None = None) -> DataFrame:
    """(ancestor, node, depth) for each seed and what it reaches, itself at depth 0; depth is the shortest path.

    edges (child, parent); seeds (node), all nodes by default. down walks to descendants (seeds are the ancestors), else
    to ancestors (seeds are the nodes). It ends when a level adds nothing; ``most``: raise beyond so many levels.
    """
    near, far = ("parent", "child") if down else ("child", "parent")
    step = edges.where("child is not null and parent is not null").select(F.col(near).alias("at"), F.col(far).alias("to")).distinct()
    if seeds is None:
        seeds = step.select(F.col("at").alias("node")).union(step.select(F.col("to").alias("node")))
    reached = _shared(seeds.select(F.col("node").alias("seed"), F.col("node").alias("at"), F.lit(0).alias("depth")).distinct())
    frontier = reached
    for depth in itertools.count(1):
        if most is not None and depth > most:
            raise RuntimeError(f"closure: deeper than {most} levels")
        new = frontier.join(step, "at").select("seed", F.col("to").alias("at")).distinct()
        new = _shared(new.join(reached, ["seed", "at"], "left_anti").withColumn("depth", F.lit(depth)))
        if new.isEmpty():
            pair = ("seed", "at") if down else ("at", "seed")
            return reached.select(F.col(pair[0]).alias("ancestor"), F.col(pair[1]).alias("node"), "depth")
        reached, frontier = _merged(reached.union(new), depth), new


def reachable(edges: DataFrame, seeds: DataFrame, down: bool = True) -> DataFrame:
    """(node): all that the seeds reach together, themselves included; carries no seed, so it stays as small as the graph."""
    near, far = ("parent", "child") if down else ("child", "parent")
    step = edges.select(F.col(near).alias("node"), F.col(far).alias("to")).where("node is not null and to is not null").distinct()
    reached = _shared(seeds.select("node").distinct())
    frontier = reached
    for level in itertools.count(1):
        new = _shared(frontier.join(step, "node").select(F.col("to").alias("node")).distinct().join(reached, "node", "left_anti"))
        if new.isEmpty():
            return reached
        reached, frontier = _merged(reached.union(new), level), new


def without_path_to(edges: DataFrame, nodes: DataFrame, root) -> DataFrame:
    """The nodes that the root doesn't reach."""
    seed = edges.sparkSession.range(1).select(F.lit(root).alias("node"))
    return nodes.join(reachable(edges, seed), "node", "left_anti")


def first_parents(edges: DataFrame, order: Column | None = None) -> DataFrame:
    """One parent for each child: the first by order, the least name without one."""
    return edges.groupBy("child").agg(F.min_by("parent", order if order is not None else F.col("parent")).alias("parent"))


def nearest(edges: DataFrame, wanted: DataFrame, strict: bool = True) -> DataFrame:
    """(node, found): the nearest ancestor among the wanted (node) rows; itself only if not strict. Give single-parent edges."""
    up = closure(edges, down=False).join(wanted.select(F.col("node").alias("ancestor")).distinct(), "ancestor")
    up = up.where("depth > 0") if strict else up
    return up.groupBy("node").agg(F.min_by("ancestor", F.struct("depth", "ancestor")).alias("found"))


def redirect_other(found: DataFrame, use_other: DataFrame, other: Column) -> DataFrame:
    """Replaces a found ancestor that is in use_other (node) by its 'other' child."""
    mark = use_other.select(F.col("node").alias("found"), F.lit(True).alias("_use"))
    return found.join(mark, "found", "left").withColumn("found", F.when(F.col("_use"), other).otherwise(F.col("found"))).drop("_use")


def resolve_parents(curated: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """(child, parent): a child's curated parents if it has any, else those of the taxonomy."""
    return curated.unionByName(taxonomy.join(curated.select("child").distinct(), "child", "left_anti"))


def rollup(edges: DataFrame, values: DataFrame, value: str) -> DataFrame:
    """(node, total): the sum of a value (node, value) over each node's subtree, counted once per node of it."""
    pairs = closure(edges).join(values, "node")
    return pairs.groupBy(F.col("ancestor").alias("node")).agg(F.sum(value).alias("total"))


def reduction(edges: DataFrame) -> DataFrame:
    """Edges without those implied by a path through another parent; edges of a cycle stay."""
    own = edges.where("child is not null and parent is not null").distinct()
    # only an edge of a child with several parents can be implied; walks start at those parents alone
    many = _shared(own.join(own.groupBy("child").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("child"), "child", "left_semi"))
    above = closure(edges, many.select(F.col("parent").alias("node")).distinct(), down=False).where("depth > 0").select(F.col("node").alias("via"), F.col("ancestor").alias("above"))
    above = _shared(above)
    implied = many.select("child", F.col("parent").alias("via")).join(above, "via").select("child", F.col("above").alias("parent"), "via").where("via <> parent")
    implied = many.join(implied.select("child", "parent").distinct(), ["child", "parent"], "left_semi")
    cyclic = above.select(F.col("via").alias("parent"), F.col("above").alias("child"))
    return edges.distinct().join(implied.join(cyclic, ["child", "parent"], "left_anti"), ["child", "parent"], "left_anti")


def depth_first(edges: DataFrame, root, label: DataFrame | None = None) -> DataFrame:
    """(node, path): nodes below a root with the path of names to them; sorting by path gives depth-first order.
    Edges must be a tree."""
    names = label if label is not None else edges.select(F.col("child").alias("node"), F.col("child").cast("string").alias("name")).distinct()
    up = closure(edges, down=False)
    below = up.where(F.col("ancestor") == F.lit(root)).select("node", F.col("depth").alias("_levels"))
    steps = up.join(below, "node").where("depth <= _levels").join(names.withColumnRenamed("node", "ancestor"), "ancestor", "left")
    steps = steps.select("node", F.struct((-F.col("depth")).alias("d"), F.coalesce("name", F.col("ancestor").cast("string")).alias("n")).alias("s"))
    return steps.groupBy("node").agg(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["n"]).alias("path")).orderBy("path")
