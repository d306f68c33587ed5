"""Trees by doubling pointers against walks."""

import random

import pytest
from pyspark.sql import functions as F

from rootline.operators import graph, tree


def forest(seed, n):
    rng = random.Random(seed)
    names = [f"n{k:04d}" for k in range(n)]
    rng.shuffle(names)
    return [(names[k], names[rng.randrange(max(0, k - 40), k)]) for k in range(1, n) if rng.random() < 0.97]


def walk(edges):
    """node -> (parent, root, depth, pre, size), depth first by names."""
    up = dict(edges)
    nodes = sorted(set(up) | set(up.values()))
    down = {}
    for c, p in sorted(up.items()):
        down.setdefault(p, []).append(c)
    out, n = {}, 0

    def visit(top):
        nonlocal n
        stack = [(top, None, 0)]
        while stack:
            node, parent, depth = stack.pop()
            out[node] = [parent, top, depth, n, 1]
            n += 1
            stack += [(c, node, depth + 1) for c in reversed(down.get(node, []))]

    for node in nodes:
        if node not in up:
            visit(node)
    for node in sorted(out, key=lambda x: -out[x][3]):
        if out[node][0] is not None:
            out[out[node][0]][4] += out[node][4]
    return {k: tuple(v) for k, v in out.items()}


@pytest.mark.parametrize(("seed", "n"), [(1, 2), (2, 300), (3, 800)])
def test_labels_of_forests(spark, seed, n):
    edges = forest(seed, n) or [("b", "a")]
    df = spark.createDataFrame(edges + edges[:3] + [(None, "x"), ("y", None)], "child string, parent string").repartition(3)
    assert {r.node: tuple(r)[1:] for r in tree.labels(df).collect()} == walk(edges)


def test_a_chain_of_ten_thousand_levels(spark):
    n = 10_000
    df = spark.range(1, n).select(F.col("id").alias("child"), (F.col("id") - 1).alias("parent")).repartition(4)
    own = tree.labels(df)
    got = own.agg(F.count("*"), F.max("depth"), F.sum(F.when((F.col("pre") == F.col("node")) & (F.col("size") == n - F.col("node")), 1)), F.max("root")).first()
    assert tuple(got) == (n, n - 1, n, 0)
    assert tree.below(own, n // 2).count() == n // 2
    marked = spark.createDataFrame([(0,), (7000,)], "node long")
    assert tree.nearest(df, marked).groupBy("found").count().orderBy("found").collect() == [(0, 7000), (7000, 2999)]
    totals = tree.subtree_sums(df, spark.range(n).select(F.col("id").alias("node"), F.lit(2).alias("v")), "v")
    assert totals.where(F.col("total") == 2 * (n - F.col("node"))).count() == n


def test_cycles_have_no_labels_and_end(spark):
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("under", "a"), ("x", "top"), ("self", "self"), ("y", "x")]
    df = spark.createDataFrame(edges, "child string, parent string")
    assert sorted(r.node for r in tree.labels(df).collect()) == ["top", "x", "y"]
    values = spark.createDataFrame([("a", 1), ("y", 5), ("self", 2), ("y", 1)], "node string, v long")
    assert sorted(map(tuple, tree.subtree_sums(df, values, "v").collect())) == [("top", 6), ("x", 6), ("y", 6)]


def test_a_parent_of_most_nodes_and_an_order_of_its_own(spark):
    rng = random.Random(5)
    edges = [(k, 0 if k < 900 else rng.randrange(1, 900)) for k in range(1, 1000)]
    order = [(k, rng.randrange(50)) for k in range(1000)]
    df = spark.createDataFrame(edges, "child long, parent long").repartition(6)
    got = {r.node: (r.pre, r["size"]) for r in tree.labels(df, spark.createDataFrame(order, "node long, order long")).collect()}
    down, rank = {}, dict(order)
    for c, p in edges:
        down.setdefault(p, []).append(c)
    at, want = 0, {}

    def visit(node):
        nonlocal at
        first, at = at, at + 1
        for c in sorted(down.get(node, []), key=lambda x: (rank[x], x)):
            visit(c)
        want[node] = (first, at - first)

    visit(0)
    assert got == want


def test_nearest_marked_ancestor(spark):
    edges = forest(7, 400)
    up, rng = dict(edges), random.Random(7)
    wanted = set(rng.sample(sorted(set(up) | set(up.values())), 60))
    df, marked = spark.createDataFrame(edges, "child string, parent string"), spark.createDataFrame([(x,) for x in wanted], "node string")
    for strict in (True, False):
        want = {}
        for node in set(up) | set(up.values()):
            at = up.get(node) if strict else node
            while at is not None and at not in wanted:
                at = up.get(at)
            if at is not None:
                want[node] = at
        assert dict(map(tuple, tree.nearest(df, marked, strict).collect())) == want


def test_running_sums_count_ties_together(spark):
    rows = [(k // 3, 1, f"r{k}") for k in range(30)]
    df = spark.createDataFrame(rows, "at long, n long, name string").repartition(5)
    assert {r["name"]: r.so_far for r in tree.running(df, "at", "n", "so_far").collect()} == {name: at * 3 for at, _, name in rows}


def test_graphs_deeper_than_64_levels(spark):
    df = spark.createDataFrame([(f"n{k}", f"n{k - 1}") for k in range(1, 71)] + [("n5", "n2")], "child string, parent string")
    seed = spark.createDataFrame([("n0",)], "node string")
    assert graph.reachable(df, seed).count() == 71
    assert graph.closure(df, seed).agg(F.max("depth")).first()[0] == 68
    with pytest.raises(RuntimeError, match="deeper than 10"):
        graph.closure(df, seed, most=10)


def test_empty_edges(spark):
    none = spark.createDataFrame([], "child string, parent string")
    assert tree.labels(none).collect() == [] and tree.nearest(none, spark.createDataFrame([("a",)], "node string")).collect() == []
