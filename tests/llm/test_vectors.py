"""Operator 8 against brute force."""

import numpy as np
import pytest

from rootline.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, label int, node long, v string, weight string, kept string"


def brute(rows, least):
    ok = lambda v: v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    n = len(rows)
    links, up = [0] * n, list(range(n))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(n):
        for j in range(i):
            a, b = rows[i][1], rows[j][1]
            if ok(a) and ok(b) and len(a) == len(b):
                x, y = np.float32(a).astype(float), np.float32(b).astype(float)
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= least:
                    links[i] += 1
                    links[j] += 1
                    up[top(i)] = top(j)
    low = {}
    for i in range(n):
        if rows[i][0] is not None:
            low[top(i)] = min(low.get(top(i), 1 << 70), rows[i][0])
    return sorted([(r[0], links[i], low.get(top(i)), r[0] is not None and r[0] == low.get(top(i))) for i, r in enumerate(rows)], key=str)


@pytest.mark.parametrize("window,cell", [(512, 1024), (16, 7)])
def test_near_vectors(spark, window, cell):
    g = np.random.default_rng(3)
    base = g.standard_normal((40, 32))
    rows = []
    for i in range(260):
        b = base[g.integers(3)] if i % 2 else base[g.integers(40)]
        rows.append((5000 - i, (b + g.standard_normal(32) * g.choice([0.0, 0.08, 0.2, 0.3])).tolist()))
    rows += [(1, None), (2, []), (3, [0.0] * 32), (4, [float("nan")] + [1.0] * 31), (5, [None] + [1.0] * 31), (6, [float("inf")] + [1.0] * 31)]
    rows += [(7, rows[0][1]), (7, rows[0][1]), (None, rows[1][1]), (None, [3.0, 4.0]), (9, [3.0, 4.0]), (10, [6.0, 8.0]), (None, [-1.0, 1.0])]
    df = spark.createDataFrame([(i, v, 0, 1, "x", "y", "z") for i, v in rows], SCHEMA)
    got = vectors.near_vectors(df, window=window, cell=cell, miss=1e-7).collect()
    assert sorted([(r.vec_id, r.n_links, r.component_id, r.kept) for r in got], key=str) == brute(rows, 0.95)


def test_empty_table(spark):
    assert vectors.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_passes_follow_the_number_of_vectors():
    n = [vectors.passes_for(10**k, 0.95, 512, 1e-4) for k in (3, 5, 7, 9)]
    assert n == sorted(n) and n[0] < n[-1]


def planted(g, base, cosine):
    """Each row's partner at this cosine."""
    other = g.standard_normal(base.shape)
    base = base / np.linalg.norm(base, axis=1, keepdims=True)
    other -= (other * base).sum(axis=1, keepdims=True) * base
    return cosine * base + np.sqrt(1 - cosine**2) * other / np.linalg.norm(other, axis=1, keepdims=True)


def missed(spark, v, pairs, **kw):
    df = spark.createDataFrame([(i, x, 0, 1, "x", "y", "z") for i, x in enumerate(v.tolist())], SCHEMA)
    got = {r.vec_id: r.component_id for r in vectors.near_vectors(df, **kw).collect()}
    return sum(got[a] != got[b] for a, b in pairs)


def test_pairs_in_a_dense_cone_are_found(spark):
    g = np.random.default_rng(8)
    axis = np.zeros((1, 64))
    axis[0, 0] = 1
    cone = planted(g, np.repeat(axis, 2000, axis=0), 0.9)
    v = np.concatenate([cone, planted(g, cone[:400], 0.955), g.standard_normal((4000, 64))])
    assert missed(spark, v, [(i, 2000 + i) for i in range(400)], window=32, cell=256) == 0


def test_the_number_of_partitions_loses_no_pairs(spark):
    g = np.random.default_rng(9)
    base = g.standard_normal((1000, 32))
    v = np.concatenate([base, planted(g, base, 0.951)])
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        assert missed(spark, v, [(i, 1000 + i) for i in range(1000)]) == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
