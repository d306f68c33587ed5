"""Operators 5, 9 and 10 against brute force on small tables with nulls, empty texts, ties and clashing columns."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from rootline.llm import linededup, sharding, simhash
from rootline.llm.components import components
from rootline.llm.mph import Index

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, slot string, fp string, n_lines string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, None, None, None, "x", "y", "z") for i, t in rows], SCHEMA)


WHITE = " \t\n\x0b\x0c\r"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lines_brute(rows, least):
    keys = [[x.strip(WHITE).translate(UPPER) for x in (t or "").split("\n")] for _, t in rows]
    n = Counter(k for own in keys for k in set(own) if k)
    out = []
    for (i, t), own in zip(rows, keys):
        gone = [n[k] >= least for k in own]
        kept = "\n".join(x for x, g in zip((t or "").split("\n"), gone) if not g)
        out.append((i, len(own), sum(gone), kept))
    return sorted(out, key=str)


def some_rows(n, seed=1):
    r = random.Random(seed)
    pool = ["Header line", " header LINE\t", "Éa b", "éa b", "x", "", "  ", "\x0b\x0cq", "shared " * 50]
    rows = [(i, "\n".join(r.choice(pool) if r.random() < 0.6 else f"own {r.random()}" for _ in range(r.randrange(1, 9)))) for i in range(n)]
    return rows + [(n, None), (n + 1, ""), (n + 2, "Header line"), (n + 2, "Header line"), (None, "Header line\nz"), (n + 3, "a b " * 40_000)]


@pytest.mark.parametrize("mb", [64, 0.0001])
def test_line_dedup(spark, mb, monkeypatch):
    monkeypatch.setattr(linededup, "_SHARD_KEYS", 2)
    rows = some_rows(60)
    got = linededup.drop_common_lines(docs_of(spark, rows).drop("n_lines"), 10, 1, mb)
    assert sorted([(r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got.collect()], key=str) == lines_brute(rows, 10)
    assert got.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]


def test_line_dedup_empty_table(spark):
    assert linededup.drop_common_lines(docs_of(spark, [])).count() == 0


def test_perfect_hash_is_minimal_and_perfect():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**63, 50_000).astype(np.uint64))
    assert sorted(Index.build(keys).find(keys).tolist()) == list(range(keys.size))
    assert Index.build(keys[:0]).find(keys[:3]).tolist() == [-1, -1, -1]


def test_shards(spark):
    rows = some_rows(3000)
    got = sharding.shard_rows(docs_of(spark, rows), buckets=8).collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert set(by) == set(range(16)) and all(sorted(v) == list(range(len(v))) for v in by.values())
    assert all(len(rows) / 16 * 0.6 < len(v) < len(rows) / 16 * 1.5 for v in by.values())
    assert {r.grown_shard for r in got if r.grown_shard != r.shard} == {16}
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    assert sharding.shard_rows(docs_of(spark, [])).count() == 0


def test_weights_set_the_shares_and_bound_the_moves(spark):
    tree = lambda w: sharding.Node("all", 2 + w, (sharding.Node("a", 2, (), 0), sharding.Node("b", w, (), 1)))
    df = spark.range(20_000)
    n = [(r.a, r.b) for r in df.select(sharding.place(df.id, tree(1.0)).alias("a"), sharding.place(df.id, tree(2.0)).alias("b")).collect()]
    assert abs(sum(a for a, _ in n) / 20_000 - 1 / 3) < 0.02 and abs(sum(b for _, b in n) / 20_000 - 1 / 2) < 0.02
    assert all(b == 1 for a, b in n if a == 1)
    assert [math.isclose(x.weight, 8) for x in sharding.topology(16).below] == [True, True]


def simhash_brute(text, words=3):
    own = [w for w in "".join(" " if c in WHITE else c for c in (text or "").translate(UPPER)).split(" ") if w]
    if not own:
        return 0
    sh = [" ".join(own[i : i + words]) for i in range(len(own) - words + 1)] or [" ".join(own)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def reach(rows, fps, radius):
    ids = list(range(len(rows)))
    up = list(ids)

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in ids:
        for j in ids[:i]:
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                up[top(i)] = top(j)
    least = {}
    for i in ids:
        if rows[i][0] is not None:
            least[top(i)] = min(least.get(top(i), 1 << 70), rows[i][0])
    return [least.get(top(i)) for i in ids]


@pytest.mark.parametrize("bucket", [4096, 3])
def test_simhash_components(spark, bucket):
    r = random.Random(5)
    base = [[f"w{r.randrange(500)}" for _ in range(r.randrange(200, 400))] for _ in range(4)]
    rows = []
    for i in range(70):
        w = list(r.choice(base))
        for _ in range(r.randrange(0, 4)):
            w[r.randrange(len(w))] = f"n{r.randrange(9)}"
        rows.append((1000 - i, " ".join(w)))
    rows += [(5, None), (3, ""), (9, " \t"), (None, "a B"), (7, "A b"), (7, "A b"), (None, "zz yy"), (11, "é à É")]
    fps = [simhash_brute(t) for _, t in rows]
    want = sorted(zip([i for i, _ in rows], [f"{f:016x}" for f in fps], reach(rows, fps, 3)), key=str)
    got = simhash.near_duplicates(docs_of(spark, rows), bucket=bucket).collect()
    assert sorted([(x.doc_id, x.fingerprint, x.component_id) for x in got], key=str) == want
    assert len({c for _, _, c in want}) < len(want) / 2


def test_masks_cover_every_pair_within_the_radius():
    r = random.Random(2)
    for radius in (1, 2, 3):
        keep = simhash.masks(radius)
        assert len(keep) == 2 ** (radius + 1) - 1
        for _ in range(3000):
            diff = sum(1 << i for i in r.sample(range(64), radius))
            assert any(m & diff == 0 for m in keep)


def test_components(spark):
    r = random.Random(3)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(40)] + [(7, 7)]
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = sorted((top(a), top(b)))
        up[y] = x
    want = {(x, top(x)) for e in edges if e[0] != e[1] for x in e}
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(x.node, x.component) for x in got} == want and len(got) == len(want)


def test_components_of_stars_take_no_round(spark, monkeypatch):
    def none(edges, label):
        raise AssertionError("a round over edges that are stars")

    monkeypatch.setattr("rootline.llm.components._large_star", none)
    edges = [(i, i % 7) for i in range(7, 60)] + [(3, 9 + 1), (90, 91), (90, 91), (5, 5)]
    edges = [e for e in edges if e != (10, 3)]  # the same edge once each way, and once repeated
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(x.node, x.component) for x in got} == {(i, i % 7) for i in range(60)} | {(90, 90), (91, 90)} and len(got) == 62
    assert components(spark.createDataFrame([(4, 4)], "a long, b long")).collect() == []
