"""Word hits and extensions against alignments of all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rootline.operators import seeds, sequences
from rootline.plans import catalogue
from tests.conftest import SF

PROTEIN = "ACDEFGHIKLMNPQRSTVWY"


def random_protein(rng, n):
    return "".join(rng.choices(PROTEIN, k=n))


def changed(rng, text, share, gaps=0):
    out = [rng.choice(PROTEIN) if rng.random() < share else c for c in text]
    for _ in range(gaps):
        at = rng.randrange(len(out))
        if rng.random() < 0.5:
            del out[at : at + rng.randint(1, 4)]
        else:
            out[at:at] = rng.choices(PROTEIN, k=rng.randint(1, 4))
    return "".join(out)


def family(seed):
    """Queries and subjects: unrelated ones, and relatives at several distances, with gaps, inside longer sequences."""
    rng = random.Random(seed)
    queries = [random_protein(rng, rng.randint(60, 300)) for _ in range(16)]
    subjects = [random_protein(rng, rng.randint(50, 400)) for _ in range(80)]
    for q in queries:
        subjects += [random_protein(rng, 80) + changed(rng, q, share, gaps) + random_protein(rng, 80) for share, gaps in ((0.1, 0), (0.3, 2), (0.45, 1), (0.55, 0))]
    return queries, subjects


def expected(score, query, letters):
    return len(query) * letters * 2 ** -((sequences.LAMBDA * score - math.log(sequences.KAPPA)) / math.log(2))


def test_most_hits_are_found_and_few_pairs_aligned(spark):
    queries, subjects = family(1)
    letters = sum(map(len, subjects))
    pairs = [(i, j) for i in range(len(queries)) for j in range(len(subjects))]
    scores = {p: x[4] for p, x in zip(pairs, sequences.align_all([(queries[i], subjects[j]) for i, j in pairs], True), strict=True)}
    hits = {p for p, s in scores.items() if expected(s, queries[p[0]], letters) <= 1}
    q = spark.createDataFrame(list(enumerate(queries)), "qid long, qs string").repartition(3)
    s = spark.createDataFrame(list(enumerate(subjects)), "sid long, ss string").repartition(5)
    got = {(r.Query, r.Subject): r for r in sequences.similarity_join(q, "qid", "qs", s, "sid", "ss", top=10**6, evalue=1.0).collect()}
    assert set(got) <= hits and len(set(got) & hits) >= 0.95 * len(hits)
    sure = {p for p in hits if expected(scores[p], queries[p[0]], letters) <= 1e-6}
    assert len(sure) > 40 and sure <= set(got)
    assert all(round((r["Bit Score"] * math.log(2) + math.log(sequences.KAPPA)) / sequences.LAMBDA) == scores[p] for p, r in got.items())
    asked = lambda n: (math.log(n * letters) + math.log(sequences.KAPPA)) / sequences.LAMBDA
    tried = seeds.seeded_pairs(q, "qid", "qs", s, "sid", "ss", asked).collect()
    assert len({(r.query, r.subject) for r in tried}) == len(tried) <= max(0.05 * len(pairs), len(hits))
    assert all(r.ungapped <= r.gapped <= scores[r.query, r.subject] for r in tried)
    shared = sequences.similarity_join(q, "qid", "qs", s, "sid", "ss", top=10**6, evalue=1.0, exact=True, least_shared=1).collect()
    assert sure <= {(r.Query, r.Subject) for r in shared} <= hits


def test_kmers_at_every_position(spark):
    rows = [("ABCD",), ("AAAA",), ("AB",), ("",), ("A\nBé",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "s string").select(sequences.kmers(F.col("s"), 3)).collect()]
    assert got == [["ABC", "BCD"], ["AAA", "AAA"], [], [], ["A\nB", "\nBé"], None]


def test_the_registered_search_has_the_best_of_all_pairs(spark):
    """Every pair that shares two 3-mers, aligned here; the five best of each query by score, shared 3-mers and subject."""
    part, supplier = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("part", "supplier"))
    own = {str(r[0]): "".join(c for c in (r[1] + r[2]).upper() if "A" <= c <= "Z") for r in part.select("p_partkey", "p_name", "p_type").collect()}
    asked = [str(r[0]) for r in supplier.select("s_suppkey").collect() if str(r[0]) in own]
    words = {s: {s[i : i + 3] for i in range(len(s) - 2)} for s in own.values()}
    pairs = [(a, b) for a in {own[q] for q in asked} for b in words if len(words[a] & words[b]) >= 2]
    scores = {p: x[4] for p, x in zip(pairs, sequences.align_all(pairs, True), strict=True)}
    want = set()
    for q in asked:
        met = [(-scores[own[q], s], -len(words[own[q]] & words[s]), i) for i, s in own.items() if (own[q], s) in scores]
        want |= {(q, i, -score) for score, _, i in sorted(met)[:5]}
    bits = lambda b: round((b * math.log(2) + math.log(sequences.KAPPA)) / sequences.LAMBDA)
    got = [(r.Query, r.Subject, bits(r["Bit Score"])) for r in catalogue.similarity_search(lambda t: {"part": part, "supplier": supplier}[t]).collect()]
    assert len(got) == len(want) > 20 and set(got) == want


@pytest.mark.parametrize(("query_letters", "subject_letters"), [(1, 1), (500, 3000), (10**6, 10**6)])
def test_pairs_do_not_depend_on_blocks(spark, query_letters, subject_letters):
    queries, subjects = family(2)
    q = spark.createDataFrame([*enumerate(queries[:6]), (90, None), (91, ""), (92, "AC"), (93, queries[0])], "qid long, qs string")
    s = spark.createDataFrame([*enumerate(subjects[75:100]), (900, None), (901, ""), (902, "W" * 5)], "sid long, ss string")
    rows = seeds.seeded_pairs(q, "qid", "qs", s, "sid", "ss", lambda n: 40.0, query_letters=query_letters, subject_letters=subject_letters).collect()
    got = {(r.query, r.subject): r.gapped for r in rows}
    assert len(got) == len(rows) and got
    whole = {(r.query, r.subject): r.gapped for r in seeds.seeded_pairs(q, "qid", "qs", s, "sid", "ss", lambda n: 40.0).collect()}
    assert got == whole
    assert {p[1]: v for p, v in got.items() if p[0] == 93} == {p[1]: v for p, v in got.items() if p[0] == 0} and not any(p[0] in (90, 91, 92) for p in got)


def test_hits_are_worked_on_in_parts():
    queries, subjects = family(3)
    index = seeds.Index(queries[:4], 11)
    letters, starts = seeds.codes(subjects[:100])
    best = []
    for most in (500, 10**7):
        a, b, score, _ = seeds.block_pairs(index, letters, starts, most_hits=most)
        own = {}
        for x, y, z in zip(a.tolist(), b.tolist(), score.tolist(), strict=True):
            own[x, y] = max(z, own.get((x, y), 0))
        best.append(own)
    assert best[0].keys() == best[1].keys() and all(best[0][p] >= best[1][p] for p in best[0])


def test_a_wide_band_has_the_score_of_the_whole_alignment():
    rng = random.Random(4)
    a = [random_protein(rng, rng.randint(1, 60)) for _ in range(40)]
    b = [changed(rng, x + "A" * 6, 0.3, 3) for x in a]
    (al, first), (bl, least) = seeds.codes(a), seeds.codes(b)
    size, end = np.array([len(x) for x in a]), least + np.array([len(x) for x in b])
    got = seeds.banded(al, bl, first, size, np.zeros(len(a), int), least, end, reach=80)
    assert got.tolist() == [x[4] for x in sequences.align_all(list(zip(a, b, strict=True)), True)]
    assert (seeds.banded(al, bl, first, size, np.zeros(len(a), int), least, end, reach=3) <= got).all()


def test_neighbourhood_words():
    word = lambda t: sum((ord(c) - 65) * 26 ** (2 - k) for k, c in enumerate(t))
    near = set(seeds.neighbours(word("WKV"), 11).tolist())
    assert word("WKV") in near and word("WRI") in near and word("AAA") not in near
    table = sequences.letter_scores()
    assert all(sum(table[ord(a), ord(b)] for a, b in zip("WKV", w, strict=True)) >= 11 for w in ("WKV", "WRI"))


def test_extension_stops_at_edges_and_drops():
    a, starts = seeds.codes(["WWWWWAAAAA", "WW"])
    table = seeds.scores()
    w = table[22, 22]
    at = np.array([starts[0]]), np.array([starts[0]])
    assert seeds.extended(a, a, *at, 1, 16).tolist() == [5 * w + 5 * table[0, 0]]
    b, other = seeds.codes(["WWWWWPPPPPWWWWW"])
    assert seeds.extended(a, b, at[0], np.array([other[0]]), 1, 3).tolist() == [5 * w]


@pytest.mark.parametrize("cell", [3, 4_000_000])
def test_frequent_sequences_are_dealt_over_tasks(spark, cell):
    left = spark.range(40).select(F.col("id").alias("a"), F.when(F.col("id") % 4 > 0, "x").otherwise(F.col("id").cast("string")).alias("k"))
    right = spark.range(60).select(F.col("id").alias("b"), F.when(F.col("id") % 3 > 0, "x").otherwise(F.col("id").cast("string")).alias("k"))
    got = sequences._expanded(left, right, "k", cell)
    want = sorted(map(tuple, left.join(right, "k").select("a", "b").collect()))
    assert sorted(map(tuple, got.select("a", "b").collect())) == want and len(want) == 1204
    largest = max(r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect())
    assert largest <= (12 * 30 if cell == 3 else 1204)
