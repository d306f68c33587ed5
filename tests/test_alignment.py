"""Alignments without whole tables against those with them."""

import random
import tracemalloc

import pytest
from pyspark.sql import functions as F

from rootline.operators import sequences


def pairs(seed, count, most):
    rng = random.Random(seed)
    for k in range(count):
        letters = "ACDWK"[: rng.randint(1, 5)]
        a, b = ("".join(rng.choice(letters) for _ in range(rng.randint(1, most))) for _ in "ab")
        yield (a, b[: rng.randint(0, len(b))] + a[rng.randint(0, len(a) - 1) :]) if k % 2 else (a, b)


@pytest.mark.parametrize("local", [False, True])
def test_long_alignments_have_the_same_texts_and_ties(local):
    for a, b in [*pairs(1, 200, 30), *pairs(2, 6, 400)]:
        assert sequences.align_long(a, b, local) == sequences.align_all([(a, b)], local, 10**9)[0]
    mixed = [*pairs(3, 40, 60)]
    assert sequences.align_all(mixed, local, 500) == sequences.align_all(mixed, local, 10**9)


def test_memory_of_a_long_alignment_is_bounded():
    rng = random.Random(4)
    a = "".join(rng.choices("ACDEFGHIKLMNPQRSTVWY", k=6000))
    b = a[:2500] + a[2600:] + "W" * 50
    tracemalloc.start()
    x, y, i, j, score = sequences.align_all([(a, b)])[0]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 40e6  # whole tables would take 580 MB
    assert x.replace("-", "") == a and y.replace("-", "") == b and (i, j) == (1, 1)
    assert score == sequences.align_long(b, a)[4]


def test_score_of_texts(spark):
    whole = [p for p in pairs(5, 60, 40)]
    df = spark.createDataFrame(whole, "a string, b string")
    got = sequences.aligned(df, "a", "b").select("score", sequences.text_score(F.col("aligned_a"), F.col("aligned_b")).alias("text")).collect()
    assert len(got) == 60 and all(r.score == r["text"] for r in got)
