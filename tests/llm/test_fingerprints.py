"""Operator 4: edits and order against brute force, the algebra of the hash, and how close likeness comes."""

import hashlib
import random
from collections import Counter

from pyspark.sql import functions as F

from rootline.llm import fingerprints as fp

SCHEMA = "doc_id long, text string, back string, tie string, k string, n_chars string, kind int"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "b", "t", "k", "n", 3) for i, t in rows], SCHEMA)


def brute(rows):
    """Rows by descending id (nulls last); ids differ except in equal rows here."""
    order = sorted(((-1 << 62 if i is None else i), t or "", i) for i, t in rows)[::-1]
    out = Counter()
    for n, (_, t, i) in enumerate(order):
        other = order[(n + 1) % len(order)][1]
        m = len(t) // 3
        out[(i, len(t), hashlib.sha256((t[: len(t) - m] + other[:m]).encode()).hexdigest())] += 1
    return out


def some(n=50):
    r = random.Random(8)
    line = lambda: " ".join(r.choice(["ab", "é", "漢", "🙂x", "word", f"q{r.randrange(999)}"]) for _ in range(r.randrange(1, 60)))
    return [(3 * i - 40, "\n".join(line() for _ in range(r.randrange(1, 25)))) for i in range(n)]


def test_edits_follow_the_order(spark):
    rows = [*some(), (900, None), (901, ""), (902, "xy"), (None, "null id"), (903, "z " * 60_000), (904, "\n\n\n"), (905, " lead\n tail ")]
    got = fp.fingerprint_documents(docs_of(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == brute(rows)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)


def test_repeated_rows(spark):
    rows = [*some(9), (500, "twice or more"), (500, "twice or more"), (500, "twice or more"), (None, "n"), (None, "n")]
    got = fp.fingerprint_documents(docs_of(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == brute(rows)
    assert len({r.fingerprint for r in got if r.doc_id == 500}) == 1


def test_lone_document_and_empty_table(spark):
    one = fp.fingerprint_documents(docs_of(spark, [(1, "abcdef")])).collect()
    assert [(r.n_chars, r.edited_sha256, r.near_next) for r in one] == [(6, hashlib.sha256(b"abcdab").hexdigest(), 1.0)]
    assert fp.fingerprint_documents(docs_of(spark, [])).count() == 0


def test_likeness_tells_edits_from_strangers(spark):
    r = random.Random(2)
    rows = [(i, "\n".join(f"line {r.random()}" for _ in range(90))) for i in range(60)]
    got = fp.fingerprint_documents(docs_of(spark, rows)).collect()
    near = [x.near_edited for x in got]
    assert abs(sum(near) / len(near) - 2 / 3) < 0.03 and max(abs(x - 2 / 3) for x in near) < 0.25
    assert sum(x.near_next for x in got) / 60 < 0.1


def of(spark, rows):
    df = spark.createDataFrame(rows, "g string, paragraph string")
    return fp.packed(fp.multiset_hash(df, ["g"]), ["g"], "fp")


def test_order_insert_and_delete(spark):
    a, b = ["x", "y", "y", "é"], ["y", "z"]
    rows = [("a", p) for p in a] + [("ra", p) for p in a[::-1]] + [("b", p) for p in b] + [("ab", p) for p in a + b]
    got = of(spark, rows)
    at = {r.g: r for r in got.select("g", fp.text_of(F.col("fp")).alias("t")).collect()}
    assert at["a"].t == at["ra"].t != at["b"].t
    one = got.groupBy().agg(*[F.first(F.when(F.col("g") == g, F.col("fp")), True).alias(g) for g in ("a", "b", "ab")])
    r = one.select(fp.text_of(fp.insert(F.col("a"), F.col("b"))).alias("i"), fp.text_of(fp.delete(F.col("ab"), F.col("b"))).alias("d")).first()
    assert (r.i, r.d) == (at["ab"].t, at["a"].t)


def test_very_many_equal_paragraphs_do_not_overflow(spark):
    lines = "x\n" * 2_500_000
    got = {r.doc_id: r for r in fp.fingerprint_documents(docs_of(spark, [(2, lines), (1, lines), (0, "y")])).collect()}
    assert got[2].fingerprint == got[1].fingerprint and got[2].near_next == 1.0 and got[1].near_next < 0.1


def test_paragraphs_cover_the_text(spark):
    texts = ["", "a", "a b c d e", " a  b\tc ", "x\n\ny", "   ", "w " * 100]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for t, p in df.select("text", fp.paragraphs(F.col("text"), 2).alias("p")).collect():
        assert "".join(p) == t + "\n" and all(len(x.split()) <= 2 and "\n" not in x[:-1] for x in p)
