"""Exact search by minimizers against a plain search at every position."""

import random

import pytest

from rootline.operators import minimizers, sequences
from tests.conftest import SF


def brute(queries, texts, k):
    return sorted((q, key, i + 1, i + len(q)) for q in {q for q in queries if q is not None and len(q) >= k} for key, s in texts if s for i in range(len(s) - len(q) + 1) if s.startswith(q, i))


def tables(spark, seed=3):
    r = random.Random(seed)
    word = lambda n: "".join(r.choice("ABñ") for _ in range(n))
    texts = [(i, word(r.choice([0, 3, 8, 40, 300]))) for i in range(60)] + [(60, "A" * 200), (61, "A" * 200), (62, None), (63, "x\U0001f600\ny" * 30)]
    cut = [s[i : i + r.randint(1, 30)] for _, s in texts if s for i in [r.randrange(len(s))]]
    queries = cut + cut[:5] + ["A" * 30, "A" * 4, "", None, word(25), "x\U0001f600\nyx\U0001f600\nyx"]
    return queries, texts, spark.createDataFrame([(q,) for q in queries], "q string"), spark.createDataFrame(texts, "id int, s string").repartition(5)


@pytest.mark.parametrize("window", [1, 2, 7])
@pytest.mark.parametrize("most", [0, 1 << 20])
def test_search_finds_every_occurrence(spark, window, most):
    queries, texts, q, t = tables(spark)
    got = sequences.peptide_join(q, "q", t, "id", "s", k=3, window=window, most_broadcast=most)
    assert sorted(map(tuple, got.collect())) == brute(queries, texts, 3)


def test_long_texts_are_worked_on_in_pieces(monkeypatch):
    r = random.Random(1)
    texts = ["".join(r.choice("AB") for _ in range(n)) for n in (500, 3, 700, 90)] + [None, "A" * 333]
    whole = [(int(a), int(b), int(c)) for rows in minimizers._pieces(texts, 4, 6) for a, b, c in zip(*rows, strict=True)]
    monkeypatch.setattr(minimizers, "PIECE", 17)
    cut = [(int(a), int(b), int(c)) for rows in minimizers._pieces(texts, 4, 6) for a, b, c in zip(*rows, strict=True)]
    assert whole == cut and len(set(cut)) == len(cut)
    for row, text in enumerate(texts):  # every window has a seed
        at = [b for a, b, _ in cut if a == row]
        assert text is None or all(any(i <= x < i + 6 for x in at) for i in range(len(text) - 8))


def test_seeds_are_few(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    letters = d.selectExpr("sum(length(text))").first()[0]
    n = minimizers.seed_rows(d, "doc_id", "text", 12, 16).count()
    assert n < 0.16 * letters  # 2 / 17 expected


def test_stored_index_is_joined_where_it_lies(spark, tmp_path):
    queries, texts, q, t = tables(spark, 4)
    index = minimizers.write_index(t, "id", "s", 3, 4, "seeds_of_a_test", str(tmp_path / "index"), buckets=8)
    got = sequences.peptide_join(q, "q", t, "id", "s", k=3, window=4, index=index)
    assert sorted(map(tuple, got.collect())) == brute(queries, texts, 3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        asked = minimizers.seed_rows(q, "q", "q", 3, 4).select("seed").distinct()
        plan = index.join(asked, "seed").groupBy("seed").count()._jdf.queryExecution().executedPlan().toString()
        above = plan.split("FileScan parquet spark_catalog")[0]  # the aggregate, the join and the index's own side
        assert "SortMergeJoin" in above and "Bucketed: true" in plan and "Exchange" not in above, plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop table seeds_of_a_test")


def test_empty_tables_and_repeated_keys(spark):
    none = spark.createDataFrame([], "q string")
    texts = spark.createDataFrame([(1, "ABCDEF"), (1, "XXABCX")], "id int, s string")
    assert sequences.peptide_join(none, "q", texts, "id", "s", 3).count() == 0
    asked = spark.createDataFrame([("ABC",), ("QQQ",)], "q string")
    assert sorted(map(tuple, sequences.peptide_join(asked, "q", texts, "id", "s", 3).collect())) == [("ABC", 1, 1, 3), ("ABC", 1, 3, 5)]
    assert sequences.peptide_join(asked.where("q = 'QQQ'"), "q", texts, "id", "s", 3).count() == 0
    assert sequences.peptide_join(asked, "q", texts.where("false"), "id", "s", 3).count() == 0
