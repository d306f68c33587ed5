"""Residues at positions by bitmaps against a look at every pair."""

import random

import duckdb
from pyspark.sql import functions as F

from rootline.operators import sequences
from rootline.plans import catalogue


def test_residues_at_positions(spark):
    rng = random.Random(1)
    proteins = [(f"p{k}", "".join(rng.choices("ACDE", k=rng.randint(0, 40)))) for k in range(300)] + [("none", None), ("twin", "ACDEACDE"), ("twin2", "ACDEACDE")]
    epitopes = [(f"e{k}", [(rng.choice("ACDEacW"), p) for p in sorted(rng.sample(range(1, 45), rng.randint(1, 5)))]) for k in range(120)]
    epitopes += [("empty", []), ("zero", [("A", 0)]), ("same", [("A", 1), ("A", 1), ("C", 2)]), ("both", [("A", 1), ("C", 1)]), ("far", [("A", 10**6)]), (None, [("D", 3)])]
    e = spark.createDataFrame(epitopes, "id string, tokens array<struct<aa: string, pos: int>>").repartition(3)
    p = spark.createDataFrame(proteins, "protein string, seq string").repartition(7)
    found = sequences.residue_match(e, "id", "tokens", p, "protein", "seq")
    want = sorted(
        (str(i), name) for i, tokens in epitopes if tokens for name, s in proteins
        if s is not None and i is not None and all(1 <= at <= len(s) and s[at - 1] == aa.upper() for aa, at in tokens)
    )
    assert sorted((str(r[0]), r[1]) for r in found.collect()) == want and len(want) > 300
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_numbers_beyond_one_bitmap(spark):
    p = spark.range(70_000).select(F.col("id").alias("protein"), F.when(F.col("id") % 1000 == 7, "KW").otherwise("KA").alias("seq"))
    e = spark.createDataFrame([("x", [("K", 1), ("W", 2)])], "id string, tokens array<struct<aa: string, pos: int>>")
    got = sequences.residue_match(e, "id", "tokens", p, "protein", "seq").select("protein").collect()
    assert sorted(r[0] for r in got) == list(range(7, 70_000, 1000))


def test_capitals_do_not_move_what_follows(spark):
    """ß and a few more have capitals of two letters."""
    docs = [(1, "Erß scale"), (2, "ERSS"), (3, "aẞ x"), (4, "ŉŉoo"), (5, "ᾀb-ax"), (6, None), (7, "er s")]
    asked = [(10, "Er. And"), (11, "aß.xyz"), (12, "ŉŉxotter"), (13, "ᾈb-a  "), (14, "short")]
    frames = {"documents": spark.createDataFrame(docs, "doc_id long, text string"), "benchmark": spark.createDataFrame(asked, "item_id long, text string")}
    db = duckdb.connect()
    for name, rows in (("documents", docs), ("benchmark", asked)):
        db.execute(f"create table {name} ({'doc_id' if name == 'documents' else 'item_id'} bigint, text varchar)")
        db.executemany(f"insert into {name} values (?, ?)", rows)
    want = sorted(db.execute(catalogue.ORACLES["residue_position_match"]).fetchall())
    assert sorted((r.epitope, r.protein) for r in catalogue.residue_position_match(frames.__getitem__).collect()) == want
    assert {(10, 1), (11, 3), (12, 4), (13, 5)} == set(want)
