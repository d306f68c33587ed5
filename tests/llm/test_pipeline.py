"""The pipeline's stages on the driver's smallest documents, each against brute force on its own input."""

from pathlib import Path

import corpus_pipeline as P
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rootline.llm import quality, simhash, toxicity
from rootline.llm.common import shared_dir
from tests.conftest import SF
from tests.llm.test_lines_shards_simhash import lines_brute
from tests.llm.test_near import jaccard


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in P.STAGES:
        stage(spark, docs, SF).write.parquet(f"{at}/{name}")
        after = spark.read.parquet(f"{at}/{name}")
        out.append((name, docs, after))
        docs = after
    return {n: (a, b) for n, a, b in out}


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns_stay(stages):
    assert all(b.columns == P.COLUMNS for n, (_, b) in stages.items() if n != "packing")


@pytest.mark.parametrize("name,op,keep", [("toxicity", toxicity, 0), ("quality", quality, 1)])
def test_filters_follow_the_classifiers(spark, stages, name, op, keep):
    a, b = stages[name]
    want = {r.doc_id for r in op.classify(a, spark.read.parquet(f"{SF}/labels.parquet")).where(f"predicted = {keep}").collect()}
    assert set(texts(b)) == want and all(texts(a)[i] == t for i, t in texts(b).items())


def test_lines(stages):
    a, b = stages["line_dedup"]
    want = {i: kept for i, _, _, kept in lines_brute([(r.doc_id, r.text) for r in a.collect()], 10)}
    assert texts(b) == want and all(r.n_chars == len(r.text) for r in b.collect())


def test_one_of_each_group_stays(stages):
    a, b = stages["near_dedup"]
    before, kept = texts(a), set(texts(b))
    ids = sorted(before)
    for i in ids:
        near = [jaccard(before[i], before[j]) for j in ids if j < i]
        if max(near, default=0) >= 0.87:
            assert i not in kept
        if max((jaccard(before[i], before[j]) for j in ids if j != i), default=0) < 0.7:
            assert i in kept


def test_one_of_each_group_of_fingerprints_stays(spark, stages):
    """The stage's own operator is op 5: no two documents that its links connect stay."""
    a, b = stages["near_dedup"]
    kept = set(texts(b))
    groups = {}
    for r in simhash.near_duplicates(a).collect():
        groups.setdefault(r.component_id, []).append(r.doc_id)
    assert any(len(g) > 1 for g in groups.values())
    assert all(len(kept.intersection(g)) <= 1 for g in groups.values())


def odd_documents(spark, rows):
    """Documents with columns whose names the stages use themselves."""
    extra = "score double, _marks binary, n_lines long, n_dropped long, grp long, _t1 long, label int, length long, low binary"
    own = [(i, t, lang, src, None, None, None, 1, 1, 1, 1, 1, 1, None) for i, t, lang, src in rows]
    return spark.createDataFrame(own, "doc_id long, text string, lang string, source string, n_chars long, " + extra)


LONG = " ".join(f"word{i}" for i in range(30_000))
ODD = [(None, None, None, None), (None, "", "en", None), (3, "", None, "s"), (4, None, "en", "s"), (5, "same text here again", "en", "s"), (5, "same text here again", "en", "s"), (5, "another text of the same id", "en", "s"), (6, "same text here again", "en", "s"), (7, LONG, "en", "s"), (8, " \t ", "en", "s")]


@pytest.mark.parametrize("name,stage", P.STAGES)
def test_each_stage_on_odd_rows(spark, name, stage):
    docs = odd_documents(spark, ODD)
    got = stage(spark, docs, SF)
    rows = got.collect()
    if name != "packing":
        assert got.columns == P.COLUMNS
    have = sorted(((r.doc_id, r.text) for r in rows) if name != "packing" else [], key=str)
    if name in ("toxicity", "quality"):
        op, keep = (toxicity, 0) if name == "toxicity" else (quality, 1)
        marks = op.score(docs.select("doc_id", "text"), op.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))).collect()
        want = [(r.doc_id, r.text) for r in marks if (r.score < 0.3) == (name == "toxicity")]
        assert keep in (0, 1) and have == sorted(want, key=str)
    if name == "line_dedup":
        assert have == sorted([(i, t or "") for i, t, _, _ in ODD], key=str) and all(r.n_chars == len(r.text) for r in rows)
    if name == "near_dedup":
        assert have == sorted([(3, ""), (5, "same text here again"), (5, "another text of the same id"), (7, LONG)], key=str)
    if name == "packing":
        assert sum(r.doc_id == 5 for r in rows) == 3 and {r.length for r in rows if r.doc_id in (3, 4) or r.doc_id is None} == {1}
        assert max(r.length for r in rows) == 2048 and sum(r.doc_id == 7 for r in rows) > 20


@pytest.mark.parametrize("name,stage", P.STAGES)
def test_each_stage_on_an_empty_table(spark, name, stage):
    got = stage(spark, odd_documents(spark, ODD).where("doc_id > 99"), SF)
    assert got.count() == 0 and (name == "packing" or got.columns == P.COLUMNS)


def test_packing_holds_every_token(stages):
    a, b = stages["packing"]
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    n = {}
    for r in b.collect():
        n[r.doc_id] = n.get(r.doc_id, 0) + r.length
    assert n == {i: len(tok.encode(t, add_special_tokens=False).ids) + 1 for i, t in texts(a).items()}


def test_run_is_the_stages_in_order(spark, stages):
    """And leaves nothing but its result in the shared folder."""
    at = Path(shared_dir(spark).removeprefix("file:"))
    before = {p.name for p in at.iterdir()}
    result = P.run(spark, SF)
    assert {p.name.split("-")[1] for p in at.iterdir() if p.name not in before} == {"packing"}
    got = result.select("doc_id", "piece", "length", "ids_crc32")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, stages["packing"][1].select("doc_id", "piece", "length", "ids_crc32").collect()))


def test_toxic_rows_are_caught_in_the_larger_table(spark):
    sf = SF.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    kept = {r.doc_id for r in P.drop_toxic(spark, docs, sf).select("doc_id").collect()}
    marks = labels.collect()
    assert sum(r.doc_id in kept for r in marks if not r.toxic) >= 0.97 * sum(not r.toxic for r in marks)
    assert sum(r.doc_id not in kept for r in marks if r.toxic) >= 0.6 * sum(r.toxic for r in marks)
