"""Near duplicates by similarity against exact Jaccard of five-word shingles."""

import random

import pytest

from rootline.llm import near, simhash

SCHEMA = "doc_id long, text string, sim string, node string, low string"


def shingles(t):
    w = (t or "").lower().split()
    return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def corpus():
    r = random.Random(7)
    word = lambda: "".join(r.choice(["an", "the", "ing", "or", "st", "ea", "re", "li"]) for _ in range(r.randrange(1, 4)))
    rows = []
    for base in range(25):
        w = [word() for _ in range(r.randrange(150, 500))]
        rows.append((len(rows), " ".join(w)))
        for _ in range(r.randrange(0, 6)):
            x = list(w)
            for _ in range(max(1, int(len(x) * r.choice([0.003, 0.008, 0.012, 0.06, 0.1])))):
                x[r.randrange(len(x))] = word()
            rows.append((len(rows), " ".join(x)))
    return rows


@pytest.mark.parametrize("bucket", [4096, 2])
def test_groups_follow_the_similarity(spark, bucket):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "s", "n", "l") for i, t in rows], SCHEMA)
    got = {r.doc_id: r.component_id for r in near.similar_documents(df, bucket=bucket).collect()}
    sure = far = 0
    for i, a in rows:
        for j, b in rows[:i]:
            s = jaccard(a, b)
            if s >= 0.87:
                sure += 1
                assert got[i] == got[j], (i, j, s)
    low = {}
    for i, a in rows:
        best = max((jaccard(a, b) for j, b in rows if j != i), default=0)
        if best < 0.7:
            far += 1
            assert got[i] == i
        low[i] = best
    assert sure > 10 and far > 10


def test_defined_cases(spark):
    rows = [(5, None), (3, ""), (9, " \t"), (None, "a b"), (7, "A  b"), (7, "A b"), (None, "only"), (11, "x " * 60_000), (12, "y")]
    df = spark.createDataFrame([(i, t, "s", "n", "l") for i, t in rows], SCHEMA)
    got = sorted([(r.doc_id, r.component_id) for r in near.similar_documents(df).collect()], key=str)
    assert got == sorted([(5, 3), (3, 3), (9, 3), (None, 7), (7, 7), (7, 7), (None, None), (11, 11), (12, 12)], key=str)
    assert near.similar_documents(df.where("doc_id > 99")).count() == 0


@pytest.mark.parametrize("bucket", [4096, 600])
def test_a_star_of_edited_copies_is_one_group(spark, bucket):
    r = random.Random(3)
    first = [f"w{r.randrange(10**6)}" for _ in range(300)]
    rows = [(5000, " ".join(first))]  # not the least id
    for i in range(2000):
        w = list(first)
        for at in r.sample(range(5, 295, 6), 4):
            w[at] = f"e{r.randrange(10**9)}"
        rows.append((i, " ".join(w)))
    assert jaccard(rows[0][1], rows[1][1]) > 0.87 and jaccard(rows[1][1], rows[2][1]) < 0.79
    df = spark.createDataFrame([(i, t, "s", "n", "l") for i, t in rows], SCHEMA)
    got = {r.doc_id: r.component_id for r in near.similar_documents(df, bucket=bucket).collect()}
    low = {i: near.sketch(t.encode()) for i, t in rows}
    agree = lambda a, b: sum(x == y for x, y in zip(a, b, strict=True))
    linked = [i for i, _ in rows if agree(low[i], low[5000]) >= 512 - near.most_differing(0.8)]
    assert len(linked) > 1950 and {got[i] for i in linked} == {got[5000]}


@pytest.mark.parametrize("bucket", [4096, 100])
def test_a_bucket_of_one_large_group_and_strangers(spark, bucket):
    """Rows outside the largest group of a bucket are compared with all others, in parts too."""
    r = random.Random(8)
    first = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join([*first[:295], f"e{i}"])) for i in range(800)]
    chain = [*first[:250], *[f"z{i}" for i in range(50)]]  # shares bands with the group, at about 0.7
    rows += [(5000 + i, " ".join([*chain[: 300 - 5 - i], *[f"q{r.randrange(10**9)}" for _ in range(2)]])) for i in range(6)]
    df = spark.createDataFrame([(i, t, "s", "n", "l") for i, t in rows], SCHEMA)
    got = {x.doc_id: x.component_id for x in near.similar_documents(df, bucket=bucket).collect()}
    assert {got[i] for i in range(800)} == {0} and {got[i] for i in range(5000, 5006)} == {5000}


def test_rows_that_repeat_an_id_with_another_text_are_apart(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(7, a), (3, a), (7, b), (9, b), (9, b), (None, b), (None, "c d"), (None, "c d"), (None, None), (None, "")]
    df = spark.createDataFrame([(i, t, "s", "n", "l") for i, t in rows], SCHEMA)
    for limit in (10**6, 0):
        kept = sorted([(x.doc_id, x.text or "") for x in near.one_of_each(df, broadcast_rows=limit).collect()], key=str)
        assert kept == sorted([(3, a), (7, b), (None, "c d"), (None, "")], key=str)
    assert near.one_of_each(df).columns == df.columns


def edited(r, kind, share, size=300):
    """A text and its copy with ``share`` of its words appended, cut from the end or replaced in one run."""
    w = [f"w{r.randrange(3000)}" for _ in range(size)]
    new, k = [f"w{r.randrange(3000)}" for _ in range(size)], int(size * share)
    return w, {"append": w + new[:k], "cut": w[: size - k], "replace": w[:50] + new[:k] + w[50 + k :]}[kind]


@pytest.mark.parametrize("kind,share", [("append", 0.12), ("cut", 0.11), ("replace", 0.05)])
def test_lone_pairs_are_found_whatever_the_edit(spark, kind, share):
    r = random.Random(share)
    rows = []
    for _ in range(100):
        rows += [(len(rows) + k, " ".join(w)) for k, w in enumerate(edited(r, kind, share))]
    df = spark.createDataFrame([(i, t, "s", "n", "l") for i, t in rows], SCHEMA)
    got = {r.doc_id: r.component_id for r in near.similar_documents(df).collect()}
    assert all(0.87 < jaccard(rows[i][1], rows[i + 1][1]) < 0.91 for i in range(0, 200, 2))
    assert sum(got[i + 1] == i for i in range(0, 200, 2)) >= 98


@pytest.mark.parametrize("low,least", [(0.80, 0.90), (0.85, 0.98), (0.90, 1.0)])
def test_recall_of_lone_pairs_by_band(spark, low, least):
    """Pairs of every kind of edit whose exact similarity lies in the band; far pairs don't link."""
    r = random.Random(low)
    rows, truth = [], []
    while len(truth) < 150:
        kind = r.choice(["append", "cut", "replace"])
        a, b = edited(r, kind, r.uniform(0.001, 0.26), r.choice([120, 300, 800]))
        a, b = " ".join(a), " ".join(b)
        if low <= jaccard(a, b) < low + 0.05:
            truth.append(len(rows))
            rows += [(len(rows), a), (len(rows) + 1, b)]
    far = []
    while len(far) < 50:
        a, b = (" ".join(x) for x in edited(r, "cut", r.uniform(0.3, 0.4)))
        far.append(len(rows))
        rows += [(len(rows), a), (len(rows) + 1, b)]
    got = {x.doc_id: x.component_id for x in near.similar_documents(spark.createDataFrame([(i, t, "s", "n", "l") for i, t in rows], SCHEMA)).collect()}
    found = sum(got[i + 1] == i for i in truth) / len(truth)
    assert found >= least, found
    assert not any(got[i + 1] == i for i in far)


def test_fingerprints_link_what_the_similarity_does_not(spark):
    """Pairs within three bits of op 5's fingerprint, at similarities where the sketches don't link, and pairs beyond."""
    r = random.Random(21)
    rows, linked, apart = [], [], []
    while len(linked) < 12 or len(apart) < 12:
        w = [f"w{r.randrange(10**6)}" for _ in range(250)]
        x = list(w)
        for at in r.sample(range(5, 245, 6), 9):
            x[at] = f"e{r.randrange(10**6)}"
        a, b = " ".join(w), " ".join(x)
        to = linked if (simhash.fingerprint(a.encode(), 3) ^ simhash.fingerprint(b.encode(), 3)).bit_count() <= 3 else apart
        assert jaccard(a, b) < 0.71
        if len(to) < 12:
            to.append(len(rows))
            rows += [(len(rows), a), (len(rows) + 1, b)]
    most = near.most_differing(0.8)
    assert all(sum(x != y for x, y in zip(near.sketch(rows[i][1].encode()), near.sketch(rows[i + 1][1].encode()), strict=True)) > most for i in linked)
    df = spark.createDataFrame([(i, t, "s", "n", "l") for i, t in rows], SCHEMA)
    got = {x.doc_id: x.component_id for x in near.similar_documents(df).collect()}
    assert all(got[i] == got[i + 1] == i for i in linked)
    assert all(got[i] == i and got[i + 1] == i + 1 for i in apart)
    assert {x.doc_id for x in near.one_of_each(df).collect()} == {i for i, _ in rows} - {i + 1 for i in linked}


def test_equal_sketches_with_other_fingerprints_keep_their_rows(spark):
    """The same shingles repeated unlike: one sketch, several fingerprints, one group and no row twice."""
    a, b = (" ".join(f"{c}{i}" for i in range(12)) for c in "ab")
    rows = [(4, f"{a} {b} {a} " + f"{a} " * 30), (2, f"{a} {b} {a} " + f"{a} " * 2), (9, f"{a} {b} {a} {a}"), (9, f"{a} {b} {a} {a}"), (7, "other words here")]
    texts = {t for _, t in rows[:3]}
    assert len({near.sketch(t.encode()) for t in texts}) == 1 and len({simhash.fingerprint(t.encode(), 3) for t in texts}) > 1
    df = spark.createDataFrame([(i, t, "s", "n", "l") for i, t in rows], SCHEMA)
    assert sorted((x.doc_id, x.component_id) for x in near.similar_documents(df).collect()) == [(2, 2), (4, 2), (7, 7), (9, 2), (9, 2)]
    assert sorted(x.doc_id for x in near.one_of_each(df).collect()) == [2, 7]
