"""Operators 3 and 7: held-out accuracy on the driver's tables and on planted texts, calibration, and the defined cases."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from rootline.llm import boosting, quality, toxicity
from tests.conftest import SF

SF = SF.replace("0.001", "0.1")
CASES = {"toxicity": (toxicity, 4, 2), "quality": (quality, 5, 0)}


def planted(n=600, seed=1):
    r = random.Random(seed)
    word = lambda: "".join(r.choice(["an", "the", "ing", "or", "st", "ea", "re"]) for _ in range(r.randrange(1, 4)))
    rows = []
    for i in range(n):
        words = [word() for _ in range(r.randrange(20, 200))]
        bad, junk = r.random() < 0.2, r.random() < 0.2
        if bad:
            for _ in range(3):
                words[r.randrange(len(words))] = r.choice(["grobnik" + word(), "zlost" + word(), "IDIOT!!"])
        if junk:
            words = [w.upper() + "!!" for w in words]
        rows.append((i, " ".join(words), int(not junk), int(bad)))
    return rows


@pytest.mark.parametrize("name", CASES)
def test_planted_labels_are_learned(spark, name):
    op, parts, rest = CASES[name]
    rows = planted()
    odd = [(9000, None), (9001, ""), (9002, "x " * 100_000), (None, "plain words"), (5, rows[5][1])]
    docs = spark.createDataFrame([(i, t, "s", 0.0, 1) for i, t, _, _ in rows] + [(i, t, "s", 0.0, 1) for i, t in odd], "doc_id long, text string, source string, score double, label int")
    labels = spark.createDataFrame([(i, q, x) for i, _, q, x in rows] + [(9500, 1, 1), (None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    got = op.classify(docs, labels).collect()
    assert len(got) == len(rows) + len(odd)
    at = {r.doc_id: r for r in got}
    want = {i: (x if name == "toxicity" else q) for i, _, q, x in rows}
    out = [i for i in want if zlib.crc32(str(i).encode()) % parts == rest]
    assert {i for i in want if at[i].held_out} == set(out)
    assert sum(at[i].predicted == want[i] for i in out) >= 0.95 * len(out)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert at[9000].score == at[9001].score


def area(scores, labels):
    """The share of (positive, negative) pairs that the score orders rightly; ties count half."""
    good, bad = [x for x, y in zip(scores, labels) if y], [x for x, y in zip(scores, labels) if not y]
    return sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))


@pytest.mark.parametrize("name,sf,least_area,recall,precision,rejected", [
    ("toxicity", "0.01", 0.95, 0.8, 0.8, 0.95), ("toxicity", "0.1", 0.99, 0.95, 0.93, 0.98),
    ("quality", "0.01", 0.98, 0.98, 0.95, 0.8), ("quality", "0.1", 0.98, 0.98, 0.95, 0.8),
])
def test_tables_of_the_driver(spark, name, sf, least_area, recall, precision, rejected):
    """Floors that a constant answer misses, each class by itself; rejected: of label 0, the share that is called 0."""
    op, _, _ = CASES[name]
    label, at = "toxic" if name == "toxicity" else "quality", SF.replace("0.1", sf)
    docs, labels = spark.read.parquet(f"{at}/documents.parquet"), spark.read.parquet(f"{at}/labels.parquet")
    rows = op.classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    ones, zeros = [r for r in rows if r[label]], [r for r in rows if not r[label]]
    hit = sum(r.predicted for r in ones)
    figures = (area([r.score for r in rows], [r[label] for r in rows]), hit / len(ones), hit / max(1, sum(r.predicted for r in rows)), sum(not r.predicted for r in zeros) / len(zeros))
    print(name, sf, len(rows), len(ones), *(round(x, 3) for x in figures))
    assert all(x >= y for x, y in zip(figures, (least_area, recall, precision, rejected))), figures


TEXTS = ["", None, "You are an IDIOT!! you 1d10t", "Plain words, of the usual kind. 12 of them", "stuuuupid @#$ (fool) you're", "A a A a zlost é É! " * 30, "\t x  \n\x0b y\x0cz ", "don't don't 3.5% e-mail U.S.A."]


def split(text):
    return re.findall(r"[^\t-\r ]+", text or "")


def test_toxicity_features_and_scores_against_a_slow_version():
    g = random.Random(3)
    texts = TEXTS + [" ".join(g.choice(split(TEXTS[2]) + split(TEXTS[4]) + split(TEXTS[7]) + ["gro", "zlost", "A"]) for _ in range(g.randrange(40))) for _ in range(60)]
    lexicon = {zlib.crc32(b"zlost"): 2.5, zlib.crc32(b"gro*"): 1.25, zlib.crc32(b"stu*"): 0.5}
    repeated = {zlib.crc32(b"don*"): 1.5, zlib.crc32(b"zlo*"): 3.0, zlib.crc32(b"zlos*"): 0.25, zlib.crc32("élan*".encode()): 2.0, zlib.crc32(b"zlost"): 7.0}
    edge, leet = ".,;:!?\"'()[]{}*#%&$-–—…«»“”„", dict(zip("013457@$!|", "oieastasil"))

    def weight(own):
        units = [own, *[own[:k] + "*" for k in range(3, 9) if len(own) >= k]] if own else []
        return max([lexicon.get(zlib.crc32(u.encode()), 0.0) for u in units], default=0.0)

    def undone(own):
        kept = "".join(c for c in (leet.get(c, c) for c in own) if c.isalpha())
        return re.sub(r"(.)\1\1+", r"\1", kept)

    def slow(text):
        words = split(text)
        n, letters, caps, bang, ask, other, loud, second, odd, listed, hidden, found, close, total, top = len(words), 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0.0, 0.0
        mine = [w.strip(edge).lower() for w in words]
        for i, (w, own) in enumerate(zip(words, mine)):
            inner = w.strip(edge)
            a, c = sum(x.isalpha() for x in w), sum(x.isupper() for x in w)
            letters, caps, bang, ask, other = letters + a, caps + c, bang + w.count("!"), ask + w.count("?"), other + sum(not x.isalnum() for x in w)
            loud += a > 1 and a == c
            second += own in toxicity.SECOND
            odd += (a > 0 and any(not x.isalpha() and x not in "'-’." for x in inner)) or re.search(r"(.)\1\1", inner) is not None
            listed += own in toxicity.INSULTS
            hidden += undone(own) in toxicity.INSULTS and own not in toxicity.INSULTS
            x = weight(own)
            total, top = total + x, max(top, x)
            if x or own in toxicity.INSULTS:
                found += 1
                close += any(m in toxicity.SECOND for m in mine[max(0, i - 5) : i + 6])
        n1, l1 = max(n, 1), max(letters, 1)
        times = Counter(own[:k] for own in mine for k in range(3, 9) if len(own) >= k)
        again = sorted(((repeated[u], c) for b, c in times.items() if c >= 2 and (u := zlib.crc32((b + "*").encode())) in repeated), reverse=True)
        back = [max((w for w, _ in again), default=0), sum(w for w, _ in again[:8]), len(again) / n1, sum(w * c for w, c in again) / n1]
        back += [max((w * np.log1p(c) for w, c in again), default=0), max((w * c / n1 for w, c in again), default=0)]
        return [found / n1, np.log1p(found), total / n1, top, listed / n1, second / n1, close / n1, caps / l1, loud / n1, bang / n1, ask / n1, other / n1, odd / n1, hidden / n1, np.log1p(n), *back]

    x = toxicity.features(pa.array(texts), (lexicon, repeated))
    want = np.array([slow(t) for t in texts])
    assert np.allclose(x, want), np.argwhere(~np.isclose(x, want))[:5]
    y = (x[:, 0] > 0).astype(float)
    trees, knots = boosting.fit_trees(x, y), boosting.fit_isotonic(x[:, 0], y)

    def walk(row):
        out = trees.base
        for f, c, leaf in zip(trees.feature, trees.cut, trees.leaf):
            at = 0
            while at < len(f):
                at = 2 * at + (2 if row[f[at]] >= c[at] else 1)
            out += leaf[at - len(f)]
        return out

    def rise(v):
        xs, ys = knots
        if v <= xs[0]:
            return ys[0]
        for (a, p), (b, q) in zip(zip(xs, ys), zip(xs[1:], ys[1:])):
            if v <= b:
                return q if a == b else p + (q - p) * (v - a) / (b - a)
        return ys[-1]

    got = toxicity.Model((lexicon, repeated), trees, knots).score(pa.array(texts))
    assert np.allclose(got, [rise(walk(slow(t))) for t in texts])


def test_quality_features_and_scores_against_a_slow_version():
    g = random.Random(4)
    texts = TEXTS + [" ".join(g.choice(split(" ".join(filter(None, TEXTS)))) for _ in range(g.randrange(50))) for _ in range(40)]
    weights = np.random.default_rng(2).standard_normal(2**quality.BITS + 1)
    outer, top = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()), 2**64 - 1

    def mix(a, b):
        x = (a * 0x9E3779B97F4A7C15 & top) ^ (0xC2B2AE3D27D4EB4F * b & top)
        x = (x ^ (x >> 29)) * 0xBF58476D1CE4E5B9 & top
        return x ^ (x >> 32)

    def faces(w):
        core = w.strip(outer)
        tail = w[len(w.rstrip(outer)) :][:3]
        case = "U" if len(core) > 1 and core.isupper() else "T" if core and core[0].isupper() else "l"
        shape = case + str(min(len(core), 12)) + ("9" if any(c.isdigit() for c in core) else "") + ("@" if any(not (c.isalnum() or c in "_'-") for c in core) else "") + tail
        return zlib.crc32(core.lower().encode()), zlib.crc32(("shape:" + shape).encode())

    def slow(text):
        words = split(text)
        own = [faces(w) for w in words]
        keys = [k for c, s in own for k in (mix(c, 1), mix(s, 2))]
        for i in range(1, len(words)):
            (c, s), (d, t) = own[i - 1], own[i]
            keys += [mix(mix(c, d), 3), mix(mix(s, t), 4)] + [mix(1, 5)] * (words[i] == words[i - 1])
        n = Counter(k >> (64 - quality.BITS) for k in keys)
        dot = sum((m / len(keys)) ** 0.5 * float(np.float32(weights[p])) for p, m in n.items()) + 0.3 * float(np.float32(weights[-1]))
        return 1 / (1 + np.exp(-dot))

    doc, place, value = quality.features(pa.array(texts))
    w = weights.astype(np.float32)
    got = 1 / (1 + np.exp(-(np.bincount(doc, value * w[place], len(texts)) + 0.3 * w[-1])))
    assert np.allclose(got, [slow(t) for t in texts], atol=1e-6)


def test_rows_of_one_id_are_learned_by_the_least_text(spark):
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1)], "doc_id long, quality int")
    rows = quality.labelled(docs, labels, "quality", 5, 9, 10).select("doc_id", "text", "label").collect()
    assert sorted(map(tuple, rows)) == [(1, "a", 0), (2, None, 1)]


@pytest.mark.parametrize("name", CASES)
def test_without_labels_and_rows(spark, name):
    op, _, _ = CASES[name]
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert {r.score for r in op.classify(docs, labels).collect()} == {0.5}
    assert op.classify(docs.where("doc_id > 5"), labels).count() == 0


def test_labels_of_one_class(spark):
    docs = spark.createDataFrame([(i, "a b") for i in range(9)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(9)], "doc_id long, quality int, toxic int")
    assert {r.predicted for r in toxicity.classify(docs, labels).collect()} == {0}
    assert {r.predicted for r in quality.classify(docs, labels).collect()} == {1}


def test_trees_fit_and_isotonic_rises():
    g = np.random.default_rng(1)
    x = g.random((2000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    raw = boosting.fit_trees(x, y).raw(x)
    assert ((raw > 0) == y).mean() > 0.97
    s = g.random(3000)
    knots = boosting.fit_isotonic(s, (g.random(3000) < s**2).astype(float))
    out = boosting.calibrated(np.linspace(0, 1, 200), knots)
    assert (np.diff(out) >= 0).all() and np.abs(out - np.linspace(0, 1, 200) ** 2).mean() < 0.05


def test_sparse_vectors_have_length_one():
    doc, place, value = quality.features(pa.array(["a b a", None, "", "C d"]))
    norms = np.sqrt(np.bincount(doc, value**2, 4))
    assert np.allclose(norms, [1, 0, 0, 1]) and place.max() < 2**quality.BITS


def test_whole_texts_count():
    model = quality.train([quality.features(pa.array(["ok fine"]))[1:] + (1,), quality.features(pa.array(["BAD!!"]))[1:] + (0,)] * 20)
    doc, place, value = quality.features(pa.array(["ok fine " * 5000, "ok fine " * 5000 + "BAD!! " * 9000]))
    a, b = np.bincount(doc, value * model[place], 2)
    assert b < a


@pytest.mark.parametrize("name", CASES)
def test_fit_gives_the_driver_its_memory_back(spark, monkeypatch, name):
    tidied = []
    monkeypatch.setattr("rootline.llm.words.tidy", lambda: tidied.append(name))  # what the workers append stays with them
    docs = spark.createDataFrame([(i, f"some words {i % 5} of text {i}") for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    CASES[name][0].fit(docs, labels)
    assert tidied == [name]
