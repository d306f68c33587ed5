"""Operator 2 against brute force: cosines of every line, then a walk up the directories."""

import math
import random
import re
from collections import Counter

from rootline.llm import licenses as L

SCHEMA = "doc_id long, path string, text string, unit string, term string, folder string, license string"


def brute(rows, threshold=0.6):
    words = lambda t: re.findall(L.WORD, t.lower())
    vocab = {w for t in L.TEMPLATES.values() for w in words(t)}
    df = Counter(w for _, _, t in rows for w in set(words(t or "")) & vocab)
    idf = {w: math.log((1 + len(rows)) / (1 + df[w])) + 1 for w in vocab}
    vec = lambda t: {w: c * idf[w] for w, c in Counter(x for x in words(t) if x in vocab).items()}
    size = lambda v: math.sqrt(sum(x * x for x in v.values()))
    marks = {n: vec(t) for n, t in L.TEMPLATES.items()}
    own = []
    for _, path, text in rows:
        whole = words(text or "")
        cut = lambda w: [w[a : a + n] for n in L.RUNS for a in range(0, max(1, len(w) - n // 2), n // 2)]
        units = cut(whole) + ([whole] if path and re.search(L.LICENSE_FILE, path) else [])
        for line in map(words, (text or "").split("\n")):
            units += cut(line)
        best = (0.0, None)
        for u in units:
            v = vec(" ".join(u))
            for n, m in sorted(marks.items()):
                s = round(sum(x * m.get(w, 0) for w, x in v.items()) / size(v) / size(m), 6) if v and set(L.MUST[n]) <= set(u) else 0
                if s >= threshold and (s > best[0] or s == best[0] and n < best[1]):
                    best = (s, n)
        own.append((best[0], best[1] and best[1].split('/')[0]))
    grants = {}
    for (_, path, _), (s, n) in zip(rows, own):
        if n and path and re.search(L.LICENSE_FILE, path):
            folder = path.rpartition("/")[0]
            grants[folder] = min(grants.get(folder, (9, "")), (-s, n))
    out = []
    for (i, path, _), (s, n) in zip(rows, own):
        at, got = None, n
        if not n and path is not None:
            parts = path.split("/")[:-1]
            for k in range(len(parts), -1, -1):
                if "/".join(parts[:k]) in grants:
                    at = "/".join(parts[:k])
                    got = grants[at][1]
                    break
        out.append((i, path, n, s or None, got, at))
    return sorted(out, key=str)


def rows_of():
    r = random.Random(6)
    notice = ["Licensed under CC BY-NC 4.0.", "This work is licensed under the GNU General Public License, version 3.", "Licensed under the Apache License, Version 2.0.", "Released under the MIT license."]
    plain = lambda: " ".join(r.choice(["the", "of", "this", "public", "free", "under", "é", "word", "mit"]) for _ in range(r.randrange(0, 30)))
    rows = []
    for i in range(300):
        folder = "/".join(f"d{r.randrange(3)}" for _ in range(r.randrange(0, 4)))
        text = "\n".join([plain(), *([r.choice(notice)] if r.random() < 0.2 else []), plain()])
        name = "LICENSE" if r.random() < 0.1 else f"{i}.txt"
        rows.append((i, f"{folder}/{name}" if folder else name, text))
    return [*rows, (900, "d0/LICENSE.md", notice[2] + "\n" + notice[2]), (901, None, notice[0]), (902, None, "x"), (903, "d1/d1/a", None), (903, "d1/d1/a", None), (904, "d1/b", ""), (905, "d9/c", "mit " * 50_000), (None, "d0/q", "x")]


def test_scan(spark):
    rows = rows_of()
    df = spark.createDataFrame([(i, p, t, "u", "t", "f", "l") for i, p, t in rows], SCHEMA)
    got = [(r.doc_id, r.path, r.own_license, r.score, r.license, r.inherited_from) for r in L.scan(df).collect()]
    assert sorted(got, key=str) == brute(rows)
    assert sum(1 for g in got if g[2]) > 40 and sum(1 for g in got if g[5] is not None) > 50


def test_empty_table(spark):
    assert L.scan(spark.createDataFrame([], SCHEMA)).count() == 0


def test_real_notices_find_their_template(spark):
    texts = {"Apache-2.0": "Licensed under the Apache License, Version 2.0.", "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.", "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.", "MIT": "Released under the MIT license."}
    rows = [(i, f"a/{n}.txt", "start\n" + t, None, None, None, None) for i, (n, t) in enumerate(texts.items())] + [(100 + i, f"b/{i}", "the plain text of this and that", None, None, None, None) for i in range(200)]
    got = {r.path: r.own_license for r in L.scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[f"a/{n}.txt"] == n for n in texts) and not any(got[f"b/{i}"] for i in range(200))


def licences_of(spark, texts):
    rows = [(i, f"a/{i}.txt", t, None, None, None, None) for i, t in enumerate(texts)] + [(1000 + i, f"b/{i}", "the plain text of this and that for any use", None, None, None, None) for i in range(200)]
    got = {r.doc_id: r.own_license for r in L.scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert not any(got[1000 + i] for i in range(200))
    return [got[i] for i in range(len(texts))]


def test_notices_in_long_lines_and_over_line_breaks(spark):
    r = random.Random(5)
    words = lambda n: " ".join(r.choice(["word", "the", "of", "this", "stone", "a", "river", "to", "by", "it"]) for _ in range(n))
    notices = {n: L.TEMPLATES[n] for n in L.TEMPLATES if n.endswith("/notice")}
    texts = [f"{words(r.randrange(300, 700))} {t} {words(r.randrange(300, 700))}" for t in notices.values()]
    texts += [f"{words(20)}\n{' '.join(t.split()[:3])}\n{' '.join(t.split()[3:])}\n{words(20)}" for t in notices.values()]
    tags = [n for n in L.TEMPLATES if n.endswith("/tag")]
    texts += [f"{words(50)}\n# SPDX-License-Identifier: {n.split('/')[0]}\n{words(50)}" for n in tags]
    want = [n.split("/")[0] for n in [*notices, *notices, *tags]]
    assert licences_of(spark, texts) == want


def test_licences_without_a_template_have_no_name(spark):
    assert licences_of(spark, ["Licensed under the Foo license.", "Licensed under the Zope Public License 2.1", "Permission is granted to anyone to use this software", "CeCILL-B license version 1", "the license of this work is public and free, version 3 of the general plan"]) == [None] * 5
    assert licences_of(spark, ["BSD 3-Clause License", "SPDX-License-Identifier: MIT", "GNU Lesser General Public License version 2.1", "Eclipse Public License, Version 2.0", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"]) == ["BSD-3-Clause", "MIT", "LGPL-2.1", "EPL-2.0", "ISC"]
