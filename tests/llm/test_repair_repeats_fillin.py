"""Conversation repair, exact substring dedup and fill-in-the-middle against slow versions."""

import hashlib
import itertools
import random
import zlib

import duckdb
import numpy as np
import pytest

from rootline.llm import conversations, fillin, queries, repeats, suffix
from tests.conftest import SF

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sha(x) -> str:
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


# -- oracles ----------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["op11_repair", "op13_fill_in_middle"])
def test_oracle(spark, name):
    df = queries.QUERIES[name](spark, SF)
    db = duckdb.connect()
    for t in ("documents", "conversations"):
        db.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = db.sql(queries.ORACLES[name])
    assert sorted(got.columns) == sorted(df.columns)
    at = [got.columns.index(c) for c in df.columns]
    key = lambda r: tuple(map(repr, r))
    assert sorted((tuple(r) for r in df.collect()), key=key) == sorted((tuple(r[i] for i in at) for r in got.fetchall()), key=key)


# -- conversation repair ----------------------------------------------------------------------------------------------


def slow_repair(rows):
    """rows (turn, role, text) after damage, in order -> the fields of a plan and the repaired lines, by trying all paths."""
    faults, seen = [], set()
    for _, role, text in rows:
        core = text.strip(conversations.WHITE)
        faults.append("blank" if not core else "duplicate" if (role, text) in seen else "" if core[-1] in ".!?" else "truncated")
        seen.add((role, text))
    best = {(0, 0): (0, "", ())}  # (rows taken, state) -> least (cost, audit, lines)
    keep, put = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}, {0: 2, 1: 2, 2: 3, 3: 2}
    role_of = {2: "user", 3: "assistant"}
    for i in range(len(rows) + 1):
        for _ in range(3):  # at most two rows put in after each other are of use
            for q in range(4):
                if (i, q) in best:
                    c, a, x = best[i, q]
                    new = (c + 2, a + "I", (*x, role_of[put[q]] + ":"))
                    best[i, put[q]] = min(best.get((i, put[q]), new), new)
        if i == len(rows):
            break
        (_, role, text), fault = rows[i], faults[i]
        for q in range(4):
            if (i, q) not in best:
                continue
            c, a, x = best[i, q]
            after = [(q, (c + 3, a + "D", x))]
            if fault in ("", "truncated"):
                w = fault == "truncated"
                after.append((put[q], (c + 2 + w, a + "R", (*x, f"{role_of[put[q]]}:{text}"))))
                if (q, role[:1]) in keep:
                    after.append((keep[q, role[:1]], (c + w, a + "K", (*x, f"{role}:{text}"))))
            for to, new in after:
                best[i + 1, to] = min(best.get((i + 1, to), new), new)
    cost, audit, lines = min(best[len(rows), q] for q in (0, 3) if (len(rows), q) in best)
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    return gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, lines


def test_automaton_finds_the_least_audit_of_the_cheapest_repairs():
    rng = random.Random(1)
    machine = conversations.Determinised()
    for n in [*range(6)] * 300 + [40] * 50:
        rows = [(k, rng.choice(["system", "user", "assistant", "tool", "s", ""]), rng.choice(["a.", "b", " ", "c!"]) + str(k) * rng.randint(0, 1) + rng.choice(["", "."])) for k in range(n)]
        *_, cost, audit, _ = slow_repair(rows)
        seen, symbols = set(), []
        for _, role, text in rows:
            core = text.strip(conversations.WHITE)
            symbols.append(conversations.symbol(role, conversations.GONE if not core or (role, text) in seen else conversations.FINE if core[-1] in ".!?" else conversations.TRUNCATED))
            seen.add((role, text))
        assert machine.repair(bytes(symbols)) == (cost, audit), rows
    assert len(machine.vectors) < 200  # dominated entries go, so the vectors stay few


def test_automaton_tables_stay_small_on_long_conversations():
    machine, rng = conversations.Determinised(), random.Random(2)
    cost, audit = machine.repair(bytes(rng.randrange(12) for _ in range(200_000)))
    assert len(machine.vectors) < 50 and len(machine.steps) < 1000 and len(audit) >= 200_000 and cost > 0


def slow_conversations(rows):
    out = {}
    words = lambda v: " " if v is None else str(v)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, words(r[2]))):
        h = zlib.crc32(f"{words(conv)}:{words(turn)}".encode()) % 20
        role, text = words(role), words(text)
        role = "user" if h == 4 else role
        text = "" if h == 1 else text.translate(str.maketrans("", "", ".!?")) if h == 2 else text
        out.setdefault(conv, []).extend([(turn, role, text)] * {0: 0, 3: 2}.get(h, 1))
    return out


def test_repair_matches_the_slow_version(spark):
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["system", "user", "assistant", "tool", "", None]), rng.choice([f"x{t}.", f"y{t}", "ok.", "", " \t", None, "é?", "long " * 500 + "."])) for c in [None, -1, *range(60)] for t in rng.sample(range(30), rng.randint(1, 12))]
    rows += [(7, None, "user", "no turn."), (7, None, "assistant", "none either"), (500, 3, None, None), *[(600, t, "user", "same.") for t in range(300)], (601, 5, "user", "twice."), (601, 5, "user", "twice.")]
    rows += [(800, t, "user" if t % 2 == 0 else "assistant", f"{t}.") for t in range(3000)]  # cut over several partitions
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, 9, "x") for r in rows], "conv_id long, turn long, role string, text string, kind long, plan string").repartition(5)
    got = {r[0]: tuple(r)[1:] for r in conversations.repair(df).collect()}
    want = slow_conversations(rows)
    assert set(got) == set(want)
    for conv, own in want.items():
        *fields, lines = slow_repair(own)
        assert got[conv] == (*fields, sha("\n".join(lines))), conv


def test_repaired_rows_are_those_of_the_audit(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = conversations.damage(df)
    plans = conversations.plan_repairs(rows)
    got = conversations.repaired_rows(rows, plans).collect()
    audits = {r.conv_id: r.audit for r in plans.collect()}
    by = {}
    for r in sorted(got, key=lambda r: (r.conv_id, r.place)):
        by.setdefault(r.conv_id, []).append(r)
    assert all("".join(r.edit for r in by.get(c, [])) == a.replace("D", "") for c, a in audits.items())
    for own in by.values():
        assert [r.place for r in own] == list(range(len(own)))
        roles = "".join(r.role[0] for r in own).removeprefix("s")
        assert roles == "ua" * (len(roles) // 2)


def test_repair_of_an_empty_table_and_of_a_dropped_conversation(spark):
    kind = "conv_id long, turn long, role string, text string"
    assert conversations.repair(spark.createDataFrame([], kind)).collect() == []
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = conversations.repair(spark.createDataFrame([(gone, 0, "user", "x.")], kind)).collect()
    assert [tuple(r) for r in got] == [(gone, 0, 0, 0, 0, 0, 0, "", sha(""))]


# -- exact substring dedup --------------------------------------------------------------------------------------------


def slow_repeats(rows, size=200):
    texts = [(i, (t or "").encode()) for i, t in rows]
    count = {}
    for _, b in texts:
        for k in range(len(b) - size + 1):
            count[b[k : k + size]] = count.get(b[k : k + size], 0) + 1
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for k in range(len(b) - size + 1):
            if count[b[k : k + size]] > 1:
                gone[k : k + size] = b"\1" * size
        spans = [(k, next(j for j in range(k, len(b) + 1) if j == len(b) or not gone[j])) for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1])]
        out.append((i, len(b), sum(gone), len(spans), sha(bytes(x for x, y in zip(b, gone, strict=True) if not y)), spans))
    return out


def key(r):
    return tuple(map(repr, r))


def tough_texts():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(n) for n in (20, 45, 60, 80, 300)]
    texts = [prose(rng.randint(0, 200)) for _ in range(60)]
    texts += [prose(30) + s[: rng.randint(1, len(s))] + prose(30) + s[rng.randint(0, len(s) - 1) :] for s in shared for _ in range(8)]
    texts += [shared[4][k : k + n] for k in (0, 1, 7, 50) for n in (198, 199, 200, 201, 202, 260, 800)]
    texts += [None, "", "x" * 199, "x" * 200, "y" * 201, "z" * 5000, "ab" * 500, "abc" * 67, "é" * 100, "é" * 101, "né" * 90]
    base = prose(400)
    for _ in range(10):  # near copies: single letters changed
        t = list(base)
        for _ in range(rng.randint(0, 6)):
            t[rng.randrange(len(t))] = "#"
        texts.append("".join(t))
    texts += [base, base, "short", "short"]
    return [(k, t) for k, t in enumerate(texts)]


@pytest.mark.parametrize("block_mb", [0.0005, 0.02, 4])
def test_repeats_match_the_slow_version(spark, block_mb):
    rows = tough_texts() + [(None, "no id " * 60)]
    df = spark.createDataFrame([(i, t, "en", None, 0, "x", 1) for i, t in rows], DOCS + ", docs string, block long").repartition(3)
    got = [(*tuple(r)[:5], [tuple(s) for s in r.spans]) for r in suffix.remove_repeats(df, block_mb=block_mb, shard_mb=0.01, with_text=True).collect()]
    want = slow_repeats(rows)
    assert sorted(got, key=key) == sorted(want, key=key)
    kept = {r.doc_id: bytes(r.kept) for r in suffix.remove_repeats(df, block_mb=block_mb, with_text=True).collect()}
    assert all(sha(kept[i]) == h for i, *_, h, _ in want)


def test_repeats_on_the_given_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in queries.QUERIES["op12_suffix"](spark, SF).collect())
    assert got == sorted(r[:5] for r in slow_repeats(rows))


@pytest.mark.parametrize("size", [140, 208])
def test_repeats_of_other_lengths(spark, size):
    rows = tough_texts()
    got = suffix.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), size=size, block_mb=0.01).collect()
    assert sorted(map(tuple, got)) == sorted(r[:5] for r in slow_repeats(rows, size))


def test_repeats_empty_table_and_repeated_rows(spark):
    assert suffix.remove_repeats(spark.createDataFrame([], DOCS)).collect() == []
    text = "".join(random.Random(5).choices("abcdefgh", k=300))
    got = suffix.remove_repeats(spark.createDataFrame([(1, text), (1, text), (2, text[:199])], "doc_id long, text string")).collect()
    assert sorted(tuple(r)[:4] for r in got) == [(1, 300, 300, 1), (1, 300, 300, 1), (2, 199, 0, 0)]


def test_segments_do_not_change_the_anchors():
    data = np.frombuffer("".join(random.Random(6).choices("abcd ", k=60_000)).encode(), np.uint8)
    ends = np.array([150, 400, 400, 5_000, 60_000])
    whole, cut = (repeats.anchors(data, ends, 200, segment=s) for s in (1 << 19, 1000))
    order = np.argsort(cut[0].lo)
    assert (np.sort(whole[0].lo) == cut[0].lo[order]).all() and (whole[2][np.argsort(whole[0].lo)] == cut[2][order]).all()
    assert whole[0].width.sum() == sum(max(0, e - s - 199) for s, e in zip([0, *ends[:-1]], ends, strict=True))


def test_an_answer_for_other_names_is_refused():
    q = suffix._Question(np.arange(20, dtype=np.uint64).reshape(-1, 2), np.ones(10, np.uint8), 2)
    with pytest.raises(RuntimeError, match="other names"):
        q.answers({s: (0, b"") for s in (0, 1)})


# -- fill in the middle -----------------------------------------------------------------------------------------------


def slow_fill(doc_id, text):
    t = text or ""
    h = sha("1:" + ("" if doc_id is None else str(doc_id)))
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(t)
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, t
    p, q = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b, z = t[:p], t[p:q], t[q:]
    form = "spm" if h4 % 100 < 20 else "psm"
    return doc_id, n, form, p, q - p, f"<S>{z}<P>{a}<M>{b}" if form == "spm" else f"<P>{a}<S>{z}<M>{b}"


def test_fill_in_middle_matches_the_slow_version(spark):
    rng = random.Random(7)
    letters = ["\x01", "\x02", "e", "d", "é", "😀", " ", "\n", "\r", "<", "P>", "S>", ">", "$0", "\\", "á", "\x00"]
    rows = [(k, "".join(rng.choices(letters, k=rng.randint(0, 12)))) for k in range(600)] + [(k, f"text {k} <M> x") for k in range(600, 620)]
    rows += [(None, "no id"), (None, None), (1, None), (2, ""), (3, "x" * 300_000), (4, "\x01\x02" * 50_000), (5, "same"), (5, "same")]
    df = spark.createDataFrame([(*r, "m", 1, "f") for r in rows], "doc_id long, text string, marks string, n long, form string")
    got = fillin.fill_in_middle(df)
    assert sorted(map(tuple, got.collect()), key=key) == sorted((slow_fill(*r) for r in rows), key=key)
    back = fillin.digests(got).collect()
    assert sorted((repr(r.doc_id), r.output_sha256, r.restored_sha256) for r in back) == sorted((repr(i), sha(slow_fill(i, t)[5]), sha(t or "")) for i, t in rows)


def test_fill_in_middle_takes_other_columns_and_seeds(spark):
    df = spark.createDataFrame([(k, f"some text {k}") for k in range(200)], "id long, body string")
    one, two = (fillin.fill_in_middle(df, "id", "body", seed=s, percent=100, percent_spm=50).collect() for s in ("1", "2"))
    assert {r.form for r in one} == {"psm", "spm"} and [r.output for r in one] != [r.output for r in two]
    assert fillin.fill_in_middle(spark.createDataFrame([], DOCS)).collect() == []


def test_text_is_marked_once(spark):
    plan = fillin.digests(fillin.fill_in_middle(spark.read.parquet(f"{SF}/documents.parquet")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_replace") == 1 and "Python" not in plan and "Exchange" not in plan
