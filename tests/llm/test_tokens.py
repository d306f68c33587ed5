"""Operators 1 and 6 against the public libraries, and the packing plan against its bounds."""

import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from rootline.llm import bpe, packing, vocab

SCHEMA = "doc_id long, text string, piece string, ids string, block int, length string"
ODD = ["", None, " ", "  \n\n x", "don't  we'll 12,5 €", "\x1c\x1d a\x85b\xa0c", "<|endoftext|> é", "漢字 かな 🙂👍🏽", "a" * 9000, "ß" * 3000 + " \t" * 2000, "x\r\n\r\n  y"]


def docs_of(spark, texts):
    return spark.createDataFrame([(100 - i, t, "c", "c", 1, "c") for i, t in enumerate(texts)], SCHEMA)


def texts():
    r = random.Random(4)
    return [*ODD, *["".join(r.choice(["ab", "é", " ", "\n", "Th", "12", "'s", "—"]) for _ in range(r.randrange(1, 4000))) for _ in range(40)], "same", "same"]


def test_packing_query(spark):
    own = texts()
    rows = packing.pack_documents(docs_of(spark, own), P.path("byte_bpe_50k.json"), P.PATTERN, 512).collect()
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    want = Counter()
    for i, t in enumerate(own):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        first = ids.size % 512 or 512
        for k, a in enumerate([0, *range(first, ids.size, 512)]):
            part = ids[a : first if k == 0 else a + 512]
            want[(100 - i, k, a, part.size, zlib.crc32(part.tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for own in by.values():
        at = 0
        for a, n in sorted(own):
            assert a == at
            at += n
        assert at <= 512
    assert len(by) <= -(-sum(k[3] * n for k, n in want.items()) // 512) + 1


def test_ids_travel_on_request(spark):
    rows = packing.pack_documents(docs_of(spark, ["a b", "c " * 900]), P.path("byte_bpe_50k.json"), P.PATTERN, 512, with_ids=True).collect()
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length for r in rows)


def test_packing_empty_table(spark):
    assert packing.pack_documents(docs_of(spark, []).where("doc_id > 0"), P.path("byte_bpe_50k.json"), P.PATTERN).count() == 0


def fewest(sizes, cap):
    """The least number of bins, by search."""
    sizes, best = sorted(sizes, reverse=True), [len(sizes)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(rooms)
            return
        for k in {r: j for j, r in enumerate(rooms) if r >= sizes[i]}.values():
            go(i + 1, [*rooms[:k], rooms[k] - sizes[i], *rooms[k + 1 :]])
        go(i + 1, [*rooms, cap - sizes[i]])

    go(0, [])
    return best[0]


def check_plan(counts, cap):
    plan = packing.Plan(dict(counts), cap)
    seen, bins = Counter(), defaultdict(list)
    for size, first, n, seq, off, per in plan.runs:
        for i in range(first, first + n):
            seen[(size, i)] += 1
            bins[seq + (i - first) // per].append((off + size * ((i - first) % per), size))
    assert seen == Counter({(s, i): 1 for s, n in counts.items() for i in range(n)})
    assert sorted(bins) == list(range(plan.sequences))
    for own in bins.values():
        at = 0
        for a, s in sorted(own):
            assert a == at
            at += s
        assert at <= cap
    return plan


def test_reduction_keeps_the_optimum():
    r = random.Random(9)
    fixed = 0
    for _ in range(300):
        cap = r.randrange(8, 40)
        sizes = [r.randrange(1, cap + 1) for _ in range(r.randrange(1, 9))]
        plan = check_plan(Counter(sizes), cap)
        least = fewest(sizes, cap)
        reduced = [s for run in plan.runs if run[3] < plan.fixed for s in [run[0]] * run[2]]
        rest = list((Counter(sizes) - Counter(reduced)).elements())
        assert plan.fixed + fewest(rest, cap) == least if rest else plan.fixed == least
        fixed += plan.fixed
    assert fixed > 500


def test_plan_is_near_the_bound_on_many_items():
    r = random.Random(1)
    counts = Counter(min(2048, int(r.lognormvariate(5.5, 1.2)) + 1) for _ in range(100_000))
    plan = check_plan(counts, 2048)
    assert plan.sequences <= -(-sum(s * n for s, n in counts.items()) // 2048) * 1.001 + 1
    assert plan.fixed > 0


def library():
    raw = dict((base64.b64decode(a), int(b)) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb")))
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=raw, special_tokens={})


@pytest.mark.parametrize("block", [8, 0.01])
def test_bpe_query(spark, block):
    own, lib = texts(), library()
    want = Counter()
    for i, t in enumerate(own):
        ids = np.array(lib.encode_ordinary(t or ""), "<u4").tobytes()
        want[(100 - i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())] += 1
    rows = bpe.encode_decode(docs_of(spark, own), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN, block).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == want


def test_bpe_real_outputs_and_empty_table(spark):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    row = bpe.encode_decode(docs_of(spark, ["wé go"]), path, P.PATTERN, with_ids=True).first()
    assert row.ids == library().encode_ordinary("wé go") and bytes(row.decoded).decode() == "wé go"
    assert bpe.encode_decode(docs_of(spark, []).where("doc_id > 0"), path, P.PATTERN).count() == 0


def test_both_files_of_a_vocabulary_agree():
    assert vocab.ranks(P.path("byte_bpe_50k.json")) == vocab.ranks(P.path("byte_bpe_50k.tiktoken"))


def test_answers_for_other_words_are_refused():
    from rootline.llm import bpe

    assert bpe._digest(["ab", "c"]) != bpe._digest(["a", "bc"]) != bpe._digest([])


def test_threads_do_not_delete_each_others_tables(spark):
    import threading

    from rootline.llm.common import scratch, stored

    began, made, out = threading.Event(), threading.Event(), []

    def other():
        began.wait(60)
        out.append(stored(spark.range(7), "other"))
        made.set()

    thread = threading.Thread(target=other)
    thread.start()
    with scratch():
        mine = stored(spark.range(3), "mine")
        with scratch():
            inner = stored(spark.range(2), "inner")
        began.set()
        assert made.wait(60) and mine.df.count() == 3
    thread.join()
    assert out[0].df.count() == 7
    for gone in (mine, inner):
        p = spark._jvm.org.apache.hadoop.fs.Path(gone.path)
        assert not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
    out[0].drop()
