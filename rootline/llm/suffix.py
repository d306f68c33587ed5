"""Exact substring dedup by distributed prefix doubling: what of a text also stands elsewhere.

A byte goes if a string of ``size`` bytes that covers it also starts anywhere else. Strings are ranked by names that grow by
pairs of names at growing offsets (``repeats.py``); Spark sorts the names of all blocks, those that are unique leave, and the
rest go on to longer strings until they are unique or past the threshold:

1. 32 bytes, at anchors only: each window of ``size`` bytes has one, and equal windows have theirs at equal distances. The
   hull of all windows of an anchor is named too; a hull that is repeated decides all of its windows at once.
2. ``size`` - 12 bytes, shared by up to 13 neighbouring windows, and the hulls of these.
3. ``size`` bytes: the windows themselves.

Naming every byte of the corpus in a row of its own would be some 30 times the input for each round.

Texts are packed into blocks, written once to the shared folder, bucketed by block, so that the rounds shuffle names and marks
but never texts. A block sends each name once, by hash, to name shards, with the sum of its weights, so a string that all texts
share comes at most once from each block; a shard sorts its names and answers which are repeated. What a hull decides must
still be met by others' windows: one representative of it, and only if a window that is not decided has the same name, goes on
as a witness. Names have 128 bits; each answer carries a digest of what was asked.

Defined cases: a null text is the empty text; a text shorter than ``size`` loses nothing; long texts are worked on in segments;
repeated rows are texts of their own, so each loses all of its windows; a null doc_id is kept; an empty table gives an empty
table; other columns are not read. Memory of a task: some 40 bytes for each byte of a segment, and a block or a longer text.
"""

from __future__ import annotations

import hashlib
import pickle
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootline.llm import repeats
from rootline.llm.bpe import blocker
from rootline.llm.common import Stored, hold, shared_dir, stored
from rootline.llm.repeats import Windows
from rootline.llm.words import tidied

MESSAGE = "block long, shard int, digest long, body binary"
STATE = -1


def _texts(blob: bytes) -> tuple[pa.ChunkedArray, np.ndarray, np.ndarray]:
    """The ids of a block, the bytes of its texts and where each ends."""
    t = pa.ipc.open_stream(blob).read_all().combine_chunks()
    text = pc.fill_null(t["text"], "").combine_chunks()
    text = pa.concat_arrays(text.chunks) if isinstance(text, pa.ChunkedArray) else text
    length = pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64)
    _, offsets, raw = text.buffers()
    first = np.frombuffer(offsets, np.int64)[text.offset] if len(text) else 0
    data = np.frombuffer(raw, np.uint8)[first : first + length.sum()] if raw is not None else np.zeros(0, np.uint8)
    return t["doc_id"], data, np.cumsum(length)


def _squeeze(x: object) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(x, protocol=5))


def _open(blob: bytes):
    return pickle.loads(zstandard.ZstdDecompressor().decompress(blob))


class _Question:
    """The distinct names of a block by shard, and the answers for each of the names given."""

    def __init__(self, keys: np.ndarray, weight: np.ndarray, shards: int):
        self.names, self.weight, self.place, self.first = repeats.distinct(keys, weight)
        shard = (self.names[:, 1] % np.uint64(shards)).astype(np.int64)
        self.order = np.argsort(shard, kind="stable")
        self.shard, at = np.unique(shard[self.order], return_index=True)
        self.parts = np.split(self.order, at[1:]) if len(at) else []

    def rows(self, block: int) -> list[tuple]:
        out = []
        for s, at in zip(self.shard.tolist(), self.parts, strict=True):
            own = self.names[at].tobytes()
            out.append((block, s, zlib.crc32(own), own + self.weight[at].tobytes()))
        return out

    def answers(self, got: dict[int, tuple[int, bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """For each name given: whether it is repeated, and whether it is the first of all its equals anywhere."""
        repeated, first = np.zeros(len(self.names), bool), np.zeros(len(self.names), bool)
        for s, at in zip(self.shard.tolist(), self.parts, strict=True):
            digest, body = got[s]
            if digest != zlib.crc32(self.names[at].tobytes()):
                raise RuntimeError("an answer is for other names than those asked")
            bits = np.unpackbits(np.frombuffer(body, np.uint8), count=2 * len(at)).astype(bool)
            repeated[at], first[at] = bits[: len(at)], bits[len(at) :]
        return repeated[self.place], first[self.place] & self.first


def _answer(rows: pa.Table) -> pa.Table:
    """A shard: sorts the names of all blocks and says of each whether their weights come to 2, and who has it first."""
    rows = rows.sort_by("block")
    bodies = [x.as_py() for x in rows["body"]]
    n = [len(b) // 17 for b in bodies]
    keys = np.concatenate([np.frombuffer(b, np.uint64, 2 * k).reshape(-1, 2) for b, k in zip(bodies, n, strict=True)])
    weight = np.concatenate([np.frombuffer(b, np.uint8, k, 16 * k) for b, k in zip(bodies, n, strict=True)])
    _, total, place, first = repeats.distinct(keys, weight)
    repeated, ends = (total >= 2)[place], np.cumsum(n)
    out = [np.packbits(np.concatenate([repeated[e - k : e], first[e - k : e]])).tobytes() for e, k in zip(ends.tolist(), n, strict=True)]
    return pa.table({"block": rows["block"], "shard": rows["shard"], "digest": rows["digest"], "body": pa.array(out, pa.binary())})


class _Finder:
    """The steps of one block. ``spans``: how many neighbouring windows share a name, from round to round, the last one 1."""

    def __init__(self, size: int, shards: int):
        self.size, self.shards = size, shards
        self.spans = [size - repeats.BASE + 1, 13, 1]

    def _names(self, level: int, data: np.ndarray, ends: np.ndarray, state: dict | None) -> tuple[Windows, np.ndarray, np.ndarray, np.ndarray]:
        """What a round looks at: parts, which of them are witnesses, names of what they share, names of their hulls."""
        if level == 0:
            w, inner, hull = repeats.anchors(data, ends, self.size)
            return w, np.zeros(len(w.lo), bool), inner, hull
        w, run, inner, hull = repeats.cut_names(state["windows"], data, self.size, self.spans[level])
        return w, state["witness"][run], inner, hull

    def _asked(self, level: int, witness: np.ndarray, inner: np.ndarray, hull: np.ndarray) -> _Question:
        weight = 1 + witness.astype(np.uint8)
        last = level == len(self.spans) - 1  # a part is then a window, and all that it shares is itself
        return _Question(hull, weight, self.shards) if last else _Question(np.concatenate([inner, hull]), np.tile(weight, 2), self.shards)

    def ask(self, level: int, data: np.ndarray, ends: np.ndarray, state: dict | None) -> _Question:
        _, witness, inner, hull = self._names(level, data, ends, state)
        return self._asked(level, witness, inner, hull)

    def decide(self, level: int, data: np.ndarray, ends: np.ndarray, state: dict | None, got: dict) -> dict:
        """Takes a round's answers: stretches that go, parts that aren't decided, and parts that may be their witnesses."""
        w, witness, inner, hull = self._names(level, data, ends, state)
        repeated, first = self._asked(level, witness, inner, hull).answers(got)
        n = len(w.lo)
        inner_again, hull_again, hull_first = repeated[:n], repeated[-n:] if n else repeated, first[-n:] if n else first
        gone = hull_again & ~witness
        old = state["gone"] if state else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        own = w[gone]
        stretches = repeats.merged(np.concatenate([old[0], own.lo]), np.concatenate([old[1], own.lo + own.width + self.size - 1]), ends)
        if level == len(self.spans) - 1:
            return {"gone": stretches}
        on = inner_again & ~hull_again & ~witness
        may = witness | (gone & hull_first)
        return {"gone": stretches, "windows": w[on | may], "witness": may[on | may]}

    def call(self, level: int, data: np.ndarray, state: dict) -> _Question:
        """Parts that aren't decided announce what they share; possible witnesses ask whether anyone did."""
        inner = repeats.shared_names(state["windows"], data, self.size, self.spans[level])
        return _Question(inner, np.where(state["witness"], 0, 2).astype(np.uint8), self.shards)

    def heed(self, level: int, data: np.ndarray, state: dict, got: dict) -> dict:
        called, _ = self.call(level, data, state).answers(got)
        stay = called | ~state["witness"]
        return state | {"windows": state["windows"][stay], "witness": state["witness"][stay]}


def _messages(rows: list[tuple]) -> pa.Table:
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
    return pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["block", "shard", "digest", "body"])


def _received(right: pa.Table) -> tuple[dict | None, dict[int, tuple[int, bytes]]]:
    state, got = None, {}
    for s, d, b in zip(right["shard"].to_pylist(), right["digest"].to_pylist(), right["body"].to_pylist(), strict=True):
        if s == STATE:
            state = _open(b)
        else:
            got[s] = (d, b)
    return state, got


def remove_repeats(docs: DataFrame, size: int = 200, block_mb: float = 4, shard_mb: float = 64, with_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept, spans]) for each document; ``kept`` are the remaining bytes,
    ``spans`` the removed stretches as (start, end) in bytes. ``size``: from 140 to 208 bytes."""
    spark = docs.sparkSession
    if not 140 <= size <= 208:  # names are of 128 to 384 bytes: size - 12 at least, 2 x size - 32 at most
        raise ValueError("size: from 140 to 208 bytes")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(total / (shard_mb * 1e6)))
    finder = _Finder(size, max(8, int(total / (shard_mb * 1e6))))
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidied(blocker(max(1, int(block_mb * 1e6)))), "block long, docs binary")
    name = f"repeats_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/{name}"
    dealt.repartition(buckets, "block").write.bucketBy(buckets, "block").option("path", path).saveAsTable(name)
    blocks = spark.table(name)
    hold(Stored(blocks, path))
    spark.sql(f"DROP TABLE {name}")  # the files stay in the shared folder; the name was needed to write them in buckets
    last = len(finder.spans) - 1

    def first_questions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                _, data, ends = _texts(blob)
                yield from _messages(finder.ask(0, data, ends, None).rows(b)).to_batches()

    def step(level: int, decide: bool):
        def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
            b, (_, data, ends), (state, got) = key[0].as_py(), _texts(left["docs"][0].as_py()), _received(right)
            if decide:
                state = finder.decide(level, data, ends, state, got)
                asked = finder.call(level, data, state)
            else:
                state = finder.heed(level, data, state, got)
                asked = finder.ask(level + 1, data, ends, state)
            return _messages([(b, STATE, 0, _squeeze(state)), *asked.rows(b)])

        return run

    def finish(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        (ids, data, ends), (state, got) = _texts(left["docs"][0].as_py()), _received(right)
        lo, end = finder.decide(last, data, ends, state, got)["gone"]
        starts = np.concatenate([[0], ends[:-1]])
        text = np.searchsorted(ends, lo, "right")
        n = np.bincount(text, minlength=len(ends))
        at = np.cumsum(n) - n
        rows: list[list] = [[], [], [], []]
        raw = memoryview(np.ascontiguousarray(data)) if len(data) else memoryview(b"")
        for k, (a, z) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)):
            own = list(zip(lo[at[k] : at[k] + n[k]].tolist(), end[at[k] : at[k] + n[k]].tolist(), strict=True))
            kept, now = [], a
            for x, y in own:
                kept.append(raw[now:x])
                now = y
            kept.append(raw[now:z])
            digest = hashlib.sha256()
            for part in kept:
                digest.update(part)
            for have, new in zip(rows, (sum(y - x for x, y in own), digest.hexdigest(), b"".join(kept) if with_text else None, [(x - a, y - a) for x, y in own] if with_text else None), strict=True):
                have.append(new)
        out = {"doc_id": ids, "n_bytes": pa.array(ends - starts, pa.int64()), "n_removed": pa.array(rows[0], pa.int64()), "n_spans": pa.array(n, pa.int64()), "kept_sha256": pa.array(rows[1], pa.string())}
        if with_text:
            out |= {"kept": pa.array(rows[2], pa.binary()), "spans": pa.array([[{"start": x, "end": y} for x, y in s] for s in rows[3]], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))}
        return pa.table(out)

    told = blocks.mapInArrow(tidied(first_questions), MESSAGE).groupBy("shard").applyInArrow(_answer, MESSAGE)
    for level in range(last):
        for decide in (True, False):
            out = stored(blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(step(level, decide), MESSAGE), "repeats").df
            told = out.where(F.col("shard") == STATE).union(out.where(F.col("shard") != STATE).groupBy("shard").applyInArrow(_answer, MESSAGE))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary, spans array<struct<start: long, end: long>>" * with_text
    return blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(finish, schema)
