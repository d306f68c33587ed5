"""Byte-level BPE encoding and decoding by a global distinct-word shuffle.

Documents are packed into blocks of bounded bytes, compressed. Each block splits its texts into pre-tokens and sends
its distinct ones, by hash, to word shards; a shard encodes each distinct word of the corpus once and sends the ids back
to the blocks that asked; a block joins the ids to its words and puts each document's ids together by position. Words
travel in sorted, packed lists, and ids come back in the order of the words asked for. Positions are those in the block's
texts, so no pre-token occurrence is shuffled: exploded into rows they would be several times the input. Decoding joins
the token-byte table (fixed by the vocabulary) to the ids by position.

Each answer carries a digest of the words asked for, and a block refuses one for other words: should a lost executor's part
of the input be read again in another order, the query fails instead of giving other words' ids.

A shard's words are in memory one shard at a time; the number of shards follows the bytes of text, so that a shard's
size doesn't grow with the corpus.

Defined cases: a null text is the empty text, with no ids; a text longer than a block is a block of its own; repeated
rows and ids stay rows of their own; a null doc_id is kept; an empty table gives an empty table; other columns are not
read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootline.llm import vocab
from rootline.llm.words import bounded, tidied


def _pack(parts: list[bytes]) -> bytes:
    lens = np.array([len(p) for p in parts], "<u4").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(len(parts).to_bytes(8, "little") + lens + b"".join(parts))


def _unpack(blob: bytes) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int.from_bytes(raw[:8], "little")
    ends = np.cumsum(np.frombuffer(raw, "<u4", n, 8)).tolist() if n else []
    at = 8 + 4 * n
    return [raw[at + a : at + b] for a, b in zip([0, *ends[:-1]], ends, strict=True)] if n else []


def _by_shard(words: set[str], shards: int) -> dict[int, list[str]]:
    """Words by shard, sorted."""
    out: dict[int, list[str]] = {}
    for w in sorted(words):
        out.setdefault(zlib.crc32(w.encode()) % shards, []).append(w)
    return out


def _digest(words: list[str]) -> int:
    return zlib.crc32("\0".join(words).encode())


def blocker(most: int):
    """(doc_id, text) -> (block, docs): about ``most`` bytes of text to a block, as compressed Arrow."""

    def close(n: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(pa.Table.from_batches(held).combine_chunks())
        name = ((TaskContext.get().partitionId() if TaskContext.get() else 0) << 32) + n
        return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["block", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = size = 0
        held: list[pa.RecordBatch] = []
        for batch in batches:
            batch = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(pa.large_string())], ["doc_id", "text"])
            for part in bounded([batch], most):
                own = part.column(1).nbytes
                if held and size + own > most:
                    yield close(n, held)
                    n, size, held = n + 1, 0, []
                held.append(part)
                size += own
        if held:
            yield close(n, held)

    return run


def _docs(blob: bytes) -> tuple[pa.ChunkedArray, list[str]]:
    t = pa.ipc.open_stream(blob).read_all()
    return t["doc_id"], [x or "" for x in t["text"].to_pylist()]


def encode_decode(docs: DataFrame, path: str, pattern: str, block_mb: float = 8, shard_blocks: int = 8, with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids, decoded]) for each document."""
    spark = docs.sparkSession
    most = max(1, int(block_mb * 1e6))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // most))
    shards = max(8, -(-size // (most * shard_blocks)))
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidied(blocker(most)), "block long, docs binary").repartition(blocks, "block")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = vocab.pieces_of(pattern).findall
        for batch in batches:
            for b, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own: set[str] = set()
                for t in _docs(blob)[1]:
                    own.update(split(t))
                by = _by_shard(own, shards)
                yield pa.RecordBatch.from_arrays([pa.array([b] * len(by), pa.int64()), pa.array(list(by), pa.int32()), pa.array(list(map(_digest, by.values())), pa.int64()), pa.array([_pack([w.encode() for w in p]) for p in by.values()], pa.binary())], ["block", "shard", "digest", "words"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Reads the shards one after the other."""
        known: dict[bytes, bytes] = {}
        now = None
        for batch in batches:
            one, blobs = vocab.encoder(path, pattern)._encode_single_piece, []
            for shard, blob in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if shard != now:
                    known, now = {}, shard
                words = _unpack(blob)
                for w in words:
                    if w not in known:
                        known[w] = np.array(one(w), "<u4").tobytes()
                blobs.append(_pack([known[w] for w in words]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(blobs, pa.binary())], ["block", "shard", "digest", "ids"])

    def join(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        split, bytes_at = vocab.pieces_of(pattern).findall, vocab.token_bytes(path)
        doc_ids, texts = _docs(left["docs"][0].as_py())
        back = {s: (d, b) for s, d, b in zip(*(right[c].to_pylist() for c in ("shard", "digest", "ids")), strict=True)}
        pieces = [split(t) for t in texts]
        ids_of: dict[str, bytes] = {}
        for s, words in _by_shard(set().union(*pieces), shards).items():
            digest, blob = back.get(s, (None, b""))
            if digest != _digest(words):
                raise RuntimeError("an answer is for other words than this block's: its rows came in another order when they were read again")
            ids_of.update(zip(words, _unpack(blob), strict=True))
        cols: list[list] = [[], [], [], [], []]
        for own in pieces:
            raw = b"".join(map(ids_of.__getitem__, own))
            ids = np.frombuffer(raw, "<u4")
            text = b"".join(map(bytes_at.__getitem__, ids.tolist()))
            row = (ids.size, hashlib.sha256(raw).hexdigest(), hashlib.sha256(text).hexdigest())
            for c, x in zip(cols, (*row, ids.astype(np.int32), text) if with_ids else row, strict=False):
                c.append(x)
        out = {"doc_id": doc_ids, "n_tokens": pa.array(cols[0], pa.int64()), "ids_sha256": pa.array(cols[1], pa.string()), "decoded_sha256": pa.array(cols[2], pa.string())}
        if with_ids:
            out |= {"ids": pa.array(cols[3], pa.list_(pa.int32())), "decoded": pa.array(cols[4], pa.binary())}
        return pa.table(out)

    asked = dealt.mapInArrow(tidied(ask), "block long, shard int, digest long, words binary")
    answers = asked.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(tidied(answer), "block long, shard int, digest long, ids binary")
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded binary" * with_ids
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(join, schema)
