"""SimHash near-dedup with covering locality-sensitive hashing.

Each document's words and word shingles give a 64-bit majority fingerprint. The 2^(r+1) - 1 masks of a covering family
are built from a mapping of bit positions to vectors of r+1 bits: mask v keeps the positions whose vector has an odd
product with v. For any r positions some v is orthogonal to all their vectors, so every pair of fingerprints at
distance r or less agrees on a whole mask: no pair is lost. Only distinct fingerprints enter the tables. Buckets of up
to ``bucket`` fingerprints are searched in blocks inside one task and give a spanning forest of their links, never
all pairs. Larger buckets go an exact way whose cost is linear: two fingerprints of a bucket differ in r of its
unmasked bits at most, so they meet when those r bits are cleared; each such key holds 2^r fingerprints at most, all
linked with each other. Components come from star contraction on the executors.

Defined cases: a null text is the empty text; a text without words has fingerprint 0 and links like any other; a text
with fewer words than a shingle is one shingle; repeated ids and repeated rows keep their rows; rows with a null
doc_id get their group's component, which is null if the group has no id at all; an empty table gives an empty table;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootline.llm.common import stored
from rootline.llm.components import components
from rootline.llm.words import tidied

BITS = 64


def fingerprint(text: bytes | None, words: int, seed: int = 42) -> int:
    own = (text or b"").lower().split()
    if not own:
        return 0
    if len(own) <= words:
        return xxhash.xxh64_intdigest(b" ".join(own), seed)
    joined = b" ".join(own)
    ends = np.cumsum(np.fromiter(map(len, own), np.int64, len(own)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], seed) for a, b in zip(starts[: len(own) - words + 1].tolist(), ends[words - 1 :].tolist(), strict=True)], np.uint64)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, h.size, 65_536):
        ones += np.unpackbits(h[i : i + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > h.size, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp: the fingerprint's bits as a long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t, words, seed) for t in batch.column(1).cast(pa.binary()).to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidied(run), "doc_id long, fp long")


def masks(radius: int) -> list[int]:
    """The covering family for 64 bits: position i has the vector (i mod (2^(r+1) - 1)) + 1."""
    n = 2 ** (radius + 1) - 1
    return [sum(1 << i for i in range(BITS) if ((i % n + 1) & v).bit_count() & 1) for v in range(1, n + 1)]


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def _forest(fp: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among fingerprints, as pairs of places; blocks bound the memory."""
    out, rest = [], np.arange(fp.size)
    while rest.size > 1:
        front, rest = rest[:1], rest[1:]
        while front.size and rest.size:
            got, by = np.zeros(rest.size, bool), np.zeros(rest.size, np.int64)
            for i in range(0, front.size, 256):
                near = np.bitwise_count(fp[front[i : i + 256], None] ^ fp[None, rest]) <= radius
                new = near.any(axis=0) & ~got
                by[new] = front[i + near[:, new].argmax(axis=0)]
                got |= new
            out += zip(by[got].tolist(), rest[got].tolist(), strict=True)
            front, rest = rest[got], rest[~got]
    return out


def _searcher(keep: list[int], radius: int, bucket: int):
    """Reads rows (v, key, fp, node) in the order of v and key; gives links, and the rows of buckets beyond the limit."""
    kinds = {"over": pa.int32(), "v": pa.int32(), "a": pa.int64(), "b": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, over = None, [], False

        def close(out: list) -> None:
            if held and not over:
                fp, node = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
                if fp.size > 1:
                    out += [(0, now[0], int(node[i]), int(node[j])) for i, j in _forest(fp, radius)]

        for batch in batches:
            out: list = []
            v, key = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            fp, node = batch.column(2).to_numpy().view(np.uint64), batch.column(3).to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero((v[1:] != v[:-1]) | (key[1:] != key[:-1])) + 1, [v.size]]) if v.size else np.zeros(1, int)
            lone = np.diff(cuts) == 1
            for n, (i, j) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
                own = (int(v[i]), int(key[i]))
                if own != now:
                    close(out)
                    now, held, over = own, [], False
                    if lone[n] and 0 < n < len(lone) - 1:
                        continue
                held.append((fp[i:j].copy(), node[i:j].copy()))
                if over or sum(h[0].size for h in held) > bucket:
                    over = True
                    out += [(1, own[0], int(f), int(d)) for h in held for f, d in zip(h[0].view(np.int64), h[1], strict=True)]
                    held = []
            yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], t) for c, t in enumerate(kinds.values())], list(kinds))
        out = []
        close(out)
        yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], t) for c, t in enumerate(kinds.values())], list(kinds))

    return run


def _clearer(keep: list[int], radius: int):
    """Each row (v, fp, node) under every choice of r unmasked bits of v, with those bits cleared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clear: dict[int, np.ndarray] = {}
        for batch in batches:
            vs, fps, nodes = (c.to_numpy() for c in batch.columns)
            for v in np.unique(vs).tolist():
                if v not in clear:
                    free = [i for i in range(BITS) if not keep[v] >> i & 1]
                    clear[v] = np.array([_signed(2**64 - 1 - sum(1 << i for i in c)) for c in combinations(free, radius)], np.int64)
                m, own = clear[v], np.flatnonzero(vs == v)
                for i in range(0, own.size, 16):
                    at = own[i : i + 16]
                    keys = (fps[at][:, None] & m[None, :]).reshape(-1)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(keys.size, v, np.int32)), pa.array(np.tile(np.arange(m.size, dtype=np.int32), at.size)), pa.array(keys), pa.array(np.repeat(nodes[at], m.size))], ["v", "c", "key", "node"])

    return run


def _cleared(over: DataFrame, keep: list[int], radius: int) -> DataFrame:
    """Links inside buckets beyond the limit: rows meet where r unmasked bits are cleared; at most 2^r meet at a key."""
    rows = over.mapInArrow(_clearer(keep, radius), "v int, c int, key long, node long")
    meet = rows.groupBy("v", "c", "key").agg(F.min("node").alias("b"), F.collect_set("node").alias("all")).where(F.size("all") > 1)
    return meet.select(F.explode("all").alias("a"), "b").where("a <> b").distinct()


def links(nodes: DataFrame, radius: int = 3, bucket: int = 4096) -> DataFrame:
    """nodes (fp, node: distinct fingerprints) -> (a, b): links that connect all that distance <= radius connects."""
    keep = masks(radius)
    tables = F.array(*[F.struct(F.lit(v).alias("v"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for v, m in enumerate(keep)])
    rows = nodes.select(F.explode(tables).alias("t"), "fp", "node").select("t.v", "t.key", "fp", "node")
    sorted_ = rows.repartition("v", "key").sortWithinPartitions("v", "key")
    found = stored(sorted_.mapInArrow(_searcher(keep, radius, bucket), "over int, v int, a long, b long"), "simhash-links").df
    near = found.where("over = 0").select("a", "b")
    over = found.where("over = 1").select("v", F.col("a").alias("fp"), F.col("b").alias("node"))
    return near if over.isEmpty() else near.union(_cleared(over, keep, radius))


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 3, bucket: int = 4096) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each document; component_id is the smallest doc_id reachable by links."""
    fps = stored(fingerprints(docs, words), "simhash").df
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("node"))
    # a fingerprint without any id still connects others: its place is a number that no document has
    least = F.coalesce(F.col("node"), F.lit(2**62) + F.pmod("fp", F.lit(2**61)))
    named = stored(nodes.select("fp", least.alias("node"), F.col("node").isNull().alias("void")), "simhash-nodes").df
    found = components(links(named.select("fp", "node"), radius, bucket), "simhash-components")
    group = named.join(found, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    group = group.withColumn("component_id", F.when(F.col("component_id") < 2**62, F.col("component_id")))
    return fps.join(group, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
