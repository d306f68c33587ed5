"""Line dedup: a sharded minimal perfect hash over distinct line hashes indexes fingerprint and count arrays.

A line's key is the line without the white space ``[\\x20\\x09-\\x0D]`` at its ends and with A-Z in lower case. A key
of at least ``min_chars`` code points found in at least ``min_docs`` documents loses all its lines in every document.

Three steps: (1) each document's distinct line hashes are counted, combined first inside a batch, then on the map
side, then by key; (2) the distinct keys that repeat go to shards of a bounded number of keys, and a task for each shard
builds its perfect hash with a fingerprint and a count at each slot; (3) documents probe the arrays, read the count of
each line and compare it with the threshold. Keys of one document only need no entry: what the arrays don't hold stays,
as does a line whose fingerprint isn't the one at its slot. Arrays are broadcast only in groups of ``broadcast_mb`` at
most, measured first. Where they are more, each group is probed in turn and gives the marks of the texts that it hits;
the marks, not the texts, are written, and joined to the texts once.

Defined cases: a null or empty text is one empty line; empty keys (white space only) always stay when
``min_chars`` >= 1; every row counts as a document of its own, repeated ids included; a text that loses all its lines
becomes empty; an empty table gives an empty table; columns other than doc_id and text pass unread.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rootline.llm.common import stored, text_marks
from rootline.llm.mph import Index
from rootline.llm.words import tidied

_WHITE = b" \t\n\x0b\x0c\r"
_SHARD_KEYS = 65_536


def _keys(text: bytes | None) -> list[bytes]:
    return [x.strip(_WHITE).lower() for x in (text or b"").split(b"\n")]


def _hashes(keys: list[bytes]) -> np.ndarray:
    """A row of two independent 64-bit hashes for each key."""
    raw = b"".join(xxhash.xxh3_128_digest(k) for k in keys)
    return np.frombuffer(raw, "<u8").reshape(-1, 2)


def _long_enough(keys: list[bytes], least: int) -> np.ndarray:
    if least <= 1:
        return np.fromiter((len(k) >= least for k in keys), bool, len(keys))
    return np.fromiter((len(k.decode("utf-8", "replace")) >= least for k in keys), bool, len(keys))


def _counter(min_chars: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                own = [k for k in dict.fromkeys(_keys(text)) if k]
                if own and min_chars > 1:
                    own = [k for k, ok in zip(own, _long_enough(own, min_chars), strict=True) if ok]
                elif min_chars < 1:
                    own = list(dict.fromkeys(_keys(text)))
                found += own
            h = _hashes(found)
            one, n = np.unique(np.ascontiguousarray(h).view([("a", "<u8"), ("b", "<u8")]).ravel(), return_counts=True) if len(h) else (np.zeros(0, [("a", "<u8"), ("b", "<u8")]), np.zeros(0, int))
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(one["a"]).view("<i8")), pa.array(np.ascontiguousarray(one["b"]).view("<i8")), pa.array(n.astype(np.int64))], ["h1", "h2", "n"])

    return count


def repeated_lines(docs: DataFrame, min_chars: int, least: int = 2) -> DataFrame:
    """(h1, h2, n): the two hashes of each line key found in at least ``least`` documents, and in how many."""
    each = docs.select("text").mapInArrow(tidied(_counter(min_chars)), "h1 long, h2 long, n long")
    return each.groupBy("h1", "h2").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _build(key: tuple, t: pa.Table) -> pa.Table:
    h1 = t["h1"].to_numpy().view("<u8")
    h2 = t["h2"].to_numpy().view("<u8")
    first = np.unique(h1, return_index=True)[1]  # keys that share the first hash: the others are listed apart
    rest = np.setdiff1d(np.arange(h1.size), first)
    index = Index.build(h1[first])
    at = index.find(h1[first])
    prints, counts = np.zeros(first.size, "<u8"), np.zeros(first.size, "<u4")
    prints[at] = h2[first]
    counts[at] = np.minimum(t["n"].to_numpy()[first], 2**32 - 1)
    others = {(int(a), int(b)): int(n) for a, b, n in zip(h1[rest], h2[rest], t["n"].to_numpy()[rest], strict=True)}
    blob = pickle.dumps((index, prints, counts, others))
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "blob": pa.array([blob], pa.binary()), "size": pa.array([len(blob)], pa.int64())})


def line_index(lines: DataFrame) -> tuple[DataFrame, int]:
    """The arrays by shard (shard, blob, size) and the number of shards."""
    n = lines.count()
    shards = max(1, -(-n // _SHARD_KEYS))
    split = lines.withColumn("shard", F.pmod("h1", F.lit(shards)).cast("int"))
    return split.groupBy("shard").applyInArrow(_build, "shard int, blob binary, size long"), shards


def _counts(h: np.ndarray, arrays: dict[int, bytes], shards: int, loaded: dict) -> np.ndarray:
    """The count of each pair of hashes in the arrays at hand; 0 where they don't hold it."""
    of = np.mod(np.ascontiguousarray(h[:, 0]).view("<i8"), shards)
    out = np.zeros(len(h), np.int64)
    for shard in np.unique(of).tolist():
        if shard in arrays:
            if shard not in loaded:
                loaded[shard] = pickle.loads(arrays[shard])
            index, prints, counts, rest = loaded[shard]
            rows = np.flatnonzero(of == shard)
            at = index.find(np.ascontiguousarray(h[rows, 0]))
            own = np.flatnonzero(at >= 0)
            own = own[prints[at[own]] == h[rows[own], 1]]
            out[rows[own]] = counts[at[own]]
            if rest:
                for r in rows[out[rows] == 0].tolist():
                    out[r] = rest.get((int(h[r, 0]), int(h[r, 1])), 0)
    return out


def _gone(texts: list[bytes | None], arrays, shards: int, min_docs: int, min_chars: int, loaded: dict) -> list[np.ndarray]:
    """For each text, which of its lines the arrays count in min_docs documents or more."""
    keys = [_keys(t) for t in texts]
    flat = [k for own in keys for k in own]
    drop = (_counts(_hashes(flat), arrays.value, shards, loaded) >= min_docs) & _long_enough(flat, min_chars) if flat else np.zeros(0, bool)
    return np.split(drop, np.cumsum([len(own) for own in keys])[:-1]) if keys else []


def _marker(arrays, shards: int, min_docs: int, min_chars: int):
    """(text, t1, t2) -> (t1, t2, marks: a bit for each line) of the texts with a line to drop."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded: dict = {}
        for batch in batches:
            gone = _gone(batch.column(0).cast(pa.binary()).to_pylist(), arrays, shards, min_docs, min_chars, loaded)
            rows = pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array([np.packbits(g).tobytes() for g in gone], pa.binary())], ["t1", "t2", "marks"])
            yield rows.filter(pa.array([bool(g.any()) for g in gone], pa.bool_()))

    return mark


def _prober(arrays, shards: int, min_docs: int, min_chars: int):
    """Drops the lines that the arrays count often enough, or, without arrays, those that ``_marks`` marks."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded: dict = {}
        for batch in batches:
            texts, names = batch.column("text").cast(pa.binary()).to_pylist(), [n for n in batch.schema.names if n != "_marks"]
            if arrays is None:
                size = [(t or b"").count(b"\n") + 1 for t in texts]
                gone = [np.bitwise_or.reduce([np.zeros(n, bool), *(np.unpackbits(np.frombuffer(m, np.uint8), count=n).astype(bool) for m in own or [])]) for n, own in zip(size, batch.column("_marks").to_pylist(), strict=True)]
            else:
                gone = _gone(texts, arrays, shards, min_docs, min_chars, loaded)
            kept = [(t or b"") if not g.any() else b"\n".join(x for x, out in zip((t or b"").split(b"\n"), g.tolist(), strict=True) if not out) for t, g in zip(texts, gone, strict=True)]
            cols = {n: batch.column(n) for n in names}
            cols |= {"text": pa.array(kept, pa.binary()).cast(pa.string()), "n_lines": pa.array([g.size for g in gone], pa.int64()), "n_dropped": pa.array([int(g.sum()) for g in gone], pa.int64())}
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))

    return probe


def drop_common_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, broadcast_mb: float = 64) -> DataFrame:
    """The documents with their kept text, n_lines (before dropping) and n_dropped; all other columns stay as they are."""
    spark = docs.sparkSession
    base = docs.drop("_marks", "n_lines", "n_dropped")
    repeated = stored(repeated_lines(base, min_chars, min(2, min_docs)), "lines")
    built, shards = line_index(repeated.df)
    built = stored(built, "line-arrays").df
    repeated.drop()
    groups: list[list[int]] = [[]]
    room = broadcast_mb * 1e6
    for shard, size in built.select("shard", "size").orderBy("shard").toLocalIterator():
        if groups[-1] and size > room:
            groups.append([])
            room = broadcast_mb * 1e6
        groups[-1].append(shard)
        room -= size
    schema = T.StructType([*base.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    load = lambda group: spark.sparkContext.broadcast({r.shard: bytes(r.blob) for r in built.where(F.col("shard").isin(group)).collect()} if group else {})
    if len(groups) == 1:
        return base.mapInArrow(tidied(_prober(load(groups[0]), shards, min_docs, min_chars)), schema)
    marks = []
    for group in groups:
        arrays = load(group)
        marks.append(stored(base.select("text", *text_marks()).mapInArrow(_marker(arrays, shards, min_docs, min_chars), "t1 long, t2 long, marks binary").distinct(), "line-marks").df)
        arrays.destroy()
    every = reduce(DataFrame.union, marks).groupBy(F.col("t1").alias("_line_t1"), F.col("t2").alias("_line_t2")).agg(F.collect_list("marks").alias("_marks"))  # a group gives one row a text
    own = dict(zip(("_line_a1", "_line_a2"), text_marks(), strict=True))
    joined = base.withColumns(own).join(every, (F.col("_line_a1") == F.col("_line_t1")) & (F.col("_line_a2") == F.col("_line_t2")), "left")
    return joined.select(*base.columns, "_marks").mapInArrow(_prober(None, shards, min_docs, min_chars), schema)
