"""Quality classifier: logistic regression over hashed word n-grams, trained with follow-the-regularised-leader updates.

A document is a sparse vector: words and their shapes (letter case, digits, punctuation), pairs of neighbouring words
and shapes, and repeats of a word right after itself, each hashed to one of ``2^bits`` places; a place's value is the square root
of its share, so that the vector has length 1. Scoring is the sparse dot product with the weights plus the bias.

Training reads a bounded sample: at most ``sample`` labelled rows, those with the least hash of the id, whatever the
size of the corpus; scoring reads every row. The weights are 2^bits numbers, so their broadcast is bounded.

Defined cases: null and empty texts have no features and get the score of the bias; ids with several labels count by
the least label; labels that are null, or have no document, are not learned from; without any label the score is 0.5;
repeated rows are scored each; a null id is held in like any other remainder; an empty table gives an empty table;
other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rootline.llm.words import Words, bounded, tidied, tidied_after

BITS = 18


@lru_cache(maxsize=50_000)
def _faces(word: str) -> tuple[int, int]:
    """Hashes of a word without case and outer punctuation, and of its shape."""
    core = word.strip(_OUTER)
    tail = word[len(word.rstrip(_OUTER)) :][:3]
    case = "U" if core.isupper() and len(core) > 1 else "T" if core[:1].isupper() else "l"
    shape = f"{case}{min(len(core), 12)}{'9' * any(c.isdigit() for c in core)}{'@' * bool(_ODD.search(core))}{tail}"
    return zlib.crc32(core.lower().encode()), zlib.crc32(b"shape:" + shape.encode())


_OUTER = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
_ODD = re.compile(r"[^\w'-]")


def _mix(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    x = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (np.uint64(0xC2B2AE3D27D4EB4F) * np.asarray(b, np.uint64))
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def features(texts: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, place, value) of all features that are not zero, by document."""
    words = Words(texts)
    faces = np.array([_faces(w) for w in words.vocabulary], np.uint64).reshape(-1, 2)
    core, shape = faces[words.code, 0], faces[words.code, 1]
    doc = words.doc
    pair = doc[1:] == doc[:-1]
    again = pair & (words.code[1:] == words.code[:-1])
    hashes = [_mix(core, 1), _mix(shape, 2), _mix(_mix(core[:-1], core[1:]), 3)[pair], _mix(_mix(shape[:-1], shape[1:]), 4)[pair], _mix(np.ones(int(again.sum()), np.uint64), 5)]
    docs = [doc, doc, doc[1:][pair], doc[1:][pair], doc[1:][again]]
    key = np.concatenate([(d.astype(np.uint64) << np.uint64(bits)) | (h >> np.uint64(64 - bits)) for d, h in zip(docs, hashes, strict=True)])
    at, n = np.unique(key, return_counts=True)
    doc, place = (at >> np.uint64(bits)).astype(np.int64), (at & np.uint64(2**bits - 1)).astype(np.int64)
    return doc, place, np.sqrt(n / np.bincount(doc, n, words.docs)[doc])


class Ftrl:
    """Per-coordinate FTRL-proximal with L1 and L2 terms; place 2^bits is the bias."""

    def __init__(self, bits: int = BITS, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(2**bits + 1), np.zeros(2**bits + 1)

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, place: np.ndarray, value: np.ndarray, label: int) -> None:
        at, x = np.append(place, self.z.size - 1), np.append(value, 0.3)
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], updates: int = 24_000, seed: int = 3, bits: int = BITS) -> np.ndarray:
    """The weights from (places, values, label) rows, in as many passes over them as make about so many updates, 30 at most."""
    model, order = Ftrl(bits), np.arange(len(rows))
    g = np.random.default_rng(seed)
    for _ in range(min(30, -(-updates // max(1, len(rows))))):
        g.shuffle(order)
        for i in order.tolist():
            model.learn(*rows[i])
    return model.weights(slice(None))


def held_out(doc_id: str, parts: int, rest: int) -> Column:
    """Whether crc32 of the id as text has that remainder; a null id has the checksum of the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % parts == rest


def labelled(docs: DataFrame, labels: DataFrame, label: str, parts: int, rest: int, sample: int) -> DataFrame:
    """(doc_id, text, label) of a bounded sample of the rows to learn from."""
    marks = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out("doc_id", parts, rest))
    marks = marks.groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
    marks = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # the sample has a bound of its own, so it may be broadcast; of the rows of an id the least text is learned
    return docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))


@tidied_after
def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", parts: int = 5, rest: int = 0, sample: int = 6_000, bits: int = BITS) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches):
            doc, place, value = features(batch.column(1), bits)
            cut = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            packed = [(place[a:b].astype("<i4").tobytes(), value[a:b].astype("<f4").tobytes()) for a, b in zip(cut[:-1], cut[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([p for p, _ in packed], pa.binary()), pa.array([v for _, v in packed], pa.binary())], ["doc_id", "label", "places", "vals"])

    chosen = labelled(docs, labels, label, parts, rest, sample).select("doc_id", "text", "label")
    kind = chosen.schema["doc_id"].dataType.simpleString()
    rows = chosen.mapInArrow(tidied(run), f"doc_id {kind}, label int, places binary, vals binary").toArrow().sort_by("doc_id")
    learned = [(np.frombuffer(p, "<i4").astype(np.int64), np.frombuffer(v, "<f4").astype(np.float64), y) for y, p, v in zip(*(rows[c].to_pylist() for c in ("label", "places", "vals")), strict=True)]
    return train(learned, bits=bits)


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """docs (all columns) with score: the sparse dot product of each whole text's features with the weights."""
    spread, bits = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32)), int(np.log2(weights.size - 1))
    names = [c for c in docs.columns if c != "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = spread.value
        for batch in bounded(batches):
            doc, place, value = features(batch.column(1), bits)
            dot = np.bincount(doc, value * w[place], batch.num_rows) + 0.3 * w[-1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-np.clip(dot, -35, 35))))], [*batch.schema.names, "score"])

    order = ["doc_id", "text", *(c for c in names if c not in ("doc_id", "text"))]
    chosen = docs.select(*order)
    return chosen.mapInArrow(tidied(run), T.StructType([*chosen.schema.fields, T.StructField("score", T.DoubleType())])).select(*names, "score")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **bounds) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each document."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels, **bounds))
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
