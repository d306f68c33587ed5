"""Toxicity: gradient-boosted trees over dense features of a text, with isotonic calibration.

Features are rates over a document's words: hits of a lexicon (density, weight, strongest entry), second-person words
and lexicon hits near them, capitals, punctuation and obfuscation (letters written as digits or signs, stretched
letters, hits that only show once these are undone). The lexicon is a short list of common insults and, with weights,
the words and word beginnings that the labelled sample shows to go with the label. A second lexicon has the beginnings
that go with the label where a document has them twice or more: an insult's stem comes back in a text, in whatever language,
and few labelled rows are enough to show it. Both are fitted crosswise: each fold of the sample gets features from the lexica
of the other folds, so the trees see honest hit rates; the final lexica are those of all. Isotonic calibration is fitted on
scores of trees that didn't see the row.

Training reads a bounded sample: at most ``sample`` labelled rows, those with the least hash of the id; scoring reads
every row. The lexicon comes from the sample, so its broadcast is bounded too.

Defined cases: null and empty texts have the features 0; without labels, or with one class only, every score is the
share of the label (0.5 without any); ids with several labels count by the least label; repeated rows are scored each;
an empty table gives an empty table; other columns pass unread.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rootline.llm.boosting import Trees, calibrated, fit_isotonic, fit_trees
from rootline.llm.common import stored
from rootline.llm.quality import held_out, labelled
from rootline.llm.words import Words, bounded, tidied, tidied_after

INSULTS = frozenset("idiot moron stupid dumb scum trash loser pathetic worthless disgusting clown jerk fool ugly filthy hate kill idiote crétin connard imbécile ordure idiota imbécil basura estúpido asqueroso dummkopf abschaum trottel arschloch widerlich".split())
SECOND = frozenset("you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine euch ihr tú ti usted ustedes vosotros".split())
_LEET = str.maketrans("013457@$!|", "oieastasil")
_STRETCH = re.compile(r"(.)\1{2,}")
_EDGE = ".,;:!?\"'()[]{}*#%&$-–—…«»“”„"
_KEEP = re.compile(r"[\W\d_]+")
_BEGIN = (3, 4, 5, 6, 7, 8)
#: Weights of words and beginnings (hashes), and of beginnings that come back.
Lexica = tuple[dict[int, float], dict[int, float]]
_FOLDS = 10
FEATURES = 21
#: So many of a document's heaviest repeated beginnings count.
_HEAVIEST = 8


def _plain(word: str) -> str:
    return word.strip(_EDGE).lower()


def _undone(word: str) -> str:
    """The word with signs for letters and stretched letters undone."""
    return _STRETCH.sub(r"\1", _KEEP.sub("", word.strip(_EDGE).lower().translate(_LEET)))


def _units_of(own: str) -> list[int]:
    """Hashes of a plain word and of its beginnings."""
    if not own:
        return []
    raw, n = own.encode(), len(own)
    if len(raw) == n:
        return [zlib.crc32(raw), *[zlib.crc32(raw[:k] + b"*") for k in _BEGIN if n >= k]]
    return [zlib.crc32(raw), *[zlib.crc32(own[:k].encode() + b"*") for k in _BEGIN if n >= k]]


def _units(word: str) -> list[int]:
    return _units_of(_plain(word))


def _marks(word: str) -> tuple[float, ...]:
    """Letters, capitals, '!', '?', other signs; all in capitals; second person; obfuscated; listed insult, undone only."""
    inner = word.strip(_EDGE)
    own = inner.lower()
    if inner.isalpha():  # most words: only their edges hold signs, and no sign stands for a letter
        letters, caps = len(inner), 0 if inner == own else sum(map(str.isupper, inner))
        odd = _STRETCH.search(own) is not None
        undone = odd and _undone(word) in INSULTS and own not in INSULTS
        edge = len(word) > letters
        return (letters, caps, edge and word.count("!"), edge and word.count("?"), len(word) - letters, letters > 1 and caps == letters, own in SECOND, odd, own in INSULTS, undone)
    letters, caps = sum(map(str.isalpha, word)), sum(map(str.isupper, word))
    odd = letters > 0 and any(not c.isalpha() and c not in "'-’." for c in inner) or _STRETCH.search(inner) is not None
    undone = _undone(word) in INSULTS and own not in INSULTS
    return (letters, caps, word.count("!"), word.count("?"), len(word) - sum(map(str.isalnum, word)), letters > 1 and caps == letters, own in SECOND, odd, own in INSULTS, undone)


def _weights(vocabulary: list[str], lexica: Lexica) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The heaviest lexicon entry of each word; and (word, beginning) for the beginnings in the second lexicon."""
    lexicon, repeated = lexica
    seen: dict[str, tuple[float, set[int]]] = {"": (0.0, set())}
    out, at, unit = np.zeros(len(vocabulary)), [], []
    for i, word in enumerate(vocabulary):
        own = word.strip(_EDGE).lower()
        if own not in seen:
            units = _units_of(own)
            seen[own] = max([lexicon[u] for u in units if u in lexicon], default=0.0), {u for u in units[1:] if u in repeated}
        out[i], mine = seen[own]
        if mine:
            at += [i] * len(mine)
            unit += mine
    return out, np.array(at, np.int64), np.array(unit, np.int64)


def _comeback(words: Words, at: np.ndarray, unit: np.ndarray, weights: dict[int, float]) -> np.ndarray:
    """Of the beginnings that come back in a document: the greatest weight, the sum of the heaviest, their density and that
    of their words' weights, and the greatest weight by how often (logarithm and rate)."""
    out, n = np.zeros((6, words.docs)), np.maximum(words.count, 1)
    if not len(at):
        return out
    names, place = np.unique(unit, return_inverse=True)
    first, size = np.searchsorted(at, np.arange(len(words.vocabulary))), np.bincount(at, minlength=len(words.vocabulary))
    token = np.flatnonzero(size[words.code])
    k = size[words.code[token]]
    flat = np.arange(k.sum()) + np.repeat(first[words.code[token]] - (np.cumsum(k) - k), k)
    key, times = np.unique(np.repeat(words.doc[token], k) * len(names) + place[flat], return_counts=True)
    key, times = key[times >= 2], times[times >= 2]
    doc, weight = key // len(names), np.array([weights[u] for u in names.tolist()])[key % len(names)]
    order = np.lexsort((-weight, doc))
    doc, weight, times = doc[order], weight[order], times[order]
    top = np.arange(len(doc)) - np.searchsorted(doc, doc) < _HEAVIEST
    np.maximum.at(out[0], doc, weight)
    out[1] = np.bincount(doc[top], weight[top], words.docs)
    out[2] = np.bincount(doc, minlength=words.docs) / n
    out[3] = np.bincount(doc, weight * times, words.docs) / n
    np.maximum.at(out[4], doc, weight * np.log1p(times))
    np.maximum.at(out[5], doc, weight * times / n[doc])
    return out


def fit_lexicon(docs: list[tuple[np.ndarray, int]], share: float = 0.5, prior: float = 2.0) -> dict[int, float]:
    """Weights of the units that go with the label: the log odds of the label given the unit, drawn to the base rate by
    ``prior`` documents, so that what few documents show weighs little."""
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    for units, y in docs:
        seen[y].update(units.tolist())
    base = (sum(y for _, y in docs) + 1) / (len(docs) + 2)
    out = {}
    for unit, n in seen[1].items():
        p = (n + prior * base) / (n + seen[0][unit] + prior)
        if p >= max(share, 2 * base):
            out[unit] = float(np.log(p / (1 - p))) + 0.1 if p < 1 else 9.0
    return out


def fit_repeated(docs: list[tuple[np.ndarray, int]], ratio: float = 2.5, prior: float = 2.0, least: int = 2) -> dict[int, float]:
    """Weights of the beginnings that, where they come back in a document, go with the label: the log odds over the base rate,
    drawn to it by ``prior`` documents, of those with ``ratio`` times the base rate in ``least`` documents of the label."""
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    for units, y in docs:
        seen[y].update(units.tolist())
    base = (sum(y for _, y in docs) + 1) / (len(docs) + 2)
    out = {}
    for unit, n in seen[1].items():
        p = (n + prior * base) / (n + seen[0][unit] + prior)
        if n >= least and p >= ratio * base:
            out[unit] = float(np.log(p / (1 - p)) - np.log(base / (1 - base))) if p < 1 else 9.0
    return out


def _repeated(words: Words, own: list[list[int]]) -> Iterator[np.ndarray]:
    """For each document the beginnings that two or more of its words have; ``own``: of each word of the vocabulary."""
    units = [np.unique(np.array(u[1:], np.uint32)) for u in own]
    cut = np.concatenate([[0], np.cumsum(words.count)])
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        code, n = np.unique(words.code[a:b], return_counts=True)
        if not len(code):
            yield np.zeros(0, np.uint32)
            continue
        mine = [units[c] for c in code.tolist()]
        unit, back = np.unique(np.concatenate(mine), return_inverse=True)
        yield unit[np.bincount(back, np.repeat(n, [len(m) for m in mine]), len(unit)) >= 2]


def _fold(doc_id) -> int:
    return zlib.crc32(f"fold{doc_id}".encode()) % _FOLDS


def features(texts: pa.Array, lexica: Lexica) -> np.ndarray:
    words = Words(texts)
    marks = np.array([_marks(w) for w in words.vocabulary], np.float64).reshape(-1, 10)
    weight, at, unit = _weights(words.vocabulary, lexica)
    n = np.maximum(words.count, 1)
    total = np.stack([words.per_doc(np.ascontiguousarray(marks[:, k])[words.code]) for k in range(10)])
    each = weight[words.code]
    hits = np.flatnonzero((each > 0) | (marks[words.code, 8] > 0))
    strongest = np.zeros(words.docs)
    np.maximum.at(strongest, words.doc[hits], each[hits])
    second = np.concatenate([[0], np.cumsum(marks[words.code, 6])])
    start = np.concatenate([[0], np.cumsum(words.count)])
    low, high = np.maximum(hits - 5, start[words.doc[hits]]), np.minimum(hits + 6, start[words.doc[hits] + 1])
    close = np.bincount(words.doc[hits], second[high] > second[low], words.docs)
    letters = np.maximum(total[0], 1)
    found = np.bincount(words.doc[hits], minlength=words.docs)
    return np.stack([
        found / n, np.log1p(found), words.per_doc(each) / n, strongest, total[8] / n, total[6] / n, close / n, total[1] / letters, total[5] / n,
        total[2] / n, total[3] / n, total[4] / n, total[7] / n, total[9] / n, np.log1p(words.count),
        *_comeback(words, at, unit, lexica[1]),
    ], axis=1)


class Model:
    def __init__(self, lexica: Lexica, trees: Trees, knots: tuple[np.ndarray, np.ndarray]):
        self.lexica, self.trees, self.knots = lexica, trees, knots

    def score(self, texts: pa.Array) -> np.ndarray:
        return calibrated(self.trees.raw(features(texts, self.lexica)), self.knots)


@tidied_after
def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", parts: int = 4, rest: int = 2, sample: int = 6_000, seed: int = 5) -> Model:
    chosen = stored(labelled(docs, labels, label, parts, rest, sample).select("doc_id", "text", "label"), "toxicity-sample").df
    kind = chosen.schema["doc_id"].dataType.simpleString()

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches):
            words = Words(batch.column(1))
            mine = [_units(w) for w in words.vocabulary]
            own = [np.array(u, np.uint32) for u in mine]
            cut = np.concatenate([[0], np.cumsum(words.count)])
            packed = []
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                parts_ = [own[c] for c in np.unique(words.code[a:b]).tolist()]
                packed.append(np.unique(np.concatenate(parts_)).astype("<u4").tobytes() if parts_ else b"")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(packed, pa.binary()), pa.array([u.astype("<u4").tobytes() for u in _repeated(words, mine)], pa.binary())], ["doc_id", "label", "units", "repeated"])

    rows = chosen.mapInArrow(tidied(units), f"doc_id {kind}, label int, units binary, repeated binary").toArrow().sort_by("doc_id")
    learned = [(np.frombuffer(u, "<u4"), np.frombuffer(r, "<u4"), y, _fold(d)) for d, y, u, r in zip(*(rows[c].to_pylist() for c in ("doc_id", "label", "units", "repeated")), strict=True)]

    def lexica(without: int | None) -> Lexica:
        own = [x for x in learned if x[3] != without]
        return fit_lexicon([(u, y) for u, _, y, _ in own]), fit_repeated([(r, y) for _, r, y, _ in own])

    spread = docs.sparkSession.sparkContext.broadcast([lexica(k) for k in range(_FOLDS)])

    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches):
            fold, x = np.array([_fold(d) for d in batch.column(0).to_pylist()]), np.zeros((batch.num_rows, FEATURES))
            for k in np.unique(fold).tolist():
                x[fold == k] = features(batch.column(1).take(pa.array(np.flatnonzero(fold == k))), spread.value[k])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "label", "x"])

    rows = chosen.mapInArrow(tidied(dense), f"doc_id {kind}, label int, x array<double>").toArrow().sort_by("doc_id")
    y = np.array(rows["label"].to_pylist(), np.float64)
    x = np.array(rows["x"].to_pylist(), np.float64).reshape(len(y), FEATURES)
    fold = np.random.default_rng(seed).permutation(len(y)) % 3
    unseen = np.zeros(len(y))
    for k in range(3):
        unseen[fold == k] = fit_trees(x[fold != k], y[fold != k]).raw(x[fold == k])
    knots = fit_isotonic(unseen, y)
    return Model(lexica(None), fit_trees(x, y), knots)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs (all columns) with score, from each whole text."""
    spread = docs.sparkSession.sparkContext.broadcast(model)
    names = [c for c in docs.columns if c != "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spread.value.score(batch.column(1)))], [*batch.schema.names, "score"])

    chosen = docs.select("doc_id", "text", *(c for c in names if c not in ("doc_id", "text")))
    return chosen.mapInArrow(tidied(run), T.StructType([*chosen.schema.fields, T.StructField("score", T.DoubleType())])).select(*names, "score")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **bounds) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each document."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels, **bounds))
    return scored.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
