"""Which pairs of sequences are worth aligning: two word hits on one diagonal, an ungapped extension, a band with gaps.

A word of a query stands in an index with all words of like score (its neighbourhood). A subject's words looked up there give
hits; two hits on one diagonal that don't overlap and lie near each other start an extension, which goes on both ways until the
score falls too far below its best. For a short query one hit is enough. What comes near the score asked for is scored with
gaps in a band around the diagonal, and what comes up to it is worth a whole alignment. Queries and subjects meet in blocks of bounded letters, each query block with each subject
block; inside a block everything is numpy, a bounded number of hits at a time, so that no hit is ever a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootline.operators.shared import shared_table

#: What a gap costs: its first letter, and each further one.
OPEN, EXTEND = 11, 1
WORD = 3
LETTERS = 26
#: Between sequences: no word has it, and no extension gets over it.
EDGE = LETTERS
_PAD = 32
#: For a query of fewer letters one hit is enough.
SHORT = 30
#: Bands have so many diagonals on both sides.
REACH = 24


@lru_cache(1)
def scores() -> np.ndarray:
    """The letters' scores, A to Z, and a row and column for the edge."""
    from rootline.operators.sequences import letter_scores

    at = np.arange(LETTERS) + ord("A")
    out = np.full((LETTERS + 1, LETTERS + 1), -(10**6), np.int64)
    out[:LETTERS, :LETTERS] = letter_scores()[np.ix_(at, at)]
    return out


def neighbours(word: int, least: int) -> np.ndarray:
    """All words that score ``least`` or more with a word; words are numbers to the base of the letters."""
    a, b, c = (scores()[x, :LETTERS] for x in (word // LETTERS**2, word // LETTERS % LETTERS, word % LETTERS))
    return np.flatnonzero((a[:, None, None] + b[:, None] + c).ravel() >= least)


def codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The letters of some sequences, with edges between and around them, and where each sequence begins. Other characters
    than A to Z count as X."""
    out, starts, at = [np.full(_PAD, EDGE, np.int64)], [], _PAD
    for t in texts:
        raw = np.frombuffer(t.encode("ascii", "replace"), np.uint8).astype(np.int64) - ord("A")
        raw[(raw < 0) | (raw >= LETTERS)] = ord("X") - ord("A")
        starts.append(at)
        out += [raw, np.full(1, EDGE, np.int64)]
        at += len(raw) + 1
    out.append(np.full(_PAD, EDGE, np.int64))
    return np.concatenate(out), np.array(starts, np.int64)


def words(letters: np.ndarray) -> np.ndarray:
    """The word at each position, -1 where an edge is in it."""
    parts = [letters[k : len(letters) - WORD + 1 + k] for k in range(WORD)]
    out = parts[0] * LETTERS**2 + parts[1] * LETTERS + parts[2]
    out[np.logical_or.reduce([p == EDGE for p in parts])] = -1
    return out


class Index:
    """The neighbourhood words of a block of queries -> positions."""

    def __init__(self, texts: list[str], least: int):
        self.letters, self.starts = codes(texts)
        self.short = np.array([len(t) < SHORT for t in texts], bool)
        own = words(self.letters)
        at = np.flatnonzero(own >= 0)
        distinct, back = np.unique(own[at], return_inverse=True)
        near = [neighbours(int(w), least) for w in distinct]
        n = np.array([len(x) for x in near], np.int64)
        flat = np.concatenate([*near, np.zeros(0, np.int64)])
        first = np.cumsum(n) - n
        size = n[back]
        where = np.repeat(first[back] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        word, pos = flat[where], np.repeat(at, size)
        order = np.argsort(word, kind="stable")
        self.positions = pos[order]
        self.first = np.searchsorted(word[order], np.arange(LETTERS**WORD + 1))

    def hits(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each of some words (index into them, position of a query)."""
        n = np.where(word >= 0, self.first[word + 1] - self.first[word], 0)
        which = np.repeat(np.arange(len(word)), n)
        return which, self.positions[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + self.first[word[which]]]


def extended(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, way: int, drop: int, step: int = 16) -> np.ndarray:
    """How much an extension from each (i, j) on, by ``way`` 1 or -1, adds to the score: its best before it falls by more than ``drop``."""
    best, now = np.zeros(len(i), np.int64), np.zeros(len(i), np.int64)
    going, far = np.arange(len(i)), 0
    table, more = scores(), np.arange(step)
    while len(going):
        off = way * (far + more)
        ai, bj = np.clip(i[going, None] + off, 0, len(a) - 1), np.clip(j[going, None] + off, 0, len(b) - 1)
        run = now[going, None] + np.cumsum(table[a[ai], b[bj]], 1)
        top = np.maximum.accumulate(np.maximum(run, best[going, None]), 1)
        fell = top - run > drop
        over = fell.any(1)
        best[going] = np.where(over, top[np.arange(len(going)), fell.argmax(1)], top[:, -1])
        now[going] = run[:, -1]
        going, far = going[~over], far + step
    return best


def block_pairs(index: Index, letters: np.ndarray, starts: np.ndarray, window: int = 40, drop: int = 16, most_hits: int = 1_000_000) -> tuple[np.ndarray, ...]:
    """(query, subject, score, diagonal) for the pairs of a block's sequences with hits enough: the best ungapped scores, one for
    each band of diagonals, and how far the subject's position is from the query's there, both from the start."""
    word = words(letters)
    n = np.where(word >= 0, index.first[word + 1] - index.first[word], 0)
    total, at, found = np.cumsum(n), 0, [[np.zeros(0, np.int64)] * 4]
    while at < len(word):
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + most_hits, "right")))
        left = max(0, at - window)  # what a second hit of this part may follow on
        which, q = index.hits(word[left:end])
        s = which + left
        key = np.sort((s - q + len(index.letters)) * len(letters) + s)
        diagonal, s = np.divmod(key, len(letters))
        q = s - diagonal + len(index.letters)
        # a diagonal of the block runs through several pairs of sequences
        of_q, of_s = np.searchsorted(index.starts, q, "right") - 1, np.searchsorted(starts, s, "right") - 1
        own = lambda lag: (diagonal[lag:] == diagonal[:-lag]) & (of_q[lag:] == of_q[:-lag]) & (of_s[lag:] == of_s[:-lag])  # noqa: E731, B023
        pair = index.short[of_q]
        for lag in range(1, WORD + 1):  # of the hits before, at most two overlap
            far = s[lag:] - s[:-lag]
            pair[lag:] |= own(lag) & (far >= WORD) & (far <= window)
        pair &= s >= at
        diagonal, s, q, of_q, of_s = (x[pair] for x in (diagonal, s, q, of_q, of_s))
        if len(s):
            # of hits in a row, the first
            new = np.ones(len(s), bool)
            new[1:] = ~own(1) | (s[1:] - s[:-1] > window)
            s, q, of = s[new], q[new], (of_q[new], of_s[new])
            score = extended(index.letters, letters, q, s, 1, drop) + extended(index.letters, letters, q - 1, s - 1, -1, drop)
            found.append(_best(*of, score, (s - starts[of[1]]) - (q - index.starts[of[0]])))
        at = end
    return _best(*map(np.concatenate, zip(*found, strict=True)))


def _best(a: np.ndarray, b: np.ndarray, score: np.ndarray, diagonal: np.ndarray, of: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """The row with the best score of each (a, b, band of diagonals), the least diagonal of equal ones."""
    band = diagonal // REACH if of is None else of
    order = np.lexsort((diagonal, -score, band, b, a))
    a, b, score, diagonal, band = a[order], b[order], score[order], diagonal[order], band[order]
    first = np.ones(len(a), bool)
    first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (band[1:] != band[:-1])
    return a[first], b[first], score[first], diagonal[first]


def banded(a: np.ndarray, b: np.ndarray, first: np.ndarray, size: np.ndarray, diagonal: np.ndarray, least: np.ndarray, end: np.ndarray, reach: int = 0, most: int = 1 << 17) -> np.ndarray:
    """The best local score with gaps of each pair within ``reach`` of a diagonal: the query is a[first : first + size], the
    subject b[least : end], and diagonals count from both starts. Pairs are worked on together, those of like lengths; a row of the band at a time is held."""
    out, reach = np.zeros(len(first), np.int64), reach or REACH
    order, wide, off = np.argsort(-size, kind="stable"), np.arange(2 * reach + 1), diagonal + least - first
    table, low = scores().astype(np.int32), np.int32(-(10**8))
    each = max(1, most // len(wide))
    for at in range(0, len(order), each):
        k = order[at : at + each]
        best, now = np.zeros(len(k), np.int32), np.zeros((len(k), len(wide) + 1), np.int32)
        up = np.full_like(now, low)
        for i in range(size[k[0]] if len(k) else 0):
            live = int(np.searchsorted(-size[k], -i, "left"))  # those with more rows than i come first
            own = k[:live]
            q = first[own] + i
            s = (q + off[own])[:, None] + wide - reach
            inside = (s >= least[own, None]) & (s < end[own, None])
            # one row further the same place of the subject is one column before
            gap = np.maximum(now[:live, 1:] - OPEN, up[:live, 1:] - EXTEND)
            score = np.maximum(now[:live, :-1] + table[a[q][:, None], b[np.clip(s, 0, len(b) - 1)]], gap)
            score = np.where(inside, np.maximum(score, 0), low)
            run = np.maximum.accumulate(score + EXTEND * wide, 1)
            score[:, 1:] = np.maximum(score[:, 1:], run[:, :-1] - (OPEN + EXTEND * (wide[1:] - 1)))
            score = np.where(inside, score, 0)
            best[:live] = np.maximum(best[:live], score.max(1))
            now[:live, :-1], up[:live, :-1] = score, np.where(inside, gap, low)
        out[k] = best
    return out


def _blocks(df: DataFrame, key: str, seq: str, most: int, name: str) -> DataFrame:
    """Sequences packed into blocks of about ``most`` letters: (name_ids, name_seqs)."""
    kinds = f"{name}_ids array<long>, {name}_seqs array<string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, seqs, size = [], [], 0
        make = lambda: pa.RecordBatch.from_arrays([pa.array([ids], pa.list_(pa.int64())), pa.array([seqs], pa.list_(pa.string()))], [f"{name}_ids", f"{name}_seqs"])
        for batch in batches:
            for i, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if ids and size + len(s) > most:
                    yield make()
                    ids, seqs, size = [], [], 0
                ids.append(i)
                seqs.append(s)
                size += len(s)
        if ids:
            yield make()

    return df.select(key, seq).mapInArrow(run, kinds)


#: A band is scored if an ungapped extension has this part of the score that is asked for, or so many points.
EXTENSION, ENOUGH = 0.4, 45


def seeded_pairs(queries: DataFrame, query: str, qseq: str, subjects: DataFrame, subject: str, sseq: str, asked, threshold: int = 11, query_letters: int = 100_000, subject_letters: int = 1_000_000) -> DataFrame:
    """(query, subject, ungapped, gapped) for the pairs that are worth an alignment: the scores of the best extension and of the
    band around it. Keys are longs, sequences upper-case letters; ``asked``: the score wanted, from a query's length.

    Work is queries x subjects in blocks, with about a hundredth of a hit for each pair of letters. Every query block meets every
    subject block: subject blocks are repeated once for each query block, so give the smaller side as queries.
    """
    own = lambda df, key, seq: df.select(F.col(key).cast("long").alias("id"), F.col(seq).alias("seq")).where("seq is not null")
    qb = shared_table(_blocks(own(queries, query, qseq), "id", "seq", query_letters, "q").withColumn("block", F.monotonically_increasing_id()), "query-blocks")
    numbers = F.broadcast(qb.agg(F.collect_list("block").alias("blocks")))  # one row, a number for each block
    sb = _blocks(own(subjects, subject, sseq), "id", "seq", subject_letters, "s")
    met = sb.join(numbers).select("s_ids", "s_seqs", F.explode("blocks").alias("block")).join(qb, "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = index = ids = want = size = None
        for batch in batches:
            for k in range(batch.num_rows):
                block, sids, subjects, qids, texts = (batch.column(c)[k].as_py() for c in ("block", "s_ids", "s_seqs", "q_ids", "q_seqs"))
                if block != now:
                    now, ids, index = block, np.array(qids, np.int64), Index(texts, threshold)
                    size = np.array([len(t) for t in texts], np.int64)
                    want = np.array([asked(max(n, 1)) for n in size.tolist()])
                sids, (letters, starts) = np.array(sids, np.int64), codes(subjects)
                end = starts + np.array([len(x) for x in subjects], np.int64)
                a, b, score, diagonal = block_pairs(index, letters, starts)
                good = score >= np.minimum(EXTENSION * want[a], ENOUGH)
                a, b, score, diagonal = a[good], b[good], score[good], diagonal[good]
                gapped = np.maximum(score, banded(index.letters, letters, index.starts[a], size[a], diagonal, starts[b], end[b]))
                good = gapped >= want[a] - 1e-9
                none = np.zeros(int(good.sum()), np.int64)
                a, b, gapped, score = _best(a[good], b[good], gapped[good], score[good], none)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids[a], sids[b], score, gapped)], ["query", "subject", "ungapped", "gapped"])

    return met.mapInArrow(run, "query long, subject long, ungapped long, gapped long")
