"""Names of strings in a block of texts by doubling, and the state of windows that may be repeated.

A name stands for the rank that a string has among all strings of its length: equal strings, and only these, share it (two
lanes of 64 bits). Names of 1, 2, 4, 8, 16 and 32 bytes are built at every position from pairs of names at growing offsets;
longer ones from pairs of names of 32, 64 and 128 bytes at the positions that still need one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

U = np.uint64
BASE = 32
#: Bytes that are named together.
SEGMENT = 1 << 17
_LIMIT = 1 << 24  # bytes of a segment's buffer: places in it take 24 bits
_MUL = (U(0x9E3779B97F4A7C15), U(0xD6E8FEB86659FD93))


def _scramble(x: np.ndarray) -> np.ndarray:
    """A fixed mixing of 64-bit numbers (splitmix64's last steps)."""
    x = np.atleast_1d(x)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_BYTE = [_scramble(np.arange(1 + 256 * k, 257 + 256 * k, dtype=np.uint64) * _MUL[k]) for k in (0, 1)]


def _pair(a: np.ndarray, b: np.ndarray, mul: np.uint64) -> np.ndarray:
    """The name of a pair of names."""
    out = a * mul
    out += b
    out ^= out >> U(32)
    return out


def base_names(data: np.ndarray) -> list[np.ndarray]:
    """Both lanes of the names of the 32 bytes from each position on."""
    out = []
    for byte, mul in zip(_BYTE, _MUL, strict=True):
        x, h = byte[data], 1
        while h < BASE:
            x = _pair(x[:-h], x[h:], mul)
            h *= 2
        out.append(x)
    return out


def names(base: list[np.ndarray], at: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    """Names, (n, 2), of the strings of 128 to 384 bytes from ``at`` on."""
    out = np.empty((len(at), 2), np.uint64)
    for k, (x, mul) in enumerate(zip(base, _MUL, strict=True)):

        def long(q, x=x, mul=mul):
            return _pair(_pair(x[q], x[q + 32], mul), _pair(x[q + 64], x[q + 96], mul), mul)

        whole = _pair(_pair(long(at), long(at + (length - 128) // 2), mul), long(at + length - 128), mul)
        out[:, k] = _scramble(whole + np.asarray(length).astype(np.uint64) * mul)
    return out


@dataclass
class Windows:
    """Runs of neighbouring windows with one anchor: the place of each run's first window, the anchor's distance from it
    (``rel``), and the number of windows (``width``)."""

    lo: np.ndarray
    rel: np.ndarray
    width: np.ndarray

    def __getitem__(self, at) -> Windows:
        return Windows(self.lo[at], self.rel[at], self.width[at])


def _tagged(key: np.ndarray, tag: np.ndarray | int) -> np.ndarray:
    key[:, 0] ^= _scramble((np.asarray(tag).astype(np.uint64) + U(1)) * U(0xA0761D6478BD642F))
    return key


def anchors(data: np.ndarray, ends: np.ndarray, size: int, segment: int = 0) -> tuple[Windows, np.ndarray, np.ndarray]:
    """The windows of ``size`` bytes inside texts, by their anchor: the place of the least 32-byte name in a window, the first
    of equal ones; with the names of the anchors' 32 bytes and those of the runs' hulls (first window's start to last one's
    end). ``ends``: of the texts in the data.

    Equal windows have their anchors at equal distances. The data are worked on in segments, whatever the lengths of texts.
    """
    span, segment = size - BASE + 1, segment or SEGMENT
    out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(3)] + [[np.zeros((0, 2), np.uint64)] for _ in range(2)]
    starts = np.concatenate([[0], ends[:-1]])
    for s in range(0, len(data), segment):
        e, left = min(s + segment, len(data)), max(0, s - span + 1)
        part = data[left : e + 2 * size]
        if len(part) < size:
            continue
        base = base_names(part)
        key = base[0] & ~U(_LIMIT - 1)
        key |= np.arange(len(key), dtype=np.uint64)
        h = 1
        while 2 * h <= span:
            key = np.minimum(key[:-h], key[h:])
            h *= 2
        if h < span:
            key = np.minimum(key[: len(key) - (span - h)], key[span - h :])
        anchor = (key & U(_LIMIT - 1)).astype(np.int64)
        # windows that would reach over the end of their text don't count
        near = slice(*np.searchsorted(ends, [left, left + len(part) + size]))
        over = np.zeros(len(part) + 1, np.int32)
        np.add.at(over, np.clip(np.maximum(starts[near], ends[near] - size + 1) - left, 0, len(part)), 1)
        np.add.at(over, np.clip(ends[near] - left, 0, len(part)), -1)
        p = np.flatnonzero((np.cumsum(over[: len(anchor)]) == 0) & (anchor >= s - left) & (anchor < e - left))
        if not len(p):
            continue
        a = anchor[p]
        at = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
        first, last, own = p[at], np.concatenate([p[at[1:] - 1], p[-1:]]), a[at]
        found = first + left, own - first, last - first + 1, _tagged(np.stack([x[own] for x in base], 1), 0), names(base, first, last - first + size)
        for have, new in zip(out, found, strict=True):
            have.append(new)
    lo, rel, width, inner, hull = map(np.concatenate, out)
    return Windows(lo, rel, width), inner, hull


def cut(w: Windows, span: int) -> tuple[Windows, np.ndarray]:
    """Runs cut at distances from the anchor that are multiples of ``span``, and the run that each part is of."""
    least = w.rel - w.width + 1
    a = least // span
    n = w.rel // span - a + 1
    run = np.repeat(np.arange(len(n)), n)
    j = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n) + a[run]
    far, close = np.minimum(w.rel[run], j * span + span - 1), np.maximum(least[run], j * span)
    return Windows(w.lo[run] + w.rel[run] - far, far, far - close + 1), run


def _gathered(data: np.ndarray, lo: np.ndarray, length: np.ndarray):
    """For segments of stretches: which they are, where each begins, and the names of their bytes. A segment at a time is
    gathered, so that the arrays stay in the processor's cache."""
    for k in _parts(np.cumsum(length), SEGMENT):
        start = np.cumsum(length[k]) - length[k]
        yield k, start, base_names(data[np.arange(start[-1] + length[k][-1]) + np.repeat(lo[k] - start, length[k])])


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([np.zeros((0, 2), np.uint64), *parts])


def _inner(base: list[np.ndarray], at: np.ndarray, length: int, tag: np.ndarray) -> np.ndarray:
    return _tagged(np.stack([x[at] for x in base], 1) if length == BASE else names(base, at, length), tag)


def shared_names(w: Windows, data: np.ndarray, size: int, span: int) -> np.ndarray:
    """Of runs cut by ``span``: the names of what all windows at a part's distances from the anchor share."""
    j, length = w.rel // span, size - span + 1
    lo = w.lo + w.rel - j * span
    return _joined([_inner(base, start, length, j[k]) for k, start, base in _gathered(data, lo, np.full(len(lo), length))])


def cut_names(w: Windows, data: np.ndarray, size: int, span: int) -> tuple[Windows, np.ndarray, np.ndarray, np.ndarray]:
    """Runs cut by ``span``: the parts, the run of each, the names of what their windows share, and of their hulls."""
    own, run = cut(w, span)
    j, inner, hull = own.rel // span, [], []
    for k, start, base in _gathered(data, w.lo, w.width + size - 1):
        of = slice(*np.searchsorted(run, [k.start, k.stop]))
        at = start[run[of] - k.start] + (own.lo[of] - w.lo[run[of]])
        hull.append(names(base, at, own.width[of] + size - 1))
        if span > 1:
            inner.append(_inner(base, at + own.rel[of] - j[of] * span, size - span + 1, j[of]))
    return own, run, _joined(inner if span > 1 else hull), _joined(hull)


def _parts(total: np.ndarray, most: int):
    """Slices of what adds up to ``most`` each, or is one alone."""
    at = 0
    while at < len(total):
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + most, "right")))
        yield slice(at, end)
        at = end


def distinct(keys: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct names, sorted; the sums of their weights, 2 at most; the place of each name among them; whether it is the
    first of its equals."""
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    own = keys[order]
    new = np.ones(len(own), bool)
    new[1:] = (own[1:] != own[:-1]).any(1)
    place, first = np.empty(len(own), np.int64), np.zeros(len(own), bool)
    place[order] = np.cumsum(new) - 1
    first[order[new]] = True
    at = np.flatnonzero(new)
    total = np.add.reduceat(weight[order].astype(np.int64), at) if len(at) else np.zeros(0, np.int64)
    return own[new], np.minimum(total, 2).astype(np.uint8), place, first


def merged(lo: np.ndarray, end: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The unions of stretches [lo, end) that overlap or touch inside one text; ``ends``: of the texts."""
    order = np.argsort(lo, kind="stable")
    lo, end = lo[order], np.maximum.accumulate(end[order]) if len(end) else end
    text = np.searchsorted(ends, lo, "right")
    new = np.ones(len(lo), bool)
    new[1:] = (lo[1:] > end[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    return lo[at], end[np.concatenate([at[1:] - 1, [len(lo) - 1]])] if len(at) else end
