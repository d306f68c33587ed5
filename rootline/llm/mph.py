"""A minimal perfect hash over 64-bit keys: cascaded collision-free bitmaps with popcount ranks, all in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_GAMMA, _LEVELS = 1.7, 48


def _mix(h: np.ndarray, level: int) -> np.ndarray:
    """A 64-bit finaliser with a seed for each level."""
    x = h + np.uint64(((level + 1) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Index:
    sizes: np.ndarray  # bits of each level
    words: np.ndarray  # the bitmaps of all levels, uint64
    ranks: np.ndarray  # set bits before each word, uint32
    tail: np.ndarray  # sorted keys that no level could place

    @classmethod
    def build(cls, keys: np.ndarray) -> Index:
        """keys: distinct uint64."""
        left, sizes, maps = keys, [], []
        while left.size and len(sizes) < _LEVELS:
            m = max(64, -(-int(left.size * _GAMMA) // 64) * 64)
            at = (_mix(left, len(sizes)) % np.uint64(m)).astype(np.int64)
            alone = np.bincount(at, minlength=m)[at] == 1
            bits = np.zeros(m, np.uint8)
            bits[at[alone]] = 1
            sizes.append(m)
            maps.append(np.packbits(bits, bitorder="little").view("<u8"))
            left = left[~alone]
        words = np.concatenate(maps) if maps else np.zeros(0, "<u8")
        ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)]).astype(np.uint32)
        return cls(np.array(sizes, np.int64), words, ranks, np.sort(left))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 for those that no level holds. A key that wasn't built in may get any slot."""
        out = np.full(keys.size, -1, np.int64)
        open_, base = np.arange(keys.size), 0
        for level, m in enumerate(self.sizes.tolist()):
            if not open_.size:
                break
            bit = base + (_mix(keys[open_], level) % np.uint64(m)).astype(np.int64)
            word, low = self.words[bit >> 6], (bit & 63).astype(np.uint64)
            hit = (word >> low) & np.uint64(1) == 1
            below = np.bitwise_count(word[hit] & ((np.uint64(1) << low[hit]) - np.uint64(1)))
            out[open_[hit]] = self.ranks[bit[hit] >> 6].astype(np.int64) + below
            open_, base = open_[~hit], base + m
        if open_.size and self.tail.size:
            at = np.minimum(np.searchsorted(self.tail, keys[open_]), self.tail.size - 1)
            hit = self.tail[at] == keys[open_]
            out[open_[hit]] = int(self.ranks[-1]) + at[hit]
        return out
