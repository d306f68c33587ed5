"""Best-fit packing with Martello-Toth dominance reduction.

Texts become token ids and one end token; longer ones are cut into pieces of the capacity, the first of which may be
shorter. Packing looks only at how many pieces have each length: at most ``capacity`` numbers, whatever the corpus.
On these the reduction fixes, for a length w, a bin that dominates every other bin with w in it, and removes it from
the instance; what remains is packed by best fit in decreasing order, over classes of bins with equal room. The plan
is a list of runs: the pieces of one length with numbers from a to b go to sequences from s on, at one offset. Pieces
are numbered within their length in two steps (no task sees a whole length) and look their run up.

Dominance, for a piece w with room r = capacity - w and the pieces that are left besides it: a bin {w, F} dominates
when every other set that fits with w can be split over the members of F so that each part is no larger than its
member; those parts can then change places with the members. So w goes
 - alone, when nothing else fits;
 - with the largest piece k <= r, when k = r, or when no two pieces fit;
 - when no three pieces fit: with k and the largest b that fits beside them, if b is at least the smaller one of any
   pair that fits; or with k alone, if nothing fits beside k and no pair's sum is over k.

Defined cases: a null text is the empty text, a piece of the end token alone; repeated rows are packed as rows of
their own; a null doc_id is kept; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootline.llm import vocab
from rootline.llm.common import gapless, stored
from rootline.llm.words import tidied

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n tokens."""
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, path: str, pattern: str, capacity: int = 2048, end: int = 0, with_ids: bool = False) -> DataFrame:
    """A row for each piece; with_ids adds its token ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            ids_of: list[np.ndarray] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array([*vocab.encode(text.as_py() or "", path, pattern), end], "<u4")
                for k, (a, n) in enumerate(cuts(ids.size, capacity)):
                    part = ids[a : a + n]
                    for col, x in zip(rows, (doc, k, a, n, zlib.crc32(part.tobytes())), strict=True):
                        col.append(x)
                    if with_ids:
                        ids_of.append(part.astype(np.int32))
            cols = [pa.array(c, pa.int32() if i == 1 else pa.int64()) for i, c in enumerate(rows)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                cols, names = [*cols, pa.array(ids_of, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(cols, names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidied(run), PIECES + ", ids array<int>" * with_ids)


class Plan:
    """Runs (length, first, count, sequence, offset, per): piece number i of a length, first <= i < first + count,
    goes to sequence + (i - first) // per at offset + length * ((i - first) % per)."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.left = capacity, [0] * (capacity + 1)
        for size, n in counts.items():
            self.left[size] += n
        self.used = [0] * (capacity + 1)
        self.runs: list[tuple[int, int, int, int, int, int]] = []
        self.sequences = self.fixed = 0
        self._reduce()
        self.fixed = self.sequences
        self._best_fit()

    def _emit(self, pattern: list[tuple[int, int]], times: int) -> None:
        at = 0
        for size, per in pattern:
            self.runs.append((size, self.used[size], per * times, self.sequences, at, per))
            self.used[size] += per * times
            at += size * per
        self.sequences += times

    def _partner(self, w: int) -> list[int] | None:
        """The other members of a bin that dominates all bins with w in it, or None if no rule finds one."""
        left, r = self.left, self.capacity - w
        left[w] -= 1
        try:
            small: list[int] = []
            for s in range(1, r + 1):
                if left[s]:
                    small += [s] * min(left[s], 3 - len(small))
                    if len(small) == 3:
                        break
            if not small:
                return []
            k = next(s for s in range(r, 0, -1) if left[s])
            if k == r or len(small) < 2 or small[0] + small[1] > r:
                return [k]
            if len(small) == 3 and sum(small) <= r:
                return None
            left[k] -= 1
            b = next((s for s in range(r - k, 0, -1) if left[s]), 0)
            left[k] += 1
            low = best = 0
            for y in range(r // 2, 0, -1):
                if left[y]:
                    x = next((x for x in range(r - y, y - 1, -1) if left[x] - (x == y) > 0), 0)
                    if x:
                        low, best = low or y, max(best, x + y)
            if b:
                return [k, b] if b >= low else None
            return [k] if k >= best else None
        finally:
            left[w] += 1

    def _reduce(self) -> None:
        found = True
        while found:
            found = False
            for w in range(self.capacity, 0, -1):
                while self.left[w]:
                    more = self._partner(w)
                    if more is None:
                        break
                    sizes = sorted([w, *more], reverse=True)
                    pattern = [(s, sizes.count(s)) for s in dict.fromkeys(sizes)]
                    times = min(self.left[s] // n for s, n in pattern)
                    self._emit(pattern, times)
                    for s, n in pattern:
                        self.left[s] -= n * times
                    found = True

    def _best_fit(self) -> None:
        """Classes of bins with the same room hold (how many bins, what is in each)."""
        room: list[list[tuple[int, list[tuple[int, int]]]]] = [[] for _ in range(self.capacity + 1)]
        for size in range(self.capacity, 0, -1):
            n = self.left[size]
            while n:
                r = next((r for r in range(size, self.capacity + 1) if room[r]), 0)
                bins, inside = room[r].pop() if r else (n, [])
                r = r or self.capacity
                per = min(r // size, n)
                take = min(bins, n // per)
                if inside and take < bins:
                    room[r].append((bins - take, inside))
                room[r - size * per].append((take, [*inside, (size, per)]))
                n -= take * per
            self.left[size] = 0
        for own in room:
            for bins, inside in own:
                self._emit(inside, bins)


def pack(items: DataFrame, capacity: int = 2048, bucket_rows: int = 100_000, broadcast_runs: int = 1_000_000) -> DataFrame:
    """items with doc_id, piece, length, ids_crc32 -> the same with sequence_id and offset; items should be stored.

    The plan has a row for each length; its runs come from lengths meeting classes of bins, so the capacity bounds them,
    not the corpus. It is broadcast only up to ``broadcast_runs`` runs. Pieces are numbered in as many buckets as leave
    the most frequent length about ``bucket_rows`` pieces in each.
    """
    lengths = items.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    plan = Plan({r.length: r.n for r in lengths}, capacity)
    buckets = max(32, -(-max((r.n for r in lengths), default=0) // bucket_rows))
    by: dict[int, list] = {}
    for run in plan.runs:
        by.setdefault(run[0], []).append(run[1:])
    runs = items.sparkSession.createDataFrame(sorted(by.items()), "length long, runs array<struct<first:long,n:long,seq:long,off:long,per:long>>")
    placed = gapless(items, "length", ["doc_id", "piece", "ids_crc32"], ["doc_id", "piece"], buckets, "_nth").join(F.broadcast(runs) if len(plan.runs) <= broadcast_runs else runs, "length")
    placed = placed.withColumn("_r", F.element_at(F.filter("runs", lambda r: r["first"] <= F.col("_nth")), -1))
    step = F.col("_nth") - F.col("_r.first")
    placed = placed.withColumns({"sequence_id": F.col("_r.seq") + F.floor(step / F.col("_r.per")).cast("long"), "offset": F.col("_r.off") + F.col("length") * (step % F.col("_r.per"))})
    return placed.drop("runs", "_r", "_nth")


def pack_documents(docs: DataFrame, path: str, pattern: str, capacity: int = 2048, end: int = 0, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset) for each piece of each document."""
    items = stored(pieces(docs, path, pattern, capacity, end, with_ids), "pieces").df
    return pack(items, capacity).select(*items.columns, "sequence_id", "offset")
