"""Exact search by minimizers: of every ``window`` neighbouring k-mers the one with the least hash is a seed.

A query of at least k + window - 1 letters has a seed of its own, and wherever it occurs the text has the same seed at the
same distance. So about 2 / (window + 1) of the positions are ever looked at, and each query is looked up at that one of its
seeds that the texts have least often. Hashes only find candidates: each is compared letter by letter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootline.operators.shared import shared_table

#: Seeds that are sent to every task: 16 bytes each.
MOST_BROADCAST = 2_000_000
#: Bytes of queries that are sent to every task, to be compared where their seeds were found.
MOST_BYTES = 16_000_000
PIECE = 1 << 17  # code points worked on together
PLACES = 1 << 20
PRIME = 0x100000001B3
SLICE = 1 << 22  # code points sent to the comparison together


def _mixed(h: np.ndarray) -> np.ndarray:
    """Spreads the polynomial's bits, so that the least hash isn't the least letter."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _seeds(codes: np.ndarray, ends: np.ndarray, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the seeds of texts that stand one after another; ``ends``: where each position's text ends."""
    n = len(codes) - k + 1
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h, have = codes.astype(np.uint64), 1
    for bit in bin(k)[3:]:  # the hash of k letters from those of half as many
        h, have = h[:-have] * np.uint64(pow(PRIME, have, 1 << 64)) + h[have:], 2 * have
        if bit == "1":
            h, have = h[:-1] * np.uint64(PRIME) + codes[have:], have + 1
    h = _mixed(h)
    # the place is in the low bits, always as many: of hashes with equal high bits the first counts, in texts as in queries
    low = np.uint64(PLACES - 1)
    best, span = (h & ~low) | np.arange(n, dtype=np.uint64), 1
    while span < window:  # the least of ``span`` from each position on, doubled
        step = min(span, window - span)
        best, span = np.minimum(best[:-step], best[step:]), span + step
    best = best[np.arange(len(best)) + k + window - 1 <= ends[: len(best)]]
    at = (best[np.diff(best, prepend=~best[:1]) != 0] & low).astype(np.int64)  # windows move on, and so do their seeds
    return at, h[at].view(np.int64)


def _pieces(texts: list[str | None], k: int, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, position, hash) of all seeds: short texts together, long ones in pieces that overlap by a window."""
    over = k + window - 2
    if 2 * PIECE + over >= PLACES:
        raise ValueError("windows of this size don't fit the places of a piece")
    held: list[tuple[int, int, np.ndarray]] = []  # row, where the piece begins, its code points
    last = [(-1, -1)]

    def work() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = np.array([len(c) for _, _, c in held])
        bounds = np.cumsum(sizes)
        at, h = _seeds(np.concatenate([c for _, _, c in held]), np.repeat(bounds, sizes), k, window)
        which = np.searchsorted(bounds, at, "right")
        row, begin = np.array([r for r, _, _ in held]), np.array([b for _, b, _ in held])
        row, at = row[which], at - (bounds - sizes)[which] + begin[which]
        # seeds come in order, so what two pieces share stands side by side
        fresh = (row != np.concatenate([[last[0][0]], row[:-1]])) | (at != np.concatenate([[last[0][1]], at[:-1]]))
        if len(row):
            last[0] = (row[-1], at[-1])
        return row[fresh], at[fresh], h[fresh]

    size = 0
    for row, text in enumerate(texts):
        if text is None or len(text) < k + window - 1:
            continue
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        for begin in range(0, len(codes) - over, PIECE):
            held.append((row, begin, codes[begin : begin + PIECE + over]))
            size += len(held[-1][2])
            if size >= PIECE:
                yield work()
                held, size = [], 0
    if held:
        yield work()


def _rows(k: int, window: int, names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(key, text) -> (key, pos, seed)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, at, h in _pieces(batch.column(1).to_pylist(), k, window):
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(at + 1), pa.array(h)], names)

    return work


def seed_rows(texts: DataFrame, key: str, seq: str, k: int, window: int) -> DataFrame:
    """(key, pos, seed) for every seed of every text; positions from 1, in code points."""
    kind = texts.schema[key].dataType.simpleString()
    return texts.select(key, seq).mapInArrow(_rows(k, window, [key, "pos", "seed"]), f"`{key}` {kind}, pos long, seed long")


def write_index(texts: DataFrame, key: str, seq: str, k: int, window: int, table: str, path: str, buckets: int = 64) -> DataFrame:
    """Stores (protein, pos, seed) as a table bucketed and sorted by seed: searches join it where it lies."""
    rows = seed_rows(texts.select(F.col(key).alias("protein"), F.col(seq).alias("seq")), "protein", "seq", k, window)
    rows.repartition(buckets, "seed").write.bucketBy(buckets, "seed").sortBy("seed").option("path", path).mode("overwrite").saveAsTable(table)
    return texts.sparkSession.table(table)


def _asked(batches: Iterator[pa.RecordBatch], seeds, k: int, window: int, around: bool) -> Iterator[pa.RecordBatch]:
    """(protein, seq) -> (seed, n) of the seeds asked for, or (protein, pos, seed, since, around) with the letters that the
    queries of that seed need."""
    known, before, after = seeds.value
    for batch in batches:
        texts = batch.column(1).to_pylist()
        for row, at, h in _pieces(texts, k, window):
            slot = np.minimum(np.searchsorted(known, h), len(known) - 1)
            hit = known[slot] == h
            row, at, h, slot = row[hit], at[hit], h[hit], slot[hit]
            if not around:
                values, counts = np.unique(h, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(counts.astype(np.int64))], ["seed", "n"])
                continue
            first, until = np.maximum(at - before[slot], 0), at + after[slot]
            parts = np.flatnonzero(np.diff(np.cumsum(until - first) // SLICE)) + 1  # a seed at every position is cut out in slices
            for own in np.split(np.arange(len(at)), parts):
                cut = [texts[r][f:t] for r, f, t in zip(row[own].tolist(), first[own].tolist(), until[own].tolist(), strict=True)]
                columns = [batch.column(0).take(pa.array(row[own])), pa.array(at[own] + 1), pa.array(h[own]), pa.array(first[own] + 1), pa.array(cut, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["protein", "pos", "seed", "since", "around"])


def occurrences(queries: DataFrame, texts: DataFrame, k: int, window: int, index: DataFrame | None = None, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """(query, protein, start) for every occurrence of queries (query: distinct, of at least k + window - 1 letters) in texts
    (protein, seq).

    Up to ``most_broadcast`` seeds go to the tasks, which read the texts twice, once to count the seeds and once to cut out
    what the queries of the rarest ones are compared with, so no text is shuffled; queries of more than ``MOST_BYTES`` meet
    these cuttings by a shuffle. More seeds, and a stored ``index``, are
    joined by seed, and the candidates meet the texts by protein. A query whose seed no text has ends there.
    """
    spark = queries.sparkSession
    own = shared_table(queries.select(F.monotonically_increasing_id().alias("number"), "query"), "queries")
    keyed = own.select(F.struct("number", F.length("query").alias("n")).alias("of"), "query")
    parts = shared_table(seed_rows(keyed, "of", "query", k, window).select("of.number", "of.n", F.col("pos").alias("offset"), "seed"), "query-seeds")
    before, after = F.max(F.col("offset") - 1).alias("before"), F.max(F.col("n") - F.col("offset") + 1).alias("after")
    few = index is None and parts.select("seed").distinct().count() <= most_broadcast

    def sent(df: DataFrame):
        got = df.select("seed", F.col("before").cast("long"), F.col("after").cast("long")).orderBy("seed").toArrow()
        return spark.sparkContext.broadcast([c.to_numpy() for c in got.columns])

    def scan(seeds, around: bool, schema: str) -> DataFrame:
        return texts.mapInArrow(lambda batches: _asked(batches, seeds, k, window, around), schema)

    if few:
        counts = scan(sent(parts.groupBy("seed").agg(before, after)), False, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("count"))
    else:
        index = seed_rows(texts, "protein", "seq", k, window) if index is None else index
        counts = index.join(parts.select("seed").distinct(), "seed").groupBy("seed").agg(F.count(F.lit(1)).alias("count"))
    # a seed that no text has ends the search for its query
    least = parts.join(counts, "seed").groupBy("number", "n").agg(F.min(F.struct(F.col("count"), "offset", "seed")).alias("a"), F.count(F.lit(1)).alias("met"))
    of_all = parts.groupBy("number").agg(F.count(F.lit(1)).alias("all"))
    least = least.join(of_all, "number").where("met = all")
    anchors = shared_table(least.select("number", "n", "a.offset", "a.seed"), "anchors")
    start = (F.col("pos") - F.col("offset") + 1).alias("start")
    if few:
        kind = texts.schema["protein"].dataType.simpleString()
        need = anchors.groupBy("seed").agg(before, after)
        if need.isEmpty():
            return spark.createDataFrame([], f"query string, protein {kind}, start long")
        near = scan(sent(need), True, f"protein {kind}, pos long, seed long, since long, around string")
        compared = anchors.join(own, "number")
        size = compared.agg(F.sum(F.octet_length("query") + 64)).first()[0] or 0
        # Spark takes what the scan finds for no larger than the texts' compressed file, and would broadcast it
        near, compared = (near, F.broadcast(compared)) if size <= MOST_BYTES else (near.hint("merge"), compared)
        hits = near.join(compared, "seed").select("query", "protein", start, "since", "around").where("start >= since")
        return hits.where(F.expr("substring(around, start - since + 1, length(query))") == F.col("query")).select("query", "protein", "start")
    hits = shared_table(index.join(anchors, "seed").where("pos >= offset").select("number", "protein", start), "candidates")
    return hits.join(texts, "protein").join(own, "number").where(F.expr("substring(seq, start, length(query))") == F.col("query")).select("query", "protein", "start")
