"""Near-dedup by SimHash fingerprints, as op 5 links them, and by similarity of word shingles.

Fingerprints of three-word shingles that differ in ``radius`` bits or less link, found by the covering masks of
``simhash``. Copies with passages added or cut are often further apart; so links by similarity come on top: bands of
min-wise hashes find candidates, the whole sketch verifies them.

A document's sketch is a byte of each of 512 min-wise hashes of its five-word shingles, whose share of agreement
estimates the similarity (standard error 0.018 at 0.8). Half a standard error is granted, so that of pairs just above
the limit most are found. Candidates share one of 51 bands of five bytes: of two sketches that agree to 0.78 they miss
all with a probability under 1e-7, whatever was edited, added or cut. Documents with equal sketches and fingerprints
are one node.

Buckets give a spanning forest of their verified links, never all pairs: each row is compared with the bucket's least
node first; then, only where a bucket still holds several groups, the rows outside its largest group are compared with
all rows of other groups. What is larger than ``bucket`` is cut into parts, and every two parts that hold something to
compare meet in a cell of bounded size, so nothing is left out, and a bucket that one group fills costs in proportion.

What is shuffled: the sketches once to find equal ones and once more where a bucket holds them; 24 bytes a band; and
28 bytes a mask and fingerprint.
The joins that carry sketches are the same at every size, so small runs tell what large ones take.

Defined cases: null and texts without words are alike, and one group; texts shorter than a shingle are one shingle;
repeated rows and ids keep their rows, and rows that repeat an id with another text are apart; a null doc_id has its
group's component, null if no row of the group has an id; an empty table gives an empty table; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootline.llm import simhash
from rootline.llm.common import stored, text_marks
from rootline.llm.components import components
from rootline.llm.words import tidied

_ROWS = 512
_BANDS, _WIDTH = 51, 5
_SLACK = 0.5  # of a standard error
_ODD = np.random.default_rng(11).integers(0, 2**63, _ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _hashes(items: set[bytes]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(x) for x in items), np.uint64, len(items))


def _least(h: np.ndarray) -> bytes:
    """A byte of each of the min-wise hashes."""
    low = np.full(_ROWS, 2**64 - 1, np.uint64)
    for i in range(0, h.size, 1024):
        low = np.minimum(low, (h[i : i + 1024, None] * _ODD).min(axis=0))
    return ((low >> np.uint64(24)) & np.uint64(255)).astype(np.uint8).tobytes()


def sketch(text: bytes | None, words: int = 5) -> bytes:
    """The min-wise bytes of the shingles."""
    own = (text or b"").lower().split()
    if not own:
        return bytes(_ROWS)
    joined = b" ".join(own)
    ends = np.cumsum(np.fromiter(map(len, own), np.int64, len(own)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(own) - words + 1)
    return _least(_hashes({joined[a:b] for a, b in zip(starts[:n].tolist(), ends[min(words, len(own)) - 1 :].tolist(), strict=True)}))


def sketches(docs: DataFrame, words: int = 5) -> DataFrame:
    """(doc_id, t1, t2: marks of the text, low: the sketch, h1, h2: the sketch's name, fp: op 5's fingerprint)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(3).cast(pa.binary()).to_pylist()
            rows = [sketch(t, words) for t in texts]
            fps = np.fromiter((simhash.fingerprint(t, 3) for t in texts), np.uint64, len(texts)).view(np.int64)
            names = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, rows)), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(rows, pa.binary()), pa.array(names[:, 0]), pa.array(names[:, 1]), pa.array(fps)], ["doc_id", "t1", "t2", "low", "h1", "h2", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *text_marks(), "text").mapInArrow(tidied(run), "doc_id long, t1 long, t2 long, low binary, h1 long, h2 long, fp long")


def _keys(low: np.ndarray) -> np.ndarray:
    """The bands of each sketch as numbers: five bytes and the band's place."""
    keys = np.zeros((len(low), _BANDS, 8), np.uint8)
    keys[:, :, :_WIDTH] = low[:, : _BANDS * _WIDTH].reshape(-1, _BANDS, _WIDTH)
    return keys.view("<i8")[:, :, 0] | (np.arange(_BANDS, dtype=np.int64) << (8 * _WIDTH))


def _band_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, low) -> (key, n, least): each band of the batch once, so that one very common band costs a row a batch."""
    for batch in batches:
        key, at, n = np.unique(_keys(_low(batch.column(1))).reshape(-1), return_inverse=True, return_counts=True)
        least = np.full(key.size, 2**63 - 1)
        np.minimum.at(least, at.reshape(-1), np.repeat(batch.column(0).to_numpy(), _BANDS))
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n), pa.array(least)], ["key", "n", "least"])


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, low) -> (key, node)."""
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(_keys(_low(batch.column(1))).reshape(-1)), pa.array(np.repeat(batch.column(0).to_numpy(), _BANDS))], ["key", "node"])


def _differing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The number of min-wise bytes in which each row of x differs from each of y."""
    if len(x) * len(y) <= 1024:
        return (x[:, None, :] != y[None, :, :]).sum(axis=2)
    xs, ys, out = np.ascontiguousarray(x.T), np.ascontiguousarray(y.T), np.zeros((len(x), len(y)), np.int16)
    for k in range(0, _ROWS, 128):
        part = np.zeros(out.shape, np.uint8)
        for c in range(k, min(k + 128, _ROWS)):
            part += (xs[c][:, None] != ys[c][None, :]).view(np.uint8)
        out += part
    return out


def _edges(low: np.ndarray, node: np.ndarray, group: np.ndarray, side: np.ndarray, most: int) -> list[tuple[int, int]]:
    """A spanning forest of the rows' groups over all links of at most ``most`` differing bytes between rows of different
    sides; where every side is alike, between all rows. Rows of one group are known to be connected."""
    out, rest = [], np.arange(len(node))
    one = bool((side == side[0]).all())
    while rest.size > 1:
        first = group[rest] == group[rest[0]]
        front, rest = rest[first], rest[~first]
        while front.size and rest.size:
            reached: dict[int, tuple[int, int]] = {}
            for s in (0,) if one else (0, 1):
                own, to = (front, rest) if one else (front[side[front] == s], rest[side[rest] != s])
                for i in range(0, own.size, 64):
                    if not to.size:
                        break
                    hit = _differing(low[own[i : i + 64]], low[to]) <= most
                    at = np.flatnonzero(hit.any(axis=0))
                    for k, by in zip(at.tolist(), hit[:, at].argmax(axis=0).tolist(), strict=True):
                        reached.setdefault(int(group[to[k]]), (int(node[own[i + by]]), int(node[to[k]])))
                    if at.size:
                        to = to[~np.isin(group[to], list(reached))]
            out += reached.values()
            got = np.isin(group[rest], list(reached))
            front, rest = rest[got], rest[~got]
    return out


def _searcher(most: int):
    """Reads rows (key, i, j, side, node, grp, low) in the order of cells (key, i, j); gives verified links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def links() -> list[tuple[int, int]]:
            return _edges(*(np.concatenate([h[k] for h in held]) for k in range(4)), most) if held else []

        def batch_of(out: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], pa.int64()) for c in (0, 1)], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            out: list = []
            cells = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in range(3)])
            rows = (_low(batch.column(6)), batch.column(4).to_numpy(), batch.column(5).to_numpy(), batch.column(3).to_numpy())
            cut = [0, *(np.flatnonzero((cells[:, 1:] != cells[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for i, j in zip(cut[:-1], cut[1:], strict=True):
                own = tuple(cells[:, i].tolist())
                if own != now:
                    out += links()
                    now, held = own, []
                held.append([x[i:j].copy() for x in rows])
            yield batch_of(out)
        yield batch_of(links())

    return run


def _low(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, _ROWS)


def _fingerprint_links(nodes: DataFrame, radius: int) -> DataFrame:
    """Links that connect all nodes whose fingerprints differ in ``radius`` bits or less."""
    first = stored(nodes.groupBy("fp").agg(F.min("node").alias("node"), F.count(F.lit(1)).alias("n")), "near-fingerprints").df
    shared = first.where("n > 1").select("fp", F.col("node").alias("b")).hint("merge")
    equal = nodes.select("fp", F.col("node").alias("a")).join(shared, "fp").where("a <> b").select("a", "b")
    return equal.union(simhash.links(first.select("fp", "node"), radius))


def _first_links(members: DataFrame, active: DataFrame, most: int) -> DataFrame:
    """Verified links of each bucket's rows to its least node."""
    pairs = members.where("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b")).distinct()
    both = pairs.join(active.select(F.col("node").alias("a"), F.col("low").alias("la")).hint("merge"), "a")
    both = both.join(active.select(F.col("node").alias("b"), F.col("low").alias("lb")).hint("merge"), "b")
    return both.select("a", "b", "la", "lb").mapInArrow(_agreeing(most), "a long, b long")


def _more_links(members: DataFrame, active: DataFrame, groups: DataFrame, most: int, bucket: int) -> DataFrame:
    """Verified links between the groups that meet in a bucket. Buckets of one group have nothing to add, those of two
    nodes are settled by the first links, and of buckets with the same members one is read."""
    rows = members.where("n > 2").join(groups, "node", "left").select("key", "node", F.coalesce("component", "node").alias("grp"))
    rows = stored(rows, "near-members").df
    per = rows.groupBy("key", "grp").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
    marks = per.groupBy("key").agg(F.sum("n").alias("n"), F.max(F.struct("n", "grp")).alias("top"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    half = F.lit(max(1, bucket // 2))
    whole, rest = F.col("n"), F.col("n") - F.col("top.n")
    mixed = marks.where(rest > 0).groupBy("n", "x", "y").agg(F.min(F.struct("key", "top")).alias("b")).select("n", "b.key", "b.top")
    # part 0 to p - 1 hold the largest group, p to p + q - 1 the rest; a small bucket is one part of its own
    mixed = mixed.select("key", F.col("top.grp").alias("main"), F.when(whole <= bucket, 0).otherwise(F.ceil(F.col("top.n") / half)).cast("int").alias("p"), F.when(whole <= bucket, 1).otherwise(F.ceil(rest / half)).cast("int").alias("q"))
    mixed = stored(mixed, "near-mixed").df
    part = F.when((F.col("grp") == F.col("main")) & (F.col("p") > 0), F.pmod(F.xxhash64("node"), F.col("p"))).otherwise(F.col("p") + F.pmod(F.xxhash64("node"), F.col("q"))).cast("int")
    rows = rows.join(mixed, "key").withColumn("c", part)
    partners = F.sequence(F.when(F.col("c") < F.col("p"), F.col("p")).otherwise(0), F.col("p") + F.col("q") - 1)
    cells = F.transform(partners, lambda k: F.struct(F.least(k, "c").alias("i"), F.greatest(k, "c").alias("j"), F.when(k >= F.col("c"), 0).otherwise(1).alias("side")))
    rows = rows.select("key", "node", "grp", F.explode(cells).alias("x")).join(active.select("node", "low").hint("merge"), "node").select("key", "x.i", "x.j", "x.side", "node", "grp", "low")
    cell = ["key", "i", "j"]
    return rows.repartition(*cell).sortWithinPartitions(*cell).mapInArrow(tidied(_searcher(most)), "a long, b long")


def _agreeing(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = (_low(batch.column(2)) != _low(batch.column(3))).sum(axis=1) <= most
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(near))

    return run


def most_differing(similarity: float) -> int:
    """How many bytes of two sketches may differ; bytes also agree by chance, in one of 256."""
    if not 0.6 <= similarity <= 1:
        raise ValueError("similar_documents: similarity must be from 0.6 to 1")
    error = (similarity * (1 - similarity) / _ROWS) ** 0.5
    return int(_ROWS * 255 / 256 * (1 - similarity + _SLACK * error) + 1e-9)


def text_groups(docs: DataFrame, words: int = 5, similarity: float = 0.8, bucket: int = 4096, radius: int = 3) -> DataFrame:
    """(doc_id, t1, t2, grp, component_id) for each document: marks of its text, a number for its group, and the smallest
    doc_id in the group."""
    most = most_differing(similarity)
    rows = stored(sketches(docs, words), "near-sketches").df
    # numbered once, when the table is written, so that rows that repeat an id with another text stay apart
    nodes = rows.groupBy("h1", "h2", "fp", "low").agg(F.min("doc_id").alias("least")).withColumn("node", F.monotonically_increasing_id())
    nodes = stored(nodes, "near-nodes").df
    counts = nodes.select("node", "low").mapInArrow(tidied(_band_counts), "key long, n long, least long")
    buckets = counts.repartition("key").groupBy("key").agg(F.sum("n").alias("n"), F.min("least").alias("least")).where("n > 1")
    buckets = stored(buckets, "near-buckets")
    members = stored(nodes.select("node", "low").mapInArrow(tidied(_bands), "key long, node long").join(buckets.df, "key"), "near-bands")
    active = stored(nodes.select("node", "low").join(members.df.select("node").distinct().hint("merge"), "node", "left_semi"), "near-active")
    groups = stored(components(_fingerprint_links(nodes, radius).union(_first_links(members.df, active.df, most)), "near-components"), "near-groups")
    linked = groups.df.select(F.col("node").alias("a"), F.col("component").alias("b")).union(_more_links(members.df, active.df, groups.df, most, bucket))
    joined = stored(components(linked, "near-components"), "near-groups").df
    for table in (buckets, members, active, groups):
        table.drop()
    named = nodes.select("h1", "h2", "fp", "least", "node").join(joined, "node", "left").withColumn("grp", F.coalesce("component", "node"))
    named = stored(named.select("h1", "h2", "fp", "least", "grp"), "near-named").df
    least = stored(named.groupBy("grp").agg(F.min("least").alias("component_id")), "near-least").df
    group = stored(named.join(least, "grp").select("h1", "h2", "fp", "grp", "component_id"), "near-group").df
    return rows.select("doc_id", "t1", "t2", "h1", "h2", "fp").join(group, ["h1", "h2", "fp"]).select("doc_id", "t1", "t2", "grp", "component_id")


def similar_documents(docs: DataFrame, words: int = 5, similarity: float = 0.8, bucket: int = 4096) -> DataFrame:
    """(doc_id, component_id) for each document; component_id is the smallest doc_id that links of fingerprints or of
    ``similarity`` reach."""
    return text_groups(docs, words, similarity, bucket).select("doc_id", "component_id")


def one_of_each(docs: DataFrame, words: int = 5, similarity: float = 0.8, bucket: int = 4096, broadcast_rows: int = 1_000_000) -> DataFrame:
    """The documents, one of each group: that with the smallest id (nulls last), then the least text mark; rows that
    repeat id and text count once. The rows that go are broadcast only if they are at most ``broadcast_rows``, of 24 bytes
    each; else they are joined by a shuffle."""
    rows = stored(text_groups(docs, words, similarity, bucket), "near-rows").df
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t1", "t2")
    best = stored(rows.groupBy("grp").agg(F.min(own).alias("best")), "near-best").df
    each = rows.groupBy("grp", "doc_id", "t1", "t2").agg(F.count(F.lit(1)).alias("n")).join(best, "grp")
    each = stored(each.select("doc_id", "t1", "t2", "n", own.eqNullSafe(F.col("best")).alias("stays")), "near-each").df
    gone = each.where("not stays").select(F.col("doc_id").alias("_near_g"), F.col("t1").alias("_near_g1"), F.col("t2").alias("_near_g2"))
    out = docs.withColumns(dict(zip(("_near_t1", "_near_t2"), text_marks(), strict=True)))
    if not each.where("stays and n > 1").isEmpty():
        out = out.dropDuplicates(["doc_id", "_near_t1", "_near_t2"])
    gone = F.broadcast(gone) if gone.count() <= broadcast_rows else gone.hint("merge")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_near_g")) & (F.col("_near_t1") == F.col("_near_g1")) & (F.col("_near_t2") == F.col("_near_g2"))
    return out.join(gone, same, "left_anti").drop("_near_t1", "_near_t2")
