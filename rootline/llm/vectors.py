"""Embedding near-dedup by sign-projection passes.

Each pass puts distinct vectors with equal signs of ``depth`` random projections into one bucket, and all pairs of a
bucket are compared; those whose cosine in double precision reaches the threshold are united across the passes. The
depth follows from the number of vectors, so that evenly spread ones leave about ``window`` in a bucket; the number of
passes follows from the depth alone, so that a pair at the threshold is missed in all passes with probability ``miss``
at most, however the other vectors lie and whatever the number of partitions. Buckets of more than ``cell`` vectors are
cut into parts, and every two parts meet in a cell of bounded size. A cell emits a spanning forest of the links it
verified, not the links.

Every link of a vector lies in its component, so links are counted by comparing the members of each component, in cells
of two bounded parts of it; a cell returns a count for each vector. Copies of a vector are one node with a weight.

Defined cases: a vector that is null, empty or zero, or holds null or non-finite components, links with nothing and is
kept; vectors of different lengths don't link; repeated rows are copies; rows with a null vec_id count as links of
others and get their group's component (null if the group has no id), kept is then false; an empty table gives an
empty table; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rootline.llm.common import stored
from rootline.llm.components import components


def depth_for(n: int, window: int) -> int:
    return max(0, math.ceil(math.log2(max(n, 1) / window)))


def passes_for(n: int, cosine: float, window: int, miss: float) -> int:
    found = (1 - math.acos(cosine) / math.pi) ** depth_for(n, window)
    return max(1, math.ceil(math.log(miss) / math.log1p(-found))) if found < 1 else 1


def _unit(column: pa.Array) -> np.ndarray:
    """Unit rows in double precision, from vectors of one length."""
    flat = column.values if isinstance(column, pa.ListArray) else pa.chunked_array(column).combine_chunks().values
    offsets = column.offsets.to_numpy()
    m = flat.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]].astype(np.float64).reshape(len(column), -1)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _lengths(batch: pa.RecordBatch, name: str) -> Iterator[tuple[np.ndarray, pa.RecordBatch]]:
    """The rows of a batch by the length of their vectors."""
    n = np.diff(batch.column(name).offsets.to_numpy())
    for d in np.unique(n).tolist():
        yield d, batch.filter(pa.array(n == d)) if (n != d).any() else batch


def _coder(passes: int, depth: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, rows in _lengths(batch, "v"):
                if d not in planes:
                    planes[d] = np.random.default_rng([seed, d]).standard_normal((d, passes * depth))
                signs = (_unit(rows.column("v")) @ planes[d] > 0).reshape(rows.num_rows, passes, depth)
                codes = signs @ (1 << np.arange(depth, dtype=np.int64))
                for p in range(passes):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(rows.num_rows, d * 1024 + p)), pa.array(codes[:, p]), rows.column("node"), rows.column("v")], ["p", "code", "node", "v"])

    return run


def _forest(near: np.ndarray, node: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Edges of a spanning forest of the links in a symmetric matrix."""
    rest = np.flatnonzero(near.any(axis=1))
    while rest.size > 1:
        front, rest = rest[:1], rest[1:]
        while front.size and rest.size:
            link = near[np.ix_(front, rest)]
            got = link.any(axis=0)
            yield node[front[link[:, got].argmax(axis=0)]] if got.any() else node[:0], node[rest[got]]
            front, rest = rest[got], rest[~got]


def _linker(cosine: float):
    """Reads rows (p, code, i, j, side, node, v) in the order of cells (p, code, i, j); gives verified links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def links() -> Iterator[pa.RecordBatch]:
            if sum(len(h[0]) for h in held) > 1:
                v, node, side = (np.concatenate([h[k] for h in held]) for k in range(3))
                near = v @ v.T >= cosine
                if now[2] == now[3]:
                    np.fill_diagonal(near, False)
                else:
                    near &= side[:, None] != side[None, :]
                for a, b in _forest(near, node):
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            cells = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in range(4)])
            cut = [0, *(np.flatnonzero((cells[:, 1:] != cells[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                own, part = tuple(cells[:, a].tolist()), batch.slice(a, b - a)
                if own != now:
                    yield from links()
                    now, held = own, []
                held.append((_unit(part.column(6)), part.column(5).to_numpy().copy(), part.column(4).to_numpy().copy()))
        yield from links()

    return run


def _counter(cosine: float):
    def run(key: tuple, t: pa.Table) -> pa.Table:
        t = t.combine_chunks().sort_by([("comp", "ascending"), ("i", "ascending"), ("j", "ascending")])
        where = np.stack([t[c].to_numpy() for c in ("comp", "i", "j")])
        cut = [0, *(np.flatnonzero((where[:, 1:] != where[:, :-1]).any(axis=0)) + 1).tolist(), t.num_rows]
        side, weight, out = t["side"].to_numpy(), t["weight"].to_numpy(), np.zeros(t.num_rows, np.int64)
        vectors = t["v"].combine_chunks() if isinstance(t["v"], pa.ChunkedArray) else t["v"]
        vectors = vectors.chunk(0) if isinstance(vectors, pa.ChunkedArray) else vectors
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            v, w, s = _unit(vectors.slice(a, b - a)), weight[a:b], side[a:b]
            same = where[1, a] == where[2, a]
            x, y = (np.arange(b - a),) * 2 if same else (np.flatnonzero(s == 0), np.flatnonzero(s == 1))
            for i in range(0, x.size, 512):
                near = v[x[i : i + 512]] @ v[y].T >= cosine
                if same:
                    near[np.arange(near.shape[0]), np.arange(i, i + near.shape[0])] = False
                out[a + x[i : i + 512]] += near @ w[y]
                if not same:
                    out[a + y] += w[x[i : i + 512]] @ near
        return pa.table({"node": t["node"], "links": pa.array(out)})

    return run


def _cells() -> Column:
    """The cells of a row of part ``c`` of ``parts``: its part meets every other and itself."""
    return F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda k: F.struct(F.least(k, "c").alias("i"), F.greatest(k, "c").alias("j"), F.when(k >= F.col("c"), 0).otherwise(1).alias("side")))


def near_vectors(vectors: DataFrame, cosine: float = 0.95, window: int = 512, miss: float = 1e-5, cell: int = 1024, seed: int = 7) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of vectors (vec_id, embedding)."""
    spark = vectors.sparkSession
    kind = dict(vectors.dtypes)["embedding"]
    kind = kind if kind in ("array<float>", "array<double>") else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.withColumn("v", F.when(F.coalesce(fine, F.lit(False)), F.col("v")))
    # vectors of one direction but other lengths stay nodes of their own; their cosine is computed like any other
    nodes = rows.where("v is not null").groupBy("v").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("weight"))
    nodes = stored(nodes.select("v", "weight", F.coalesce("least", F.lit(2**62) + F.pmod(F.xxhash64("v"), F.lit(2**61))).alias("node")), "vector-nodes").df

    n = nodes.count()
    depth, passes = depth_for(n, window), passes_for(n, cosine, window, miss)
    coded = nodes.select("v", "node").mapInArrow(_coder(passes, depth, seed), f"p long, code long, node long, v {kind}")
    crowd = coded.groupBy("p", "code").agg(F.ceil(F.count(F.lit(1)) / cell).cast("int").alias("parts"), F.count(F.lit(1)).alias("many")).where("many > 1").drop("many")
    crowd = stored(crowd, "vector-buckets").df
    dealt = coded.join(crowd, ["p", "code"]).withColumn("c", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    dealt = dealt.select("p", "code", "node", "v", F.explode(_cells()).alias("x")).select("p", "code", "x.i", "x.j", "x.side", "node", "v")
    at = ["p", "code", "i", "j"]
    ordered = dealt.repartition(*at).sortWithinPartitions(*at)
    comps = stored(components(ordered.mapInArrow(_linker(cosine), "a long, b long"), "vector-components"), "vector-groups").df

    sizes = comps.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / cell).cast("int").alias("parts"))
    members = comps.join(sizes, "component").join(nodes, "node").select("node", "weight", "v", "component", "parts", F.pmod(F.xxhash64("node"), "parts").cast("int").alias("c"))
    members = members.select("node", "weight", "v", F.col("component").alias("comp"), "parts", F.explode(_cells()).alias("x")).select("node", "weight", "v", "comp", "parts", "x.*")
    many = max(1, -(-n // cell))
    at = F.when(F.col("parts") > 1, F.xxhash64("comp", "i", "j")).otherwise(F.pmod(F.xxhash64("comp"), F.lit(many)))
    counted = members.withColumn("at", at).groupBy("at").applyInArrow(_counter(cosine), "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))

    known = nodes.join(comps, "node", "left").join(counted, "node", "left").select("v", "weight", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "node").alias("component"))
    out = rows.join(known, "v", "left")
    component = F.when(F.col("v").isNull(), F.col("vec_id")).when(F.col("component") < 2**62, F.col("component"))
    out = out.select("vec_id", F.coalesce(F.col("weight") - 1 + F.col("links"), F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
