"""Sharding by a hierarchical weighted hash tree: region, rack and shard are drawn in turn, each by weighted hashes.

Every node of a level draws -ln(u) / weight with u hashed from the key and the node's name; the least draw wins, so
a node takes keys in proportion to its weight, and a node whose weight grows only takes keys, from its siblings. What
moves when weights change is confined to the subtrees whose weights change. A shard beyond the base stands in a region
of its own, so that one more shard takes rows only into itself.

Defined cases: a null key is hashed as a key of its own; a null text has size 1 and the checksum of the empty text;
repeated rows are rows of their own; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rootline.llm.common import gapless, text_or_empty


@dataclass(frozen=True)
class Node:
    name: str
    weight: float
    below: tuple[Node, ...] = ()
    shard: int = -1


def _node(name: str, below: list[Node]) -> Node:
    return Node(name, sum(x.weight for x in below), tuple(below))


def topology(shards: int, base: int = 16, per_rack: int = 4, racks: int = 2) -> Node:
    """A tree of the shards 0 to shards - 1, each of weight 1; those from base on have regions of their own."""
    leaf = lambda s: Node(f"s{s}", 1.0, (), s)
    regions = []
    if shards >= base:
        for r in range(0, base, per_rack * racks):
            regions.append(_node(f"r{r}", [_node(f"r{r}k{k}", [leaf(s) for s in range(k, min(k + per_rack, base))]) for k in range(r, min(r + per_rack * racks, base), per_rack)]))
    for s in range(base if shards >= base else 0, shards):
        regions.append(_node(f"r{s}", [_node(f"r{s}k{s}", [leaf(s)])]))
    return _node("all", regions)


def _draw(key: Column, node: Node) -> Column:
    u = (F.xxhash64(key, F.lit(node.name)).bitwiseAND(F.lit(2**53 - 1)).cast("double") + 0.5) / float(2**53)
    return -F.log(u) / node.weight


def place(key: Column, node: Node) -> Column:
    """The shard of a key: one draw at each level, only among the children of the node drawn above."""
    if not node.below:
        return F.lit(node.shard)
    if len(node.below) == 1:
        return place(key, node.below[0])
    won = F.array_min(F.array(*[F.struct(_draw(key, x).alias("d"), F.lit(i).alias("i")) for i, x in enumerate(node.below)]))["i"]
    out = place(key, node.below[-1])
    for i, x in list(enumerate(node.below))[-2::-1]:
        out = F.when(won == i, place(key, x)).otherwise(out)
    return out


def shard_rows(docs: DataFrame, shards: int = 16, buckets: int = 1024) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for each document."""
    text = text_or_empty()
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).cast("long").alias("text_crc32"))
    rows = rows.withColumns({"law": F.lit("key"), "shard": place(F.col("doc_id"), topology(shards)).cast("int"), "grown_shard": place(F.col("doc_id"), topology(shards + 1)).cast("int")})
    slots = gapless(rows, "shard", ["doc_id", "size", "text_crc32"], ["doc_id"], buckets)
    return slots.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
