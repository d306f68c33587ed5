"""Choosing one row: top-1 by many keys, deterministic mode, keep-first, routing and cascades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top1(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the order given. Give an order without ties for a fixed result."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def top1_combined(df: DataFrame, keys: list[str], order: list[Column], take: list[str]) -> DataFrame:
    """Like top1 with ascending, non-null order expressions, but combined on the map side: a hot key moves one row a task."""
    best = F.min_by(F.struct(*take), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best.*")


def mode(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The most frequent value of each key; null is a candidate. Ties: not null first, then the shortest, then the least."""
    counted = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    text = F.col(value).cast("string")
    return top1_combined(counted, keys, [-F.col("_n"), F.col(value).isNull().cast("int"), F.coalesce(F.length(text), F.lit(0)), F.coalesce(text, F.lit(""))], [value])


def route(tiers: list[tuple[str, Column]], rest: str) -> Column:
    """The name of the first condition that holds, in one pass."""
    out = None
    for name, condition in tiers:
        out = F.when(condition, F.lit(name)) if out is None else out.when(condition, F.lit(name))
    return out.otherwise(F.lit(rest))


def cascade(df: DataFrame, group: str, kind: str, order_of_kinds: list[str], then: list[Column]) -> DataFrame:
    """From each group the rows of the first kind it has, and of these the best by ``then``; unknown kinds come last."""
    at = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, order_of_kinds)), F.col(kind)), F.lit(0)), F.lit(len(order_of_kinds) + 1))
    return top1(df.withColumn("_kind", at), [group], [F.col("_kind"), *then]).drop("_kind")


def only_row(df: DataFrame):
    """The single row of a lookup; anything else is an error."""
    rows = df.take(2)
    if len(rows) != 1:
        raise LookupError(f"one row expected, found {'none' if not rows else 'more'}")
    return rows[0]


def resume_from(df: DataFrame, order: str, key: str, value) -> DataFrame:
    """The rows from that of a key on, in the order of a column."""
    start = df.where(F.col(key) == F.lit(value)).agg(F.min(order).alias("_from"))
    return df.join(F.broadcast(start), F.col(order) >= F.col("_from")).drop("_from")


def shared_by_several(df: DataFrame, name: str, owner: str) -> DataFrame:
    """Names that more than one owner has."""
    return df.groupBy(name).agg(F.countDistinct(owner).alias("owners")).where("owners > 1")


def case_variant_ids(df: DataFrame, group: str, symbol: str, order: str) -> DataFrame:
    """(group, symbol, variant): symbols that differ in case only are numbered from 0 by first appearance."""
    first = df.groupBy(group, symbol).agg(F.min(order).alias("_first"))
    w = Window.partitionBy(group, F.lower(F.col(symbol))).orderBy("_first", symbol)
    return first.withColumn("variant", (F.row_number().over(w) - 1).cast("long")).drop("_first")
