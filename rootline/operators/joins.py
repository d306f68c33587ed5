"""Join shapes: fallbacks, re-adding what is unmatched, reduce-then-join, containment with the last one winning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fallback_join(left: DataFrame, right: DataFrame, exact: list[str], relaxed: list[str], value: str) -> DataFrame:
    """The value by all of ``exact``, else by ``relaxed``; the least value where a key has several."""
    one = right.groupBy(*exact).agg(F.min(value).alias("_exact"))
    two = right.groupBy(*relaxed).agg(F.min(value).alias("_relaxed"))
    return left.join(one, exact, "left").join(two, relaxed, "left").withColumn(value, F.coalesce("_exact", "_relaxed")).drop("_exact", "_relaxed")


def readd(left: DataFrame, best: DataFrame, key: str) -> DataFrame:
    """Every row of left with what best has for its key: what had no match stays with nulls."""
    return left.join(best, key, "left")


def reduce_then_join(facts: DataFrame, many: DataFrame, keys: list[str], collect: str, into: str) -> DataFrame:
    """Aggregates the many side to one sorted set for each key first, so the join is many-to-one and hot keys don't multiply."""
    return facts.join(many.groupBy(*keys).agg(F.array_sort(F.collect_set(collect)).alias(into)), keys)


def _grams(c: Column, most: int = 3) -> Column:
    """The distinct substrings of at most three letters, the empty one included."""
    of = lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - n + 1, F.lit(1))), lambda i: F.substring(c, i, F.lit(n)))
    return F.array_distinct(F.flatten(F.array(F.array(F.lit("")), *[F.when(F.length(c) >= n, of(n)).otherwise(F.array().cast("array<string>")) for n in range(1, most + 1)])))


def contained(inner: DataFrame, x: str, outer: DataFrame, y: str) -> DataFrame:
    """(x, y): the distinct pairs of texts with x anywhere in y. A text can only be in those that hold its rarest run of three
    letters (all of it, if it is shorter), so the join is by that run and containment is checked after it."""
    a, b = inner.select(x).where(F.col(x).isNotNull()).distinct(), outer.select(y).where(F.col(y).isNotNull()).distinct()
    held = b.select(y, F.explode(_grams(F.col(y))).alias("_g"))
    n = held.groupBy("_g").agg(F.count(F.lit(1)).alias("_n"))
    asked = a.select(x, F.explode(F.filter(_grams(F.col(x)), lambda g: F.length(g) == F.least(F.length(x), F.lit(3)))).alias("_g")).join(n, "_g")
    anchor = asked.groupBy(x).agg(F.min_by("_g", F.struct("_n", "_g")).alias("_g"))
    return anchor.join(held, "_g").where(F.contains(F.col(y), F.col(x))).select(x, y)


def contains_last_wins(names: DataFrame, name: str, labels: DataFrame, label: str, value: str, order: str, fixed: dict | None = None, skip: tuple = ()) -> DataFrame:
    """(name, value) of each name for which a label is found, by the last label in order.

    A name stands for its part before a bracket and the part inside it, in lower case; a label matches if it holds one of
    them, or if its own part before a bracket is in one of them. ``fixed`` names have their value from there; those in
    ``skip`` have none.
    """
    low, base = F.lower(F.col(name)), lambda c: F.trim(F.split_part(c, F.lit("("), F.lit(1)))
    inside = F.when(low.contains("("), F.trim(F.split_part(F.split_part(low, F.lit("("), F.lit(2)), F.lit(")"), F.lit(1))))
    variants = names.select(name, F.explode(F.filter(F.array(base(low), inside), lambda v: v.isNotNull())).alias("_v")).distinct()
    own = labels.select(F.lower(label).alias("_l"), base(F.lower(F.col(label))).alias("_b"), F.col(value).alias(value), F.col(order).alias("_o"))
    one = contained(variants, "_v", own, "_l").join(own, "_l").select("_v", value, "_o")
    two = contained(own, "_b", variants, "_v").join(own, "_b").select("_v", value, "_o")
    found = variants.join(one.union(two), "_v").groupBy(name).agg(F.max_by(value, "_o").alias(value))
    if fixed:
        spark = names.sparkSession
        sure = spark.createDataFrame(sorted(fixed.items()), f"`{name}` string, `{value}` {dict(labels.dtypes)[value]}")
        found = found.join(sure.select(name), name, "left_anti").unionByName(sure)
    return found.where(~F.col(name).isin(*skip)) if skip else found


def cut(df: DataFrame, places: list[int]) -> DataFrame:
    """Columns by place, from 1."""
    return df.select(*[F.col(f"`{df.columns[i - 1]}`") for i in places])


def rewrite_where(df: DataFrame, condition: Column, changes: dict[str, Column]) -> DataFrame:
    """Rows that hold a condition, with some columns rewritten: a filter and a rewrite in one pass."""
    return df.where(condition).withColumns(changes)


def search_rows(df: DataFrame, pattern: str, columns: list[str] | None = None) -> DataFrame:
    """Rows in which any of the columns (all by default) has a match of a pattern."""
    hit = F.lit(False)
    for c in columns or df.columns:
        hit = hit | F.coalesce(F.col(f"`{c}`").cast("string").rlike(pattern), F.lit(False))
    return df.where(hit)


def union_patched(frames: list[DataFrame]) -> DataFrame:
    """Union by name; columns that a frame lacks become null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
