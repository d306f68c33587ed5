"""Declarative validation: datatypes with conditions and parents, structures, and rules of curated trees, as messages."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rootline.operators import graph


@dataclass(frozen=True)
class Datatype:
    name: str
    parent: str | None
    condition: str | None


def datatypes(rows: list[tuple[str, str | None, str | None]]) -> dict[str, Datatype]:
    """Rows (name, parent, condition) as read from a datatype table."""
    return {n: Datatype(n, p or None, c or None) for n, p, c in rows}


def holds(condition: str, column: Column) -> Column:
    """equals('x'), exclude(/re/), match(/re/) (of the whole value) or in('a', 'b')."""
    kind, body = re.fullmatch(r"(equals|exclude|match|in)\((.*)\)", condition.strip(), re.S).groups()
    if kind in ("exclude", "match"):
        pattern = body.strip()[1:-1]
        return ~column.rlike(pattern) if kind == "exclude" else column.rlike(f"^(?:{pattern})$")
    values = [a or b for a, b in re.findall(r"'([^']*)'|\"([^\"]*)\"", body)] or [""]
    return column.isin(values)


def fits(name: str, types: dict[str, Datatype], column: Column) -> Column:
    """A value fits a datatype if it holds the conditions of the type and of all its ancestors."""
    ok, seen = F.lit(True), set()
    while name:
        if name in seen:
            raise ValueError(f"datatype {name} is its own ancestor")
        seen.add(name)
        own = types[name]
        if own.condition:
            ok = ok & holds(own.condition, column)
        name = own.parent
    return ok


def _message(table: str, row: str, column: str, value: Column, rule: str, level: str, text: str) -> list[Column]:
    return [
        F.lit(table).alias("table"), F.col(row).cast("string").alias("row"), F.lit(column).alias("column"), value.cast("string").alias("value"), F.lit(level).alias("level"),
        F.lit(rule).alias("rule"), F.lit(text).alias("message"),
    ]


def check_datatype(df: DataFrame, table: str, row: str, column: str, name: str, types: dict[str, Datatype], nulltype: str | None = "empty") -> DataFrame:
    """Values that don't fit; nulls (and '' with nulltype empty) are missing values and fit."""
    c = F.nullif(F.col(column).cast("string"), F.lit("")) if nulltype == "empty" else F.col(column).cast("string")
    return df.where(c.isNotNull() & ~fits(name, types, c)).select(*_message(table, row, column, F.col(column), f"datatype:{name}", "error", f"must be of type {name}"))


def check_required(df: DataFrame, table: str, row: str, column: str) -> DataFrame:
    return df.where(F.nullif(F.col(column).cast("string"), F.lit("")).isNull()).select(*_message(table, row, column, F.col(column), "required", "error", "a value is required"))


def check_unique(df: DataFrame, table: str, row: str, column: str, rule: str = "unique") -> DataFrame:
    """All rows of a value that several rows have; counted by key first, so a hot value costs one row a task."""
    many = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(column)
    return df.join(many, column, "left_semi").select(*_message(table, row, column, F.col(column), rule, "error", "must be unique"))


def check_primary(df: DataFrame, table: str, row: str, column: str) -> DataFrame:
    return check_required(df, table, row, column).union(check_unique(df, table, row, column, "primary"))


def check_foreign(df: DataFrame, table: str, row: str, column: str, other: DataFrame, target: str, key: str) -> DataFrame:
    known = other.select(F.col(key).alias(column)).distinct()
    return df.where(F.col(column).isNotNull()).join(known, column, "left_anti").select(*_message(table, row, column, F.col(column), f"from:{target}", "error", f"must be in {target}"))


def check_tree(df: DataFrame, table: str, node: str, parent: str) -> DataFrame:
    """Parents must be nodes of the same table, and no node its own ancestor."""
    out = check_foreign(df, table, node, parent, df, f"{table}.{node}", node)
    up = graph.closure(df.select(F.col(node).alias("child"), F.col(parent).alias("parent")), down=False)
    step = df.select(F.col(node).alias("ancestor"), F.col(parent).alias("node"))
    # a node on a cycle is an ancestor of one of its own parents
    cyclic = step.join(up.select("node", F.col("ancestor").alias("above")), "node").where("above = ancestor").select(F.col("ancestor").alias(node)).distinct()
    return out.union(df.join(cyclic, node, "left_semi").select(*_message(table, node, parent, F.col(parent), f"tree:{node}", "error", "is its own ancestor")))


def core_checks(core: DataFrame, taxonomy: DataFrame, root: str, levels: tuple[str, ...] = ("upper", "species", "lower")) -> DataFrame:
    """Messages for a curated table (curie, label, label_source, parent, parent_label, level) against the taxonomy's
    (subject, label): path to the root, known parents and labels, level, missing taxa, label source."""
    at = lambda df, column, rule, text, level="error": df.select(*_message("core", "curie", column, F.col(column), rule, level, text))
    nodes = core.select(F.col("curie").alias("node"))
    lost = graph.without_path_to(core.select(F.col("curie").alias("child"), "parent"), nodes.where(F.col("node") != root), root)
    out = at(core.join(lost.withColumnRenamed("node", "curie"), "curie", "left_semi"), "parent", "path", "has no path to the root")
    up = core.select(F.col("curie").alias("parent"), F.col("label").alias("_plabel")).dropDuplicates(["parent"])
    joined = core.join(up, "parent", "left")
    out = out.union(at(joined.where(F.col("parent").isNotNull() & F.col("_plabel").isNull()), "parent", "parent", "parent is not in the table"))
    out = out.union(at(joined.where(F.col("parent_label") != F.col("_plabel")), "parent_label", "parent-label", "differs from the parent's label"))
    out = out.union(at(core.where(~F.col("level").isin(*levels)), "level", "level", "unknown level"))
    known = taxonomy.select(F.col("subject").alias("curie"), F.col("label").alias("_label")).dropDuplicates(["curie"])
    seen = core.join(known, "curie", "left")
    taxon = F.col("curie").rlike(r"^\w+:\d+$")
    out = out.union(at(seen.where(taxon & F.col("_label").isNull()), "curie", "missing-taxon", "is not in the taxonomy"))
    out = out.union(at(core.where(F.nullif("label_source", F.lit("")).isNull()), "label_source", "label-source", "has no source", "warn"))
    return out.union(at(seen.where((F.col("label_source") == "taxonomy") & (F.col("label") != F.col("_label"))), "label", "label", "differs from the taxonomy"))


def fixed_labels(core: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """The curated table with labels taken from the taxonomy where that is their source."""
    known = taxonomy.select(F.col("subject").alias("curie"), F.col("label").alias("_label")).dropDuplicates(["curie"])
    take = (F.col("label_source") == "taxonomy") & F.col("_label").isNotNull()
    return core.join(known, "curie", "left").withColumn("label", F.when(take, F.col("_label")).otherwise(F.col("label"))).select(*core.columns)


def replace_messages(messages: DataFrame, rules: list[str], new: DataFrame) -> DataFrame:
    """Drops the messages of the rule families named (by prefix) and adds new ones."""
    old = F.lit(False)
    for r in rules:
        old = old | F.col("rule").startswith(r)
    return messages.where(~F.coalesce(old, F.lit(False))).unionByName(new)


def filter_rows(df: DataFrame, conditions: dict[str, str], limit: int = 1000) -> DataFrame:
    """A row filter as the query strings of a table view have it: column -> eq."v", ne."v", like."v*", is.null, in.(a,b)."""
    for column, spec in conditions.items():
        op, _, raw = spec.partition(".")
        value = raw.strip('"')
        c = F.col(column)
        df = df.where({"eq": c == value, "ne": c != value, "like": c.like(value.replace("*", "%")), "is": c.isNull(), "in": c.isin([v.strip(' "') for v in raw.strip("()").split(",")])}[op])
    return df.limit(limit)


def typeahead(df: DataFrame, column: str, text: str, limit: int = 40) -> DataFrame:
    """Values that hold a text, those that start with it first, short before long."""
    c = F.lower(F.col(column))
    hit = df.where(F.contains(c, F.lit(text.lower()))).withColumn("order", F.when(c.startswith(text.lower()), 0).otherwise(1))
    return hit.orderBy("order", F.length(column), column).limit(limit)
