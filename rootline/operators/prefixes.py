"""Typeahead by a stored index: the best values of every beginning, kept up by merging.

Beginnings of up to ``longest`` letters have their ``keep`` best values (shortest, then in order of the text), without regard
to case. A lookup reads one partition of the index. Longer typed texts are looked up among the values themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BUCKETS = 64


def _bucket(prefix: Column) -> Column:
    return F.pmod(F.xxhash64(prefix), F.lit(BUCKETS)).cast("int")


def _best(rows: DataFrame, keep: int) -> DataFrame:
    """The best values of each beginning; Spark cuts a beginning that all values have to ``keep`` rows a task before it shuffles."""
    w = Window.partitionBy("prefix").orderBy(F.length("value"), "value")
    return rows.withColumn("place", F.row_number().over(w)).where(F.col("place") <= keep)


def prefix_rows(values: DataFrame, column: str, longest: int = 12, keep: int = 40) -> DataFrame:
    """(prefix, value, place) for the beginnings of the distinct values; null and empty values have none."""
    own = values.select(F.col(column).cast("string").alias("value")).where("value <> ''").distinct()
    low = F.lower("value")
    sizes = F.sequence(F.lit(1), F.least(F.length(low), F.lit(longest)))
    return _best(own.select(F.explode(F.transform(sizes, lambda n: F.substring(low, F.lit(1), n))).alias("prefix"), "value"), keep)


def write_index(values: DataFrame, column: str, path: str, longest: int = 12, keep: int = 40) -> None:
    _write(prefix_rows(values, column, longest, keep), path)


def _write(rows: DataFrame, path: str) -> None:
    rows.withColumn("bucket", _bucket(F.col("prefix"))).repartition(BUCKETS, "bucket").sortWithinPartitions("prefix", "place").write.mode("error").partitionBy("bucket").parquet(path)


def merge_index(spark: SparkSession, old: str, values: DataFrame, column: str, path: str, longest: int = 12, keep: int = 40) -> None:
    """A new index from an old one (of the same parameters) and new values alone: the best of both are the best of all."""
    was = spark.read.parquet(old).select("prefix", "value")
    _write(_best(was.union(prefix_rows(values, column, longest, keep).select("prefix", "value")).distinct(), keep), path)


def lookup(spark: SparkSession, path: str, typed: str, limit: int = 40) -> DataFrame:
    """(value, place) for what begins with the typed text (as long as the index's beginnings at most, nothing else is found)."""
    at = spark.range(1).select(_bucket(F.lower(F.lit(typed))).alias("b")).first()["b"]
    hits = spark.read.parquet(path).where((F.col("bucket") == at) & (F.col("prefix") == F.lower(F.lit(typed))) & (F.col("place") <= limit))
    return hits.select("value", "place")


def lookup_all(index: DataFrame, typed: DataFrame, text: str, limit: int = 40) -> DataFrame:
    """(text, value, place) for a table of typed texts."""
    asked = typed.select(F.col(text).alias("typed")).distinct().withColumns({"prefix": F.lower("typed"), "bucket": _bucket(F.lower("typed"))})
    return index.where(F.col("place") <= limit).join(asked, ["bucket", "prefix"]).select("typed", "value", "place")
