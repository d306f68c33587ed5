"""Shared plumbing of the training-data operators: tables, shared storage and a gapless numbering."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir. Where that is unset, a folder of our own if
    Spark runs on this machine alone; on a cluster it must be set."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        at = spark.conf.get("spark.checkpoint.dir", None)
        if at is None and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and the executors share")
        sc.setCheckpointDir(at or tempfile.mkdtemp(prefix="rootline-"))
    return sc.getCheckpointDir()


@dataclass(eq=False)
class Stored:
    """A table written to the shared folder: its rows survive lost executors and its lineage is cut."""

    df: DataFrame
    path: str

    def drop(self) -> None:
        spark = self.df.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        keep(self)


#: What was stored since the innermost scratch() of this thread began; None outside of one.
_held: ContextVar[list[Stored] | None] = ContextVar("held", default=None)


def stored(df: DataFrame, label: str) -> Stored:
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = Stored(spark.read.schema(df.schema).parquet(path), path)
    hold(out)
    return out


def keep(table: Stored) -> None:
    """Leaves a table to its caller: scratch() doesn't delete it."""
    held = _held.get()
    if held is not None:
        held[:] = [t for t in held if t is not table]


def hold(table: Stored) -> None:
    """Gives a table to the scratch() around, which deletes it."""
    held = _held.get()
    if held is not None:
        held.append(table)


@contextmanager
def scratch() -> Iterator[None]:
    """Deletes what this thread stored inside; for callers that have written their result when they leave."""
    before = _held.set([])
    try:
        yield
    finally:
        for table in list(_held.get()):
            table.drop()
        _held.reset(before)


def text_marks(name: str = "text") -> tuple[Column, Column]:
    """Two hashes, t1 and t2, that together stand for a text; a null text is the empty text."""
    text = F.coalesce(F.col(name), F.lit(""))
    return F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def spread(key: Column, parts: int) -> Column:
    """A bucket from 0 to parts - 1 for each key; a null key has one too."""
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def gapless(df: DataFrame, group: str, order: list[str], spread_by: list[str], buckets: int = 256, name: str = "slot") -> DataFrame:
    """Numbers the rows of each group from 0 without gaps, in two steps so that no task needs a whole group.

    Each group is split into ``buckets`` hash buckets; the numbering inside a bucket starts after the rows of the buckets
    before it. The table of those starts has (groups x buckets) rows at most; its join needs no further shuffle of the rows.
    """
    cut = df.withColumn("_cut", F.pmod(F.xxhash64(*spread_by), F.lit(buckets)).cast("int"))
    before = Window.partitionBy(group).orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut.groupBy(group, "_cut").agg(F.count(F.lit(1)).alias("_n")).select(group, "_cut", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy(group, "_cut").orderBy(*order))
    return cut.withColumn("_at", inside).join(starts, [group, "_cut"]).withColumn(name, (F.col("_start") + F.col("_at") - 1).cast("long")).drop("_cut", "_at", "_start")
