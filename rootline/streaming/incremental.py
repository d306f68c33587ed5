"""Incremental analogues as Structured Streaming: weekly upserts by partition, and classifying only what is new."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootline.functions.expressions import iso_week
from rootline.operators.shared import shared_table


def weekly_upsert(stream: DataFrame, path: str, checkpoint: str, keys: list[str], ts: str = "ts", late: str | None = None):
    """Counts of a stream by keys and ISO week; a batch writes anew only the weeks in which a count changed.

    The counts are kept as state; ``late`` (like '15 days') drops weeks from it that no row on time can reach any more. A
    changed week is written as a whole: its changed counts and those it had. Writing a batch again gives the same files.
    """
    day = F.date_trunc("week", F.col(ts))
    own = stream if late is None else stream.withWatermark(ts, late)
    window = [] if late is None else [F.window(ts, "7 days", startTime="4 days").alias("_window")]  # ISO weeks start on Mondays
    counts = own.groupBy(*keys, *(window or [day.alias("_window")])).agg(F.count(F.lit(1)).alias("value"))
    start = F.col("_window.start") if late else F.col("_window")
    counts = counts.select(*keys, iso_week(start).alias("week"), "value")

    def write(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        new = shared_table(batch, "weekly")
        if fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs_path):
            was = spark.read.parquet(path).select(*new.columns).join(F.broadcast(new.select("week").distinct()), "week", "left_semi")
            new = shared_table(new.unionByName(was.join(new, [*keys, "week"], "left_anti")), "weekly")
        new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("week").parquet(path)

    return counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()


def classify_new(stream: DataFrame, key: str, classify, path: str, checkpoint: str):
    """Appends classify(new rows) for keys that the stored results lack; repeats inside a batch count once."""

    def write(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        new = batch.dropDuplicates([key])
        fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        if fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs_path):
            new = new.join(spark.read.parquet(path).select(key), key, "left_anti")
        classify(new).write.mode("append").parquet(path)

    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()


def release_decision(accepted: str | None, waiting: tuple[str, datetime | None] | None, release: str, now: datetime, modified: datetime | None = None, window: timedelta = timedelta(hours=48)) -> str:
    """known, sighted, settling or confirmed for a release that all signals agree on.

    accepted is the release in use, waiting the one that was seen since a time. A release is confirmed once its own date of
    change, or else its first sighting, is a window ago.
    """
    old = lambda since: since is not None and now - since >= window
    if release == accepted:
        return "known"
    if old(modified):
        return "confirmed"
    if waiting is None or waiting[0] != release:
        return "sighted"
    return "confirmed" if old(waiting[1]) else "settling"
