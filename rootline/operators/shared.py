"""Tables written to the folder that driver and executors share: they cut lineage and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset, a folder of our own if Spark runs on this machine alone. On a cluster it
    must be set."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        at = spark.conf.get("spark.checkpoint.dir", None)
        if at is None and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and the executors share")
        sc.setCheckpointDir(at or tempfile.mkdtemp(prefix="rootline-"))
    return sc.getCheckpointDir()


def shared_table(df: DataFrame, label: str) -> DataFrame:
    """The rows of df, written to the shared folder and read from it."""
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
