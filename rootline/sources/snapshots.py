"""Several tables published as one release: readers see all of it or nothing.

Tables are written to a folder of their own, then a manifest that names them, with row counts and digests, is put in place by
one rename. Readers go through the newest manifest, so what a failed or unfinished write left is never read.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DIGEST = "decimal(38,0)"


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def row_digest(df: DataFrame) -> Column:
    """A 64-bit hash of a row: columns in the order of their names, nulls told from empty texts, maps not allowed."""
    cols = sorted(df.columns)
    return F.xxhash64(*[x for c in cols for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))])


def digest(df: DataFrame) -> tuple[int, str]:
    """(rows, digest): two sums over all rows, so the order and the partitions don't matter; repeated rows count."""
    h = row_digest(df)
    got = df.select(h.alias("h")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("h").cast(DIGEST)).alias("a"), F.sum(F.xxhash64("h").cast(DIGEST)).alias("b")).first()
    return got["n"], f"{got['a'] or 0}:{got['b'] or 0}"


def publish(tables: dict[str, DataFrame], path: str, release: str) -> dict:
    """Writes the tables of a release and then its manifest, which is returned. A release is published once."""
    if not tables or not release or "/" in release:
        raise ValueError("a release has a name and tables")
    spark = next(iter(tables.values())).sparkSession
    fs, at = _fs(spark, f"{path}/manifests/{release}.json")
    if fs.exists(at):
        raise FileExistsError(f"release {release} is there already")
    folder, listed = f"data/{release}-{uuid.uuid4().hex}", {}
    for name, df in tables.items():
        df.write.parquet(f"{path}/{folder}/{name}")
        rows, sums = digest(spark.read.schema(df.schema).parquet(f"{path}/{folder}/{name}"))
        listed[name] = {"path": f"{folder}/{name}", "rows": rows, "digest": sums, "schema": df.schema.json()}
    manifest = {"release": release, "tables": listed}
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/manifests/.{uuid.uuid4().hex}")
    out = fs.create(draft)
    out.write(bytearray(json.dumps(manifest, indent=1, sort_keys=True).encode()))
    out.close()
    if not fs.rename(draft, at):  # another writer was first
        fs.delete(draft, False)
        raise FileExistsError(f"release {release} is there already")
    return manifest


def releases(spark: SparkSession, path: str) -> list[str]:
    """The published releases, oldest name first."""
    fs, at = _fs(spark, f"{path}/manifests")
    if not fs.exists(at):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(at)]
    return sorted(n.removesuffix(".json") for n in names if n.endswith(".json") and not n.startswith("."))


def read_manifest(spark: SparkSession, path: str, release: str | None = None) -> dict:
    """The manifest of a release, or of the newest one."""
    known = releases(spark, path)
    name = release or (known[-1] if known else None)
    if name not in known:
        raise FileNotFoundError(f"no release {name or ''} at {path}")
    return json.loads(spark.read.text(f"{path}/manifests/{name}.json", wholetext=True).first()[0])


def read_release(spark: SparkSession, path: str, release: str | None = None, verify: bool = False) -> dict[str, DataFrame]:
    """The tables of one release, all of the same one; ``verify`` compares counts and digests with the manifest first."""
    manifest, out = read_manifest(spark, path, release), {}
    for name, told in manifest["tables"].items():
        out[name] = spark.read.schema(_schema(told["schema"])).parquet(f"{path}/{told['path']}")
        if verify and digest(out[name]) != (told["rows"], told["digest"]):
            raise ValueError(f"table {name} of release {manifest['release']} isn't what its manifest says")
    return out


def _schema(text: str):
    from pyspark.sql.types import StructType

    return StructType.fromJson(json.loads(text))


def changed_tables(spark: SparkSession, path: str, old: str, new: str) -> dict[str, str]:
    """Which tables came, went, changed or stayed between two releases, told by the manifests alone."""
    a, b = (read_manifest(spark, path, r)["tables"] for r in (old, new))
    same = lambda x, y: (x["rows"], x["digest"], x["schema"]) == (y["rows"], y["digest"], y["schema"])
    return {n: "removed" if n not in b else "added" if n not in a else "same" if same(a[n], b[n]) else "changed" for n in sorted(a.keys() | b.keys())}
