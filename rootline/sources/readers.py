"""Readers: delimited tables, FASTA, JSON maps, taxonomy dumps, landed REST pages, databases, keyed directories."""

from __future__ import annotations

import re
import zipfile
from datetime import UTC, datetime
from email.utils import parsedate_to_datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rootline.functions.expressions import blank, float_text_to_long
from rootline.sources import schemas, turtle

# '' stays '' and a blank field is null; doubled quotes are quotes
_CSV = {"escape": '"', "nullValue": "\u0001", "emptyValue": ""}


def read_table(spark: SparkSession, path, schema: T.StructType, sep: str = "\t", header: bool = True) -> DataFrame:
    """A delimited table with a declared schema; .gz is read as it is; header=False takes the schema's names by place."""
    return spark.read.schema(schema).options(**_CSV).csv(path, sep=sep, header=header, enforceSchema=not header)


def read_strings(spark: SparkSession, path, names: list[str], sep: str = "\t") -> DataFrame:
    return read_table(spark, path, schemas.all_strings(names), sep)


def ids_to_long(df: DataFrame, columns: list[str]) -> DataFrame:
    """Ids read as doubles or as text like '57494.0' become longs."""
    return df.withColumns({c: float_text_to_long(F.col(c)) for c in columns})


def read_jdbc(spark: SparkSession, url: str, query: str, partition: tuple[str, int, int, int] | None = None, fetchsize: int = 10_000) -> DataFrame:
    """A query of a database; partition (column, lower, upper, parts) reads it in parallel ranges. Carriage returns go."""
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", fetchsize)
    if partition:
        column, low, high, parts = partition
        reader = reader.option("dbtable", f"({query}) q").option("partitionColumn", column).option("lowerBound", low).option("upperBound", high).option("numPartitions", parts)
    else:
        reader = reader.option("query", query)
    df = reader.load()
    return df.withColumns({c: F.replace(F.col(c), F.lit("\r"), F.lit("")) for c, kind in df.dtypes if kind == "string"})


def fasta_header(h: Column) -> Column:
    """A struct of db, protein_id, entry, name, gene, organism, level from a header; fields that it lacks are null, level 0."""
    some = lambda p: F.nullif(F.regexp_extract(h, p, 1), F.lit(""))
    bare = F.regexp_extract(h, r"^>?(\S+)", 1)
    return F.struct(
        some(r"^>?(sp|tr)\|").alias("db"), F.coalesce(some(r"\|([^|]*)\|"), F.nullif(bare, F.lit(""))).alias("protein_id"), some(r"\|[^|]*\|(\S+)").alias("entry"),
        some(r"^\S+ (.+?)(?: OS=| OX=| GN=| PE=|$)").alias("name"), F.regexp_replace(some(r" GN=(.+?)(?: PE=| SV=|$)"), r"[ .()]", "_").alias("gene"),
        some(r" OX=(\d+)").try_cast("long").alias("organism"), F.coalesce(some(r" PE=(\d)").try_cast("int"), F.lit(0)).alias("level"),
    )


def read_fasta(spark: SparkSession, path) -> DataFrame:
    """(path, header, sequence): one row a record; empty files and other text give no rows."""
    raw = spark.read.text(path, lineSep="\n>").select(F.col("_metadata.file_path").alias("path"), F.regexp_replace("value", "^>", "").alias("r"))
    row = raw.where(F.col("r").contains("\n")).select("path", F.split_part("r", F.lit("\n"), F.lit(1)).alias("header"), F.regexp_replace(F.regexp_replace("r", r"^[^\n]*\n", ""), r"\s", "").alias("sequence"))
    return row.where(F.col("sequence").rlike("^[A-Za-z*-]+$"))


def proteome_table(records: DataFrame, keys: tuple[str, ...] = ("path",), legacy_levels: bool = False) -> DataFrame:
    """The proteome table from FASTA records. An isoform (P1-2) has its number as Isoform Count and the level of its
    base protein; legacy_levels gives every isoform the level of the file's first canonical protein instead."""
    p = records.select("*", fasta_header(F.col("header")).alias("h"))
    dash = F.col("h.protein_id").contains("-")
    p = p.select(*keys, F.col("h.db").alias("Database"), F.coalesce("h.gene", F.lit("")).alias("Gene"), F.col("h.protein_id").alias("Protein ID"), F.col("h.entry").alias("Entry Name"),
                 F.when(dash, F.split_part("h.protein_id", F.lit("-"), F.lit(2))).otherwise("1").alias("Isoform Count"), F.col("h.name").alias("Protein Name"), F.col("h.level").alias("_level"),
                 F.split_part("h.protein_id", F.lit("-"), F.lit(1)).alias("_base"), dash.alias("_iso"), F.col("sequence").alias("Sequence"))
    if legacy_levels:
        first = p.where("not _iso").groupBy(*keys).agg(F.min_by("_level", "Protein ID").alias("_plevel"))
        p = p.join(first, list(keys), "left")
    else:
        base = p.where("not _iso").groupBy(*keys, F.col("Protein ID").alias("_base")).agg(F.first("_level").alias("_plevel"))
        p = p.join(base, [*keys, "_base"], "left")
    level = F.when(F.col("_iso"), F.coalesce("_plevel", "_level")).otherwise(F.col("_level")).cast("int")
    return p.withColumn("Protein Existence Level", level).select(*keys, "Database", "Gene", "Protein ID", "Entry Name", "Isoform Count", "Protein Name", "Protein Existence Level", "Sequence")


def read_json_map(spark: SparkSession, path, kind: str) -> DataFrame:
    """(path, protein_id, value) from files that hold one JSON object each."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.from_json("value", kind).alias("m"))
    return raw.select("path", F.explode("m").alias("protein_id", "value"))


def read_proteome_candidates(spark: SparkSession, path) -> DataFrame:
    """Candidate proteomes from landed REST answers (JSON with results[]); excluded ones are dropped."""
    kind = "results array<struct<id:string,proteomeType:string,proteinCount:long,geneCount:long,strain:string,taxonomy:struct<taxonId:long,scientificName:string>,proteomeCompletenessReport:struct<buscoReport:struct<score:double>>>>"
    rows = spark.read.schema(kind).json(path, multiLine=True).select(F.explode("results").alias("r"))
    out = rows.select(F.col("r.id").alias("Proteome ID"), F.col("r.proteomeType").alias("Proteome Type"), F.col("r.taxonomy.taxonId").alias("Proteome Taxon ID"), F.col("r.taxonomy.scientificName").alias("Proteome Label"),
                      F.col("r.proteinCount").alias("Protein Count"), F.col("r.geneCount").alias("Gene Count"), F.col("r.proteomeCompletenessReport.buscoReport.score").alias("BUSCO Score"), F.col("r.strain").alias("Strain"))
    return out.where(F.coalesce("Proteome Type", F.lit("")) != "Excluded")


def next_link(header: str | None) -> str | None:
    """The next page's address in a Link header."""
    found = re.search(r'<([^>]+)>;\s*rel="next"', header or "")
    return found[1] if found else None


def land_pages(fetch, url: str, most: int = 100_000, tries: int = 5, retry_on: tuple[type[BaseException], ...] = (ConnectionError, TimeoutError)):
    """The bodies of a paged REST answer, to be landed as files; fetch(url) -> (body, headers). A page that fails with one of
    ``retry_on`` is asked for again, ``tries`` times in all. Bounded, without recursion."""
    for _ in range(most):
        for left in range(tries - 1, -1, -1):
            try:
                body, headers = fetch(url)
                break
            except retry_on:
                if not left:
                    raise
        yield body
        url = next_link(headers.get("Link"))
        if not url:
            return
    raise RuntimeError(f"more than {most} pages")


def read_dump(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A taxonomy dump file (fields end with tab, bar): all strings, empty fields ''."""
    names = schemas.DUMP_FIELDS[kind]
    parts = F.split(F.regexp_replace("value", r"\t\|$", ""), r"\t\|\t")
    return spark.read.text(path).select(parts.alias("f")).select(*[F.trim(F.coalesce(F.get("f", F.lit(i)), F.lit(""))).alias(n) for i, n in enumerate(names)])


def unpack_dump(archive: str, folder: str) -> list[str]:
    """Unzips the dump files to a folder the executors share."""
    with zipfile.ZipFile(archive) as z:
        return [z.extract(n, folder) for n in z.namelist() if n.endswith(".dmp")]


def read_statements(spark: SparkSession, path) -> DataFrame:
    """A statement table as TSV."""
    return read_table(spark, path, schemas.STATEMENTS)


def read_turtle(spark: SparkSession, path, prefixes: dict[str, str] | None = None) -> DataFrame:
    """Statements from Turtle; ``prefixes`` shorten IRIs in brackets. Files are split after lines that end with a dot, so large
    ones are read in parallel; a literal of several lines with such a line inside is an error, never other rows."""
    rows = spark.read.text(path, lineSep=".\n").mapInPandas(turtle.parser(prefixes), "subject string, predicate string, object string, datatype string")
    return rows.select(F.lit(1).alias("assertion"), F.lit(0).alias("retraction"), F.lit("graph").alias("graph"), "subject", "predicate", "object", "datatype", F.lit(None).cast("string").alias("annotation"))


def with_path_key(df: DataFrame, pattern: str = r"/([^/]+)/[^/]+$", name: str = "species_taxon_id") -> DataFrame:
    """A key from the file's path (read with a glob); numeric keys are longs."""
    found = F.regexp_extract(F.col("path") if "path" in df.columns else F.col("_metadata.file_path"), pattern, 1)
    return df.withColumn(name, found.try_cast("long"))


def file_sizes(spark: SparkSession, path) -> DataFrame:
    """(path, bytes) of files, from the listing alone."""
    return spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("bytes"))


def candidate_files(species: DataFrame, folders: DataFrame, files: DataFrame, records: DataFrame) -> DataFrame:
    """species (species_taxon_id, ...) with exists (it has a folder), and bytes and records of its sequence file.

    folders (species_taxon_id) are those that exist, with or without files; files and records have a path.
    """
    size = with_path_key(files).groupBy("species_taxon_id").agg(F.sum("bytes").alias("bytes"))
    n = with_path_key(records).groupBy("species_taxon_id").agg(F.count(F.lit(1)).alias("records"))
    have = folders.select("species_taxon_id", F.lit(True).alias("exists")).distinct()
    out = species.join(have, "species_taxon_id", "left").join(size, "species_taxon_id", "left").join(n, "species_taxon_id", "left")
    return out.withColumn("exists", F.coalesce("exists", F.lit(False)))


def sql_read(spark: SparkSession, views: dict[str, DataFrame], sql: str) -> DataFrame:
    """A SQL query over frames, each a temporary view under its name."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql)


def structure_ids(raw: DataFrame) -> DataFrame:
    """(sequence, accession, id) from a structure table whose ids are joined by '+'; blank accessions are null."""
    ids = raw.withColumn("id", F.explode(F.split("ids", r"\s*\+\s*"))).where(~blank(F.col("id")))
    return ids.select("sequence", F.nullif("accession", F.lit("")).alias("accession"), float_text_to_long(F.col("id")).alias("id"))


def land(spark: SparkSession, bodies, path: str) -> int:
    """Writes pages as text files, one a page, to a folder that the executors read; gives their number."""
    n = 0
    for n, body in enumerate(bodies, 1):
        spark.createDataFrame([(body,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/page={n:06d}")
    return n


def agreed_release(signals: list[str | None], least: int = 2) -> str | None:
    """The release that all signals name, if at least so many name one; None where they differ."""
    named = [s for s in signals if s]
    return named[0] if len(named) >= least and len(set(named)) == 1 else None


def release_signal(headers: dict[str, str] | None = None, body: str = "", pattern: str | None = None) -> tuple[str | None, datetime | None]:
    """(release, modified) from an answer's headers or from a pattern in its body; the fetching is the caller's."""
    headers = headers or {}
    found = re.search(pattern, body) if pattern else None
    release = found[1] if found else headers.get("X-Release") or headers.get("ETag", "").strip('W/"') or None
    when = headers.get("Last-Modified")
    return release, parsedate_to_datetime(when).astimezone(UTC) if when else None
