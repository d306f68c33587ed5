"""Writers: delimited tables, FASTA, JSON maps, Turtle, HTML, checked statements, releases."""

from __future__ import annotations

import html
import json
from collections.abc import Iterable
from email.message import EmailMessage

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootline.operators.shared import shared_table
from rootline.operators.statements import checked


def write_tsv(df: DataFrame, path: str, one_file: bool = False, sep: str = "\t") -> None:
    """A delimited table; one file only where it is small enough for one task."""
    (df.coalesce(1) if one_file else df).write.mode("overwrite").csv(path, sep=sep, header=True, quote='"', escape='"', emptyValue='""', nullValue="")


def csv_to_tsv(spark, source: str, target: str) -> None:
    df = spark.read.csv(source, header=True, escape='"', nullValue="\u0001", emptyValue="")
    write_tsv(df, target)


def sql_to_tsv(spark, sql: str, path: str) -> None:
    """A query's rows with nulls as empty fields."""
    df = spark.sql(sql)
    write_tsv(df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in df.columns]), path)


def replace_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").saveAsTable(name)


def numbered(df: DataFrame, order: list[str], name: str = "row_number") -> DataFrame:
    """Rows numbered from 1 in a global order, with '' as null: range partitions, then an offset for each partition."""
    kinds = dict(df.dtypes)
    clean = df.select(*[F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c) if kinds[c] == "string" else F.col(f"`{c}`") for c in df.columns])
    indexed = shared_table(clean.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()), "numbered")  # both uses below read the same ids
    parts = indexed.groupBy(F.shiftright("_id", 33).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    # one row a partition: the running sum is over as many rows as there are partitions
    before = parts.alias("a").join(parts.alias("b"), F.col("b._p") < F.col("a._p"), "left").groupBy("a._p").agg(F.coalesce(F.sum("b._n"), F.lit(0)).alias("_before"))
    out = indexed.withColumn("_p", F.shiftright("_id", 33)).join(F.broadcast(before), "_p")
    return out.withColumn(name, F.col("_before") + F.col("_id").bitwiseAND(F.lit(2**33 - 1)) + 1).drop("_p", "_id", "_before")


def append_statements(statements: DataFrame, path: str) -> None:
    """Appends statements that hold the rules; one that doesn't fails the write."""
    checked(statements).write.mode("append").partitionBy("predicate").parquet(path)


def write_fasta(df: DataFrame, accession: str, sequence: str, path: str) -> None:
    df.select(F.concat(F.lit(">"), accession, F.lit("\n"), sequence)).write.mode("overwrite").text(path)


def allergen_records(df: DataFrame, name: str = "Name", sequence: str = "Sequence", least: int = 5) -> DataFrame:
    """(accession, sequence): a sequence of several fragments ('>name:SEQ' parts) gives a record for each of at least ``least`` residues."""
    clean = lambda c: F.regexp_replace(F.upper(c), "[^A-Z]", "")
    parts = F.filter(F.split(sequence, ">"), lambda x: F.trim(x) != "")
    rows = df.where(F.col(sequence).isNotNull()).select(F.col(name).alias("n"), F.size(parts).alias("k"), F.posexplode(parts).alias("i", "part"))
    body = F.when(F.col("part").contains(":"), F.regexp_replace("part", "^[^:]*:", "")).otherwise(F.col("part"))
    rows = rows.select(F.when(F.col("k") > 1, F.concat("n", F.lit("_frag_"), (F.col("i") + 1).cast("string"))).otherwise(F.col("n")).alias("accession"), clean(body).alias("sequence"))
    return rows.where(F.length("sequence") >= least)


def write_json_lines(df: DataFrame, key: str, value: str, path: str) -> None:
    """One JSON object a line, {key: value}; lines merge to one map when read."""
    df.select(F.to_json(F.create_map(F.col(key).cast("string"), F.col(value)))).write.mode("overwrite").text(path)


def json_map(rows: Iterable, key: str, value: str) -> str:
    """One JSON map of a small result."""
    return json.dumps({r[key]: r[value] for r in rows}, sort_keys=True)


def write_turtle(statements: DataFrame, path: str) -> None:
    """One statement a line, in the order of subject, predicate, object."""
    escaped = F.col("object")
    for char, code in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r")):
        escaped = F.replace(escaped, F.lit(char), F.lit(code))
    kind = F.when(F.col("datatype") == "xsd:string", "").when(F.col("datatype").startswith("@"), F.col("datatype")).otherwise(F.concat(F.lit("^^"), "datatype"))
    literal = F.concat(F.lit('"'), escaped, F.lit('"'), kind)
    line = F.concat_ws(" ", "subject", "predicate", F.when(F.col("datatype") == "_IRI", F.col("object")).otherwise(literal), F.lit("."))
    statements.orderBy("subject", "predicate", "object").select(line).write.mode("overwrite").text(path)


def write_statements(statements: DataFrame, path: str) -> None:
    write_tsv(statements.orderBy(*[F.col(c) for c in statements.columns]), path)


def write_release(df: DataFrame, path: str, release: str) -> None:
    """A release is a partition; writing it again replaces it alone, earlier ones stay as they are."""
    df.withColumn("release", F.lit(release)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("release").parquet(path)


def previous_release(df: DataFrame, release: str) -> DataFrame:
    """The rows of the latest release before one."""
    last = df.where(F.col("release").cast("string") < release).agg(F.max("release").alias("release"))
    return df.join(F.broadcast(last), "release", "left_semi")


def html_tree(rows: Iterable[tuple[list[str], str]]) -> str:
    """A nested list from (path, label) rows of a small tree in depth-first order."""
    out, depth = [], 0
    for path, label in rows:
        out.append("<ul>" * max(0, len(path) - depth) + "</ul>" * max(0, depth - len(path)) + f"<li>{html.escape(label)}</li>")
        depth = len(path)
    return "".join(out) + "</ul>" * depth


def html_table(df: DataFrame, limit: int = 500) -> str:
    """A digest of a small result; a last line tells that there are rows beyond the limit."""
    rows = df.limit(limit + 1).collect()
    more, rows = len(rows) > limit, rows[:limit]
    cells = lambda tag, xs: "<tr>" + "".join(f"<{tag}>{html.escape('' if x is None else str(x))}</{tag}>" for x in xs) + "</tr>"
    return "<table>" + cells("th", df.columns) + "".join(cells("td", r) for r in rows) + "</table>" + f"<p>The first {limit} rows; there are more.</p>" * more


def digest_subject(status: str, week: str, run: str = "release run") -> str:
    """The subject line of a weekly digest: red for critical, green with a note for warnings, else green."""
    if status == "critical":
        return f"{run} is RED with a CRITICAL - {week}"
    return f"{run} is green{' with WARNING(s)' if status == 'warning' else ''} - {week}"


def digest_mail(subject: str, html_body: str, to: str, sender: str, text: str = "The digest is in the HTML part.") -> EmailMessage:
    """A mail with a text and an HTML part; delivering it is the caller's."""
    mail = EmailMessage()
    mail["Subject"], mail["From"], mail["To"] = subject, sender, to
    mail.set_content(text)
    mail.add_alternative(html_body, subtype="html")
    return mail
