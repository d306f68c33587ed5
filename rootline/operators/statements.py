"""Statements: the one table shape of all trees, and their constructors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("assertion", T.IntegerType()), T.StructField("retraction", T.IntegerType()), T.StructField("graph", T.StringType()),
    T.StructField("subject", T.StringType()), T.StructField("predicate", T.StringType()), T.StructField("object", T.StringType()),
    T.StructField("datatype", T.StringType()), T.StructField("annotation", T.StringType()),
])
DATATYPES = ("_IRI", "xsd:string", "xsd:boolean", "xsd:integer")
IRI, STRING = "_IRI", "xsd:string"


def _text(x) -> Column:
    return (x if isinstance(x, Column) else F.lit(x)).cast("string")


def triple(subject, predicate, object_, datatype: str = IRI, annotation=None) -> Column:
    return F.struct(
        F.lit(1).alias("assertion"), F.lit(0).alias("retraction"), F.lit("graph").alias("graph"), _text(subject).alias("subject"), _text(predicate).alias("predicate"),
        _text(object_).alias("object"), F.lit(datatype).alias("datatype"), _text(annotation).alias("annotation"),
    )


def owl_class(node, label, parent) -> list[Column]:
    """Class, label and parent of a node."""
    return [triple(node, "rdf:type", "owl:Class"), triple(node, "rdfs:label", label, STRING), triple(node, "rdfs:subClassOf", parent)]


def emit(df: DataFrame, triples: list[Column], extra: list[Column] | None = None, graph: str | None = None) -> DataFrame:
    """The statements of each row: those listed, and arrays of them; without an object there is none."""
    arrays = F.flatten(F.array(F.array(*triples), *(extra or []))) if extra else F.array(*triples)
    out = df.select(F.explode(arrays).alias("s")).select("s.*").where("subject is not null and object is not null")
    return out.withColumn("graph", F.lit(graph)) if graph else out


def checked(statements: DataFrame) -> DataFrame:
    """Statements that hold the rules of an insert; the first row that breaks one raises when it is read."""
    bad = (
        F.when(F.col("subject").isNull() | F.col("predicate").isNull() | F.col("object").isNull(), "a statement needs subject, predicate and object")
        .when(~F.col("datatype").isin(*DATATYPES), F.concat(F.lit("unknown datatype "), "datatype"))
        .when((F.col("predicate") == "rdfs:label") & (F.col("datatype") != STRING), "labels must be xsd:string")
        .when((F.col("datatype") == IRI) & ~F.col("object").rlike(r"^(<.*>|_:\S+|[\w-]+:\S+)$"), F.concat(F.lit("not an identifier: "), "object"))
        .when(~F.col("subject").rlike(r"^(<.*>|_:\S+|[\w-]+:\S+)$"), F.concat(F.lit("not an identifier: "), "subject"))
    )
    return statements.where(F.when(bad.isNotNull(), F.raise_error(bad).cast("boolean")).otherwise(F.lit(True)))


def edges(statements: DataFrame, predicates: tuple[str, ...] = ("rdfs:subClassOf",)) -> DataFrame:
    """(child, parent) without blank nodes."""
    s = statements.where(F.col("predicate").isin(*predicates) & ~F.col("object").startswith("_:"))
    return s.select(F.col("subject").alias("child"), F.col("object").alias("parent"))


def prune(statements: DataFrame, values: tuple[str, ...] = ("lower", ""), predicate: str | None = None) -> DataFrame:
    """Drops every subject with any object among the values; only objects of one predicate count if it is given."""
    hit = statements.where(F.col("object").isin(*values))
    hit = hit.where(F.col("predicate") == predicate) if predicate else hit
    return statements.join(hit.select("subject").distinct(), "subject", "left_anti").select(*statements.columns)


def copy_for(statements: DataFrame, subjects: DataFrame, skip: tuple[str, ...] = (), graph: str | None = None) -> DataFrame:
    """Statements of the given subjects, without some predicates, into another graph if named."""
    out = statements.join(subjects.select("subject").distinct(), "subject", "left_semi").where(~F.col("predicate").isin(*skip)) if skip else statements.join(subjects.select("subject").distinct(), "subject", "left_semi")
    return (out.withColumn("graph", F.lit(graph)) if graph else out).select(*statements.columns)


def rename_graph(statements: DataFrame, graph: str) -> DataFrame:
    return statements.withColumn("graph", F.lit(graph))


def reparent(statements: DataFrame, roots: list[str], to: str) -> DataFrame:
    """Children of some roots go under another node."""
    move = (F.col("predicate") == "rdfs:subClassOf") & F.col("object").isin(*roots)
    return statements.withColumn("object", F.when(move, F.lit(to)).otherwise(F.col("object")))


def relabel(statements: DataFrame, pattern: str, to: str) -> DataFrame:
    """A regular-expression replacement in labels."""
    return statements.withColumn("object", F.when(F.col("predicate") == "rdfs:label", F.regexp_replace("object", pattern, to)).otherwise(F.col("object")))


def renumber(statements: DataFrame, prefixes: list[str], to: str) -> DataFrame:
    """Renames identifier prefixes of subjects and of identifier objects."""
    pattern = "^(?:" + "|".join(prefixes) + ")"
    return statements.withColumn("subject", F.regexp_replace("subject", pattern, to)).withColumn("object", F.when(F.col("datatype") == IRI, F.regexp_replace("object", pattern, to)).otherwise(F.col("object")))


def names_as_synonyms(taxonomy: DataFrame, tree: DataFrame) -> DataFrame:
    """Exact synonyms for the tree: scientific names of the taxonomy that differ from the tree's label, not only in case."""
    a = taxonomy.where("predicate = 'rdfs:label'").select("subject", F.col("object").alias("name"))
    b = tree.where("predicate = 'rdfs:label'").select("subject", F.col("object").alias("label"))
    return a.join(b, "subject").where("name <> label and lower(name) <> lower(label)").transform(
        lambda x: emit(x, [triple(F.col("subject"), "oio:hasExactSynonym", F.col("name"), STRING, '{"oio:hasSynonymType":[{"datatype":"xsd:string","meta":"owl:Axiom","object":"NCBI Taxonomy scientific name"}]}')])
    )


def compare(left: DataFrame, right: DataFrame) -> DataFrame:
    """(subject, predicate, object, side): statements that only one of two trees has, or both."""
    key = ["subject", "predicate", "object"]
    a = left.select(*key).distinct().withColumn("_l", F.lit(True))
    b = right.select(*key).distinct().withColumn("_r", F.lit(True))
    side = F.when(F.col("_l") & F.col("_r"), "both").when(F.col("_l"), "left").otherwise("right")
    return a.join(b, key, "full").withColumn("side", side).drop("_l", "_r")
