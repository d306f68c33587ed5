"""Whole-graph edits of statement tables: remove, filter, extract, and rules that delete and insert, applied in order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rootline.operators import graph, tree
from rootline.operators.shared import shared_table
from rootline.operators.statements import IRI, STRING, edges


def _nodes(df: DataFrame, terms: list[str]) -> DataFrame:
    return df.sparkSession.createDataFrame([(x,) for x in terms], "node string")


def _subjects(s: DataFrame, nodes: DataFrame, how: str) -> DataFrame:
    return s.join(nodes.select(F.col("node").alias("subject")).distinct(), "subject", how).select(*s.columns)


def remove_terms(s: DataFrame, terms: DataFrame) -> DataFrame:
    """Without all statements that name a term (node) as subject or object."""
    gone = terms.select(F.col("node").alias("object")).distinct()
    return _subjects(s, terms, "left_anti").join(gone, "object", "left_anti").select(*s.columns)


def remove_with_descendants(s: DataFrame, terms: list[str]) -> DataFrame:
    return _subjects(s, graph.reachable(edges(s), _nodes(s, terms)), "left_anti")


def keep_with_descendants(s: DataFrame, terms: list[str]) -> DataFrame:
    return _subjects(s, graph.reachable(edges(s), _nodes(s, terms)), "left_semi")


def keep_with_parents(s: DataFrame, terms: list[str], equivalent: str = "owl:equivalentClass") -> DataFrame:
    """The terms, their parents and what they are equivalent to: one step."""
    near = _nodes(s, terms)
    up = s.where(F.col("predicate").isin("rdfs:subClassOf", equivalent)).join(near.withColumnRenamed("node", "subject"), "subject", "left_semi").select(F.col("object").alias("node"))
    return _subjects(s, near.union(up), "left_semi")


def extract_upward(s: DataFrame, terms: list[str], top: str | None = None) -> DataFrame:
    """The terms with all their ancestors, up to a top term where one is named."""
    up = graph.reachable(edges(s), _nodes(s, terms), down=False)
    if top is not None:
        up = up.join(graph.reachable(edges(s), _nodes(s, [top])), "node", "left_semi")
    return _subjects(s, up, "left_semi")


def merge(*graphs: DataFrame) -> DataFrame:
    out = graphs[0]
    for g in graphs[1:]:
        out = out.unionByName(g, allowMissingColumns=True)
    return out.distinct()


def reduce_edges(s: DataFrame) -> DataFrame:
    """Without subclass statements that others imply, and without equivalences."""
    kept = graph.reduction(edges(s)).select(F.col("child").alias("subject"), F.col("parent").alias("object"), F.lit("rdfs:subClassOf").alias("predicate"))
    rest = s.where(~F.col("predicate").isin("rdfs:subClassOf", "owl:equivalentClass"))
    return rest.unionByName(s.join(kept, ["subject", "predicate", "object"], "left_semi").select(*s.columns))


def classes_outside(s: DataFrame, prefixes: list[str]) -> DataFrame:
    """(subject): classes without any of the prefixes, in order."""
    own = F.lit(False)
    for p in prefixes:
        own = own | F.col("subject").startswith(p)
    return s.where((F.col("predicate") == "rdf:type") & (F.col("object") == "owl:Class") & ~own).select("subject").distinct().orderBy("subject")


def classes_without_label(s: DataFrame) -> DataFrame:
    named = s.where("predicate = 'rdfs:label'").select("subject").distinct()
    return s.where("predicate = 'rdf:type' and object = 'owl:Class' and subject not like '\\\\_:%'").select("subject").distinct().join(named, "subject", "left_anti")


def apply_rule(s: DataFrame, delete: DataFrame | None, insert: DataFrame | None) -> DataFrame:
    """Deletes then inserts (subject, predicate, object[, datatype]) rows; the result is a set. What is deleted may be as large
    as the statements and isn't broadcast."""
    out = s
    if delete is not None:
        out = out.join(delete.select("subject", "predicate", "object").distinct().hint("merge"), ["subject", "predicate", "object"], "left_anti").select(*s.columns)
    if insert is not None:
        fixed = {"assertion": F.lit(1), "retraction": F.lit(0), "graph": F.lit("graph"), "datatype": F.lit(IRI), "annotation": F.lit(None).cast("string")}
        rows = insert.select(*[F.col(c) if c in insert.columns else fixed[c].alias(c) for c in s.columns])
        out = out.unionByName(rows).distinct()
    return out


def _parents(s: DataFrame, terms: list[str]) -> DataFrame:
    return s.where((F.col("predicate") == "rdfs:subClassOf") & F.col("subject").isin(terms))


def move(s: DataFrame, terms: list[str], away: list[str], to: str) -> DataFrame:
    """Takes terms from some parents and puts them under another, whether or not they had those parents."""
    gone = _parents(s, terms).where(F.col("object").isin(away))
    new = _nodes(s, terms).select(F.col("node").alias("subject"), F.lit("rdfs:subClassOf").alias("predicate"), F.lit(to).alias("object"))
    return apply_rule(s, gone, new)


def move_all(s: DataFrame, terms: list[str], to: str) -> DataFrame:
    """Terms that have parents get one parent in their place."""
    gone = _parents(s, terms)
    return apply_rule(s, gone, gone.select("subject", "predicate").distinct().withColumn("object", F.lit(to)))


def add_parent(s: DataFrame, child: str, parent: str) -> DataFrame:
    return apply_rule(s, None, _nodes(s, [child]).select(F.col("node").alias("subject"), F.lit("rdfs:subClassOf").alias("predicate"), F.lit(parent).alias("object")))


def add_parent_where(s: DataFrame, condition: Column, parent: str) -> DataFrame:
    hit = s.where(condition).select("subject").distinct()
    return apply_rule(s, None, hit.select("subject", F.lit("rdfs:subClassOf").alias("predicate"), F.lit(parent).alias("object")))


def add_parent_by_label(s: DataFrame, start: str, parent: str) -> DataFrame:
    return add_parent_where(s, (F.col("predicate") == "rdfs:label") & F.col("object").startswith(start), parent)


#: Names that the shipped rules of the disease tree use.
DISEASE, IMMUNE = "obo:DOID_4", "obo:DOID_417"
CATEGORIES = ["obo:DOID_7", "obo:DOID_150", "obo:DOID_0014667", "obo:DOID_630", "obo:DOID_225"]


def disease_rules(s: DataFrame) -> DataFrame:
    """All rules of the disease tree in their order: categories move, asymptomatic terms and top-level diseases get their
    places, alternative terms become labels, and two terms are mended by hand."""
    s = add_parent(move(s, CATEGORIES, [DISEASE], "ONTIE:0003542"), IMMUNE, DISEASE)
    s = add_parent_by_label(s, "asymptomatic", "ONTIE:0003424")
    s = move_all(s, ["obo:DOID_1205", IMMUNE], DISEASE)
    s = promote_labels(s, "obo:OBI_9991118", "oio:hasExactSynonym")
    s = add_parent(s, DISEASE, "ONTIE:0003543")
    s = move(s, ["obo:DOID_0060039"], ["obo:DOID_0060032", "obo:DOID_1575"], IMMUNE)
    return add_parent(s, "obo:DOID_6196", "obo:DOID_0060032")


def promote_labels(s: DataFrame, alternative: str, synonym: str) -> DataFrame:
    """The value of an alternative-term predicate becomes the label; the old label becomes a synonym."""
    alt = s.where(F.col("predicate") == alternative).select("subject", F.col("object").alias("_alt"))
    old = s.where("predicate = 'rdfs:label'").join(alt.hint("merge"), "subject")
    new = old.select("subject", F.explode(F.array(F.struct(F.lit("rdfs:label").alias("predicate"), F.col("_alt").alias("object")), F.struct(F.lit(synonym).alias("predicate"), F.col("object")))).alias("x"))
    return apply_rule(s, old, new.select("subject", "x.*", F.lit(STRING).alias("datatype")))


def list_members(s: DataFrame) -> DataFrame:
    """(head, place, member) of every collection; lists that end in a cycle have none. Cells find their head by doubling pointers."""
    cells = s.where("predicate = 'rdf:first'").select(F.col("subject").alias("cell"), F.col("object").alias("member"))
    back = s.where("predicate = 'rdf:rest' and object <> 'rdf:nil'").select(F.col("object").alias("child"), F.col("subject").alias("parent"))
    placed = tree.roots(back).select(F.col("node").alias("cell"), F.col("root").alias("head"), F.col("depth").alias("place"))
    at_cycle = back.select(F.col("child").alias("cell")).union(back.select("parent")).distinct().join(placed.select("cell").hint("merge"), "cell", "left_anti")
    out = cells.join(placed.hint("merge"), "cell", "left").join(at_cycle.hint("merge"), "cell", "left_anti")
    return out.select(F.coalesce("head", "cell").alias("head"), F.coalesce("place", F.lit(0)).alias("place"), "member")


def relax(s: DataFrame) -> DataFrame:
    """Adds the subclass axioms that follow from equivalences: a named class that is equivalent to a blank expression is a
    subclass of it, or of each member where it is an intersection, in which intersections may be nested. To be done before
    ``reduce``, which drops equivalences. Equivalences of two named classes, and of blank ones, give nothing. The statements are
    stored first, since they are read many times over.
    """
    s = shared_table(s, "relax-statements")
    blank = F.col("subject").startswith("_:")
    of = shared_table(s.where("predicate = 'owl:intersectionOf'").select(F.col("subject").alias("node"), F.col("object").alias("head")).join(list_members(s).hint("merge"), "head").select("node", "member").distinct(), "intersections")
    start = s.where((F.col("predicate") == "owl:equivalentClass") & (blank != F.col("object").startswith("_:")))
    now = start.select(F.when(blank, F.col("object")).otherwise(F.col("subject")).alias("subject"), F.when(blank, F.col("subject")).otherwise(F.col("object")).alias("node")).distinct()
    intersections = of.select("node").distinct()
    whole, seen, now = [], None, shared_table(now, "relax")
    while not now.isEmpty():  # a round for each level of nesting
        whole.append(now.join(intersections.hint("merge"), "node", "left_anti"))
        seen = now if seen is None else shared_table(seen.union(now), "relax-seen")
        opened = now.join(of.hint("merge"), "node").select("subject", F.col("member").alias("node")).distinct()
        now = shared_table(opened.join(seen.hint("merge"), ["subject", "node"], "left_anti"), "relax")
    if not whole:
        return s
    new = reduce(DataFrame.union, whole).where("subject <> node")
    return apply_rule(s, None, new.select("subject", F.lit("rdfs:subClassOf").alias("predicate"), F.col("node").alias("object")))
