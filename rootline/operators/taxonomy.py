"""Taxonomy dumps to statements; assembling the organism tree; active species and their groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rootline.functions.expressions import NAMES, Names, curie, lookup, slug, taxon_id
from rootline.operators import graph
from rootline.operators.rank import top1
from rootline.operators.shared import shared_table
from rootline.operators.statements import STRING, emit, triple

_EXACT, _BROAD, _RELATED = "oio:hasExactSynonym", "oio:hasBroadSynonym", "oio:hasRelatedSynonym"

#: Name classes and their synonym predicates.
SYNONYM_PREDICATES = {
    "acronym": _BROAD, "anamorph": _RELATED, "blast name": _RELATED, "common name": _EXACT, "equivalent name": _EXACT, "genbank acronym": _BROAD,
    "genbank anamorph": _RELATED, "genbank common name": _EXACT, "genbank synonym": _RELATED, "in-part": _RELATED, "misnomer": _RELATED,
    "misspelling": _RELATED, "synonym": _RELATED, "scientific name": _EXACT, "teleomorph": _RELATED,
}
#: Ranks above and below species.
UPPER = ["clade", "class", "family", "genus", "infraorder", "kingdom", "order", "parvorder", "phylum", "species_group", "subclass", "subfamily", "suborder", "subphylum", "superclass", "superkingdom"]
LOWER = ["biotype", "cohort", "section", "series", "serogroup", "serotype", "strain", "subcohort", "subsection", "subspecies", "subtribe", "tribe", "varietas"]
#: Synonym types by preference, with the label source they give.
LABEL_SYNONYMS = {"common name": "NCBI Taxonomy common name", "GenBank common name": "GenBank common name", "equivalent name": "NCBI Taxonomy equivalent name"}


def level(rank: Column) -> Column:
    return F.when(rank == "species", "species").when(rank.isin(UPPER), "upper").when(rank.isin(LOWER), "lower")


def _listed(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    return df.groupBy(F.col(key).alias("tax_id")).agg(F.array_sort(F.collect_set(value)).alias(name))


def dump_statements(nodes: DataFrame, names: DataFrame, merged: DataFrame, citations: DataFrame) -> DataFrame:
    """The statements of every taxon: label, parent, rank, genetic code, alternative ids, citations and typed synonyms.

    Labels are scientific names; one that several taxa share takes the unique form where there is one.
    """
    scientific = names.where("name_class = 'scientific name'")
    shared = scientific.groupBy("name").agg(F.countDistinct("tax_id").alias("_n"))
    labels = scientific.join(shared, "name").select("tax_id", F.when((F.col("_n") > 1) & (F.col("unique") != ""), F.col("unique")).otherwise(F.col("name")).alias("label"))
    labels = labels.groupBy("tax_id").agg(F.min("label").alias("label"))
    pmids = citations.where("pubmed_id not in ('', '0')").select(F.explode(F.split(F.trim("tax_id_list"), r"\s+")).alias("t"), "pubmed_id").where("t <> ''")
    syn = names.where("name_class <> 'scientific name'").select("tax_id", F.struct("name_class", "name").alias("s"))
    syn = syn.groupBy("tax_id").agg(F.array_sort(F.collect_set("s")).alias("synonyms"))
    t = nodes.join(labels, "tax_id", "left").join(_listed(merged, "new_tax_id", "old_tax_id", "old"), "tax_id", "left").join(_listed(pmids, "t", "pubmed_id", "pmids"), "tax_id", "left").join(syn, "tax_id", "left")
    s = F.concat(F.lit(NAMES.public), "tax_id")
    rank = F.regexp_replace(F.lower("rank"), r"\W+", "_")
    ranked = F.when(rank.isin("species_group", "species_subgroup"), F.concat(F.lit("<http://purl.obolibrary.org/obo/NCBITaxon#_"), rank, F.lit(">"))).otherwise(F.concat(F.lit(NAMES.public), rank))
    has = lambda c: F.nullif(F.col(c), F.lit(""))
    fixed = [
        triple(s, "rdf:type", "owl:Class"), triple(s, "rdfs:label", F.col("label"), STRING),
        triple(s, "rdfs:subClassOf", F.when(F.col("parent_tax_id") != F.col("tax_id"), F.concat(F.lit(NAMES.public), has("parent_tax_id")))),
        triple(s, "ncbitaxon:has_rank", F.when((F.col("rank") != "no rank") & (F.col("rank") != ""), ranked)),
        triple(s, "oio:hasDbXref", F.concat(F.lit("GC_ID:"), has("genetic_code_id")), STRING), triple(s, "oio:hasOBONamespace", "ncbi_taxonomy", STRING),
    ]
    none = F.array().cast("array<string>")
    kind = lambda x: F.replace(x["name_class"], F.lit("genbank"), F.lit("GenBank"))
    note = lambda x: F.concat(F.lit('{"oio:hasSynonymType":[{"datatype":"xsd:string","meta":"owl:Axiom","object":"'), kind(x), F.lit('"}]}'))
    more = [
        F.transform(F.coalesce("old", none), lambda x: triple(s, "oio:hasAlternativeId", F.concat(F.lit(NAMES.public), x), STRING)),
        F.transform(F.coalesce("pmids", none), lambda x: triple(s, "oio:hasDbXref", F.concat(F.lit("PMID:"), x), STRING)),
        F.transform(F.filter(F.coalesce("synonyms", F.array().cast("array<struct<name_class:string,name:string>>")), lambda x: x["name_class"].isin(*SYNONYM_PREDICATES)), lambda x: triple(s, lookup(x["name_class"], SYNONYM_PREDICATES), x["name"], STRING, note(x))),
    ]
    return emit(t, fixed, more)


def synonym_type(annotation: Column) -> Column:
    return F.get_json_object(annotation, "$['oio:hasSynonymType'][0].object")


def best_labels(statements: DataFrame) -> DataFrame:
    """(subject, label, label_source): the label, with the best typed synonym in parentheses where there is one."""
    label = statements.where("predicate = 'rdfs:label'").select("subject", F.col("object").alias("label"))
    order = F.array_position(F.array(*map(F.lit, LABEL_SYNONYMS)), F.col("kind"))
    syn = statements.where("annotation is not null").select("subject", "object", synonym_type(F.col("annotation")).alias("kind")).where(F.col("kind").isin(*LABEL_SYNONYMS))
    best = syn.groupBy("subject").agg(F.min_by(F.struct("object", "kind"), F.struct(order, F.col("object"))).alias("b"))
    out = label.join(best, "subject", "left")
    return out.select("subject", F.when(F.col("b").isNull(), F.col("label")).otherwise(F.concat("label", F.lit(" ("), "b.object", F.lit(")"))).alias("label"), F.concat(F.lit("NCBI Taxonomy scientific name"), F.coalesce(F.concat(F.lit(" ("), lookup(F.col("b.kind"), LABEL_SYNONYMS), F.lit(")")), F.lit(""))).alias("label_source"))


def first_writer(frames: list[DataFrame], key: str = "curie") -> DataFrame:
    """The rows of several tables, earlier ones first; a key that an earlier table has stays as that one has it."""
    out = None
    for i, f in enumerate(frames):
        f = f.withColumn("_priority", F.lit(i))
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return top1(out, [key], [F.col("_priority")]).drop("_priority")


def assemble(core: DataFrame, local_taxa: DataFrame, include: DataFrame, counts: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """The organism tree's rows: curated ones, then local taxa, then the included and the active public taxa with all their
    ancestors up to a curated node; labels and ranks from the taxonomy; epitope counts where a taxon has some.

    core, local_taxa (curie, label, label_source, parent, parent2, level); include (curie); counts (curie, epitope_count).
    """
    up = graph.first_parents(taxonomy.where("predicate = 'rdfs:subClassOf'").select(F.col("subject").alias("child"), F.col("object").alias("parent")))
    have = core.select("curie").union(local_taxa.select("curie")).distinct()
    wanted = include.select("curie").union(counts.select("curie")).union(local_taxa.select(F.col("parent").alias("curie"))).where("curie is not null").distinct()
    cut = up.join(have.withColumnRenamed("curie", "child"), "child", "left_anti")  # walks end at rows that are already there
    nodes = graph.reachable(cut, wanted.withColumnRenamed("curie", "node"), down=False).join(have.withColumnRenamed("curie", "node"), "node", "left_anti")
    ranks = taxonomy.where("predicate = 'ncbitaxon:has_rank'").groupBy("subject").agg(F.regexp_extract(F.min("object"), r"([a-z_]+)>?$", 1).alias("rank"))
    rows = nodes.withColumnRenamed("node", "subject").join(best_labels(taxonomy), "subject", "left").join(ranks, "subject", "left").join(up.withColumnRenamed("child", "subject"), "subject", "left")
    rows = rows.select(F.col("subject").alias("curie"), "label", "label_source", "rank", "parent", level(F.ltrim(F.col("rank"), F.lit("_"))).alias("level"))
    return first_writer([core, local_taxa, rows]).join(counts, "curie", "left")


def assembly_problems(core: DataFrame, local_taxa: DataFrame, use_other: DataFrame, rows: DataFrame, root: str = "NCBITaxon:1", names: Names = NAMES) -> DataFrame:
    """(curie, problem, detail) of an assembled tree: a node marked use_other (curie) without its 'other' child, a local taxon
    whose label differs from the curated one, rows without a label, and rows without a parent but the root."""
    at = lambda df, problem, detail: df.select("curie", F.lit(problem).alias("problem"), detail.alias("detail"))
    other = F.concat(F.lit(names.local), taxon_id(F.col("curie"), names), F.lit("-other"))
    have = rows.select(F.col("curie").alias("_other")).distinct()
    out = at(use_other.withColumn("_other", other).join(have, "_other", "left_anti"), "missing-other", other)
    both = local_taxa.select("curie", F.col("label").alias("_label")).join(core.select("curie", "label"), "curie").where("not (label <=> _label)")
    out = out.unionByName(at(both, "label", F.concat("label", F.lit(" / "), "_label")))
    blank_ = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    out = out.unionByName(at(rows.where(blank_("label")), "no-label", F.lit(None).cast("string")))
    return out.unionByName(at(rows.where(blank_("parent") & (F.col("curie") != root)), "no-parent", F.col("label")))


def checked_assembly(problems: DataFrame) -> None:
    """Raises if a node lacks its 'other' child; the first of them by name is told."""
    first = problems.where("problem = 'missing-other'").agg(F.min("curie").alias("curie")).first().curie
    if first is not None:
        raise ValueError(f"missing 'other' node for {first}")


def with_species(rows: DataFrame, edges: DataFrame, labels: DataFrame) -> DataFrame:
    """The tree's rows with species and species_label, and rows for species that the tree lacks.

    rows (curie, label, level); edges (child, parent) of the taxonomy, with single parents; labels (subject, label, label_source,
    rank). A row that is a species is its own; an upper row has none; else the nearest taxon above of rank species, and
    the row is lower.
    """
    species = labels.where("rank = 'species'").select(F.col("subject").alias("node"))
    own = rows.where("level = 'species'").select(F.col("curie").alias("node"))
    above = graph.nearest(edges, species.union(own).distinct())
    found = rows.join(above.select(F.col("node").alias("curie"), F.col("found").alias("_above")), "curie", "left")
    mine = F.when(F.col("level") == "species", F.col("curie")).when(F.coalesce("level", F.lit("")) == "upper", None).otherwise(F.col("_above"))
    found = shared_table(found.withColumn("species", mine).drop("_above"), "species")
    found = found.withColumn("level", F.when(F.col("species") != F.col("curie"), "lower").otherwise(F.col("level")))
    missing = found.select(F.col("species").alias("curie")).where("curie is not null").distinct().join(rows.select("curie"), "curie", "left_anti")
    add = missing.join(labels.select(F.col("subject").alias("curie"), "label", "label_source"), "curie", "left").withColumns({"level": F.lit("species"), "species": F.col("curie")})
    every = found.unionByName(add, allowMissingColumns=True)
    named = rows.select(F.col("curie").alias("species"), F.col("label").alias("_tree")).join(labels.select(F.col("subject").alias("species"), F.col("label").alias("_taxonomy")), "species", "full")
    return every.join(named.select("species", F.coalesce("_tree", "_taxonomy").alias("species_label")), "species", "left")


def species_of(edges: DataFrame, levels: DataFrame, use_other: DataFrame, names: Names = NAMES) -> tuple[DataFrame, DataFrame]:
    """(node, found) twice: each node's nearest species above it, and its nearest parent in the tree, sent to that one's
    'other' child where it is marked use_other (node). Only first parents count."""
    tree = graph.first_parents(edges)
    species = graph.nearest(tree, levels.where("level = 'species'").select(F.col("curie").alias("node")))
    other = F.concat(F.lit(names.local), taxon_id(F.col("found"), names), F.lit("-other"))
    parents = graph.redirect_other(graph.nearest(tree, levels.select(F.col("curie").alias("node"))), use_other, other)
    return species, parents


def tree_statements(rows: DataFrame, names: Names = NAMES) -> DataFrame:
    """Up to twelve statements for each row of the organism tree and one for each synonym."""
    c = F.col("curie")
    number = F.nullif(F.when(c.startswith(names.public) | c.startswith(names.local), taxon_id(c, names)), F.lit(""))
    own = names.local
    col = lambda n: F.nullif(F.col(n).cast("string"), F.lit("")) if n in rows.columns else F.lit(None).cast("string")
    fixed = [
        triple(c, "rdf:type", "owl:Class"), triple(c, "rdfs:label", col("label"), STRING), triple(c, own + "label-source", col("label_source"), STRING),
        triple(c, own + "level", col("level"), STRING), triple(c, own + "source-table", col("source_table"), STRING), triple(c, "ONTIE:0003615", number, STRING),
        triple(c, "ONTIE:0003616", F.when(c.startswith(names.public), F.concat(F.lit("http://www.ncbi.nlm.nih.gov/Taxonomy/Browser/wwwtax.cgi?id="), number))),
        triple(c, own + "epitope-count", col("epitope_count"), "xsd:integer"), triple(c, "ONTIE:0003618", F.when(col("epitope_count").isNotNull(), "true"), "xsd:boolean"),
        triple(c, "ONTIE:0003617", col("rank"), STRING), triple(c, "rdfs:subClassOf", col("parent")), triple(c, "rdfs:subClassOf", col("parent2")),
    ]
    synonyms = F.transform(F.filter(F.split(F.coalesce(col("synonyms"), F.lit("")), r"\s*;\s*"), lambda x: x != ""), lambda x: triple(c, _EXACT, F.trim(x), STRING))
    return emit(rows, fixed, [synonyms])


def peptide_counts(peptides: DataFrame) -> DataFrame:
    """(curie, epitope_count): all rows of each organism."""
    return peptides.groupBy(curie(F.col("Organism ID").cast("long")).alias("curie")).agg(F.count(F.lit(1)).alias("epitope_count"))


#: The groups of taxa, tested in this order by an ancestor.
ORGANISM, ARCHAEA, BACTERIA, VIRUSES, EUKARYOTES, PLANTS, VERTEBRATES = "OBI:0100026", "NCBITaxon:2157", "NCBITaxon:2", "NCBITaxon:10239", "NCBITaxon:2759", "NCBITaxon:58024", "NCBITaxon:7742"


def groups(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, group) by the ancestors of each node."""
    up = graph.closure(edges, seeds=nodes, down=False)
    has = lambda x: F.bool_or(F.col("ancestor") == x).alias(x)
    flags = up.groupBy("node").agg(*[has(x) for x in (ORGANISM, ARCHAEA, BACTERIA, VIRUSES, EUKARYOTES, PLANTS, VERTEBRATES)])
    of = lambda x: F.col(f"`{x}`")
    group = (
        F.when(~of(ORGANISM), "other").when(of(ARCHAEA), "archeobacterium").when(of(BACTERIA), "bacterium").when(of(VIRUSES), "virus")
        .when(of(EUKARYOTES) & of(PLANTS), "plant").when(of(EUKARYOTES) & of(VERTEBRATES), "vertebrate").when(of(EUKARYOTES), "other-eukaryote")
    )
    return flags.select("node", group.alias("group"))


#: Taxa that count as active in a species that isn't above them.
ALSO_ACTIVE = {10002316: 694009}


def active_species(edges: DataFrame, species: DataFrame, counts: DataFrame, names: Names = NAMES) -> DataFrame:
    """Species with epitopes: id, key, label, active taxa ('1, 2' in numeric order), group and the sum over the active taxa.

    species (node, label); counts (curie, epitope_count). Ids that aren't numbers (like '...-other') stay out of the ids.
    """
    pairs = graph.closure(edges, seeds=species.select("node"))
    number = lambda c: F.regexp_replace(c, f"^(?:{names.public}|{names.local})", "").try_cast("long")
    active = pairs.join(counts.withColumnRenamed("curie", "node"), "node").select("ancestor", number(F.col("node")).alias("id"), "epitope_count").where("id is not null")
    more = species.select(F.col("node").alias("ancestor"), lookup(number(F.col("node")), ALSO_ACTIVE).cast("long").alias("id")).where("id is not null")
    more = more.join(counts.select(number(F.col("curie")).alias("id"), "epitope_count"), "id", "left").select("ancestor", "id", F.coalesce("epitope_count", F.lit(0)).alias("epitope_count"))
    active = active.unionByName(more)
    summed = active.groupBy("ancestor").agg(F.array_join(F.transform(F.array_sort(F.collect_set("id")), lambda x: x.cast("string")), ", ").alias("Active Taxa"), F.sum("epitope_count").alias("Epitope Count"))
    out = summed.withColumnRenamed("ancestor", "node").join(species, "node").join(groups(edges, species.select("node")), "node", "left")
    number = taxon_id(F.col("node"), names).try_cast("long")
    key = F.concat_ws("-", number.cast("string"), slug(F.col("label")))
    return out.select(key.alias("Species Key"), number.alias("Species ID"), F.col("label").alias("Species Label"), "Active Taxa", F.col("group").alias("Group"), "Epitope Count")


def subspecies(tree: DataFrame, taxonomy: DataFrame, graph_name: str = "subspecies") -> DataFrame:
    """The tree with all descendants of its species that it lacks, and each descendant's species (ONTIE:0003619)."""
    edge = lambda s: s.where("predicate = 'rdfs:subClassOf'").select(F.col("subject").alias("child"), F.col("object").alias("parent"))
    species = tree.where(F.col("predicate").endswith("level") & (F.col("object") == "species")).select(F.col("subject").alias("node")).distinct()
    below = graph.closure(edge(taxonomy).union(edge(tree)), seeds=species)
    new = below.select(F.col("node").alias("subject")).distinct().join(tree.select("subject").distinct(), "subject", "left_anti")
    copied = taxonomy.join(new, "subject", "left_semi").select(*tree.columns)
    of = emit(below.where("node <> ancestor"), [triple(F.col("node"), "ONTIE:0003619", F.col("ancestor"))])
    return tree.unionByName(copied).unionByName(of.select(*tree.columns)).withColumn("graph", F.lit(graph_name))


def header(properties: dict[str, str]) -> list[Column]:
    """Annotation properties with their labels."""
    return [t for p, label in properties.items() for t in (triple(p, "rdf:type", "owl:AnnotationProperty"), triple(p, "rdfs:label", label, STRING))]


