"""Protein trees as statements: species roots, gene layer, receptors, others, metadata and fragments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rootline.functions.expressions import NAMES, Names, blank, lookup
from rootline.operators import statements as S
from rootline.operators.rank import case_variant_ids, mode

#: Names of receptor classes and of fragment types.
RECEPTORS = {"TCR": "T Cell Receptor", "BCR": "B Cell Receptor / Immunoglobulin", "MHC-I": "Major Histocompatibility Complex I", "MHC-II": "Major Histocompatibility Complex II"}
FRAGMENTS = {"Chain": "mature protein", "Peptide": "peptide", "Propeptide": "propeptide", "Signal": "signal peptide", "Transit peptide": "transit peptide"}


def split_parents(assigned: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows with one parent for each source by the deterministic mode: (normal, receptors, others)."""
    best = mode(assigned.select("Source Accession", "Assigned Protein ID"), ["Source Accession"], "Assigned Protein ID").withColumnRenamed("Assigned Protein ID", "_best")
    one = assigned.join(best, "Source Accession").where(F.col("Assigned Protein ID").eqNullSafe(F.col("_best"))).drop("_best")
    one = _one_of(one, ["Source Accession", "Assigned Protein ID"])
    receptor = ~blank(F.col("ARC Assignment"))
    known = F.col("Assigned Protein ID").isNotNull()
    return one.where(~receptor & known), one.where(receptor), one.where(~receptor & ~known)


def _one_of(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row of each key, the same however the rows are dealt: that with the least hash of all its columns."""
    order = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), order).alias("_row")).select("_row.*")


def _protein(pid: Column, parent: Column) -> list[Column]:
    node = F.concat(F.lit("UP:"), pid)
    return S.owl_class(node, F.concat("Assigned Protein Name", F.lit(" (UniProt:"), pid, F.lit(")")), parent)


def metadata(rows: DataFrame) -> DataFrame:
    """Canonical flag, synonyms, accession, address and database of each protein."""
    p = rows.where("`Assigned Protein ID` is not null")
    p = _one_of(p, ["Assigned Protein ID"])
    pid = F.col("Assigned Protein ID")
    node = F.concat(F.lit("UP:"), pid)
    canonical = F.when(F.coalesce("Assigned Protein Review Status", F.lit(False)) & ~pid.contains("-"), "true").otherwise("false")
    synonyms = F.filter(F.split(F.coalesce("Assigned Protein Synonyms", F.lit("")), ", "), lambda x: (x != "") & ~x.contains("@") & ~x.contains("{"))
    fixed = [
        S.triple(node, "ONTIE:0003673", canonical, "xsd:boolean"), S.triple(node, "ONTIE:0003623", pid, S.STRING),
        S.triple(node, "ONTIE:0003624", F.concat(F.lit("http://www.uniprot.org/uniprot/"), pid), S.STRING), S.triple(node, "ONTIE:0003625", "UniProt", S.STRING),
    ]
    return S.emit(p, fixed, [F.transform(synonyms, lambda x: S.triple(node, "ONTIE:0003622", x, S.STRING))]).unionByName(fragments(p))


def fragments(rows: DataFrame) -> DataFrame:
    """A node for each fragment of proteins with at least two: with both ends, not the whole protein. Fragments without an id
    are numbered in order, and only those that get a node take a number."""
    pid = F.col("Assigned Protein ID")
    listed = F.filter("Assigned Protein Fragments", lambda f: f["start"].isNotNull() & f["end"].isNotNull() & ~((f["start"] == 1) & (f["end"] == F.col("Assigned Protein Length"))))
    p = rows.where(F.size("Assigned Protein Fragments") > 1).select(pid, "Assigned Protein Name", listed.alias("fs"))

    def named(f: Column, i: Column) -> Column:
        kind = lookup(f["type"], FRAGMENTS)
        kind = F.when((kind == "mature protein") & ~blank(f["description"]) & (f["description"] != F.col("Assigned Protein Name")), F.concat(kind, F.lit(" ("), f["description"], F.lit(")"))).otherwise(kind)
        nth = F.size(F.filter(F.slice("fs", F.lit(1), i + 1), lambda x: x["feature_id"] == "N/A"))
        fid = F.when(f["feature_id"] == "N/A", F.concat(F.lit("fragment-"), nth.cast("string"))).otherwise(f["feature_id"])
        span = F.concat(F.lit(" ("), f["start"].cast("string"), F.lit("-"), f["end"].cast("string"), F.lit(")"))
        return F.struct(F.concat(F.lit("UP:"), pid, F.lit("-"), fid).alias("node"), F.concat(kind, span).alias("label"), F.concat(fid, F.lit(" "), kind, span).alias("long"), f["start"].alias("start"), f["end"].alias("end"))

    x = p.select(pid, F.explode(F.transform("fs", named)).alias("f")).select(pid, "f.*")
    node = F.col("node")
    return S.emit(x, [
        *S.owl_class(node, F.col("label"), F.concat(F.lit("UP:"), pid)), S.triple(node, "ONTIE:0003627", F.col("start"), "xsd:integer"),
        S.triple(node, "ONTIE:0003628", F.col("end"), "xsd:integer"), S.triple(node, "ONTIE:0003620", F.col("long"), S.STRING),
    ])


def _gene() -> Column:
    return F.replace(F.coalesce(F.nullif("Source Assigned Gene", F.lit("")), F.lit("Unknown")), F.lit("\\"), F.lit("-"))


def normal(rows: DataFrame, gene_layer: bool = True, names: Names = NAMES, order: str = "Source Accession") -> DataFrame:
    """Proteins under their species, or under gene nodes; symbols that differ in case only get '_dupN' in first-seen order."""
    species = F.concat(F.lit(names.protein), F.col("Species Taxon ID").cast("string"))
    if not gene_layer:
        return S.emit(rows, _protein(F.col("Assigned Protein ID"), species)).unionByName(metadata(rows)).distinct()
    g = rows.withColumn("gene", _gene())
    ids = case_variant_ids(g, "Species Taxon ID", "gene", order)
    suffix = F.when((F.col("variant") > 0) & (F.col("gene") != "Unknown"), F.concat(F.lit("_dup"), F.col("variant").cast("string"))).otherwise("")
    ids = ids.withColumn("node", F.concat(species, F.lit("-"), "gene", suffix))
    nodes = S.emit(ids, [*S.owl_class(F.col("node"), F.concat(F.lit("Gene: "), "gene"), species), S.triple(F.col("node"), "ONTIE:0003674", F.col("gene"), S.STRING)])
    proteins = S.emit(g.join(ids.select("Species Taxon ID", "gene", "node"), ["Species Taxon ID", "gene"]), _protein(F.col("Assigned Protein ID"), F.col("node")))
    return nodes.unionByName(proteins).unionByName(metadata(rows)).distinct()


def receptors(rows: DataFrame, names: Names = NAMES) -> DataFrame:
    """Receptor class nodes, gene nodes in capitals below them, and the proteins; a source without a protein gives no protein node."""
    kind = F.split_part("ARC Assignment", F.lit("_"), F.lit(1))
    species = F.concat(F.lit(names.protein), F.col("Species Taxon ID").cast("string"))
    # '-ig' keeps the class apart from genes of the same name
    r = rows.withColumn("kind", kind).withColumn("top", F.concat(species, F.lit("-"), F.lower("kind"), F.when(F.col("kind") == "BCR", "-ig").otherwise("")))
    r = r.withColumn("gene", F.upper(_gene())).withColumn("node", F.concat("top", F.lit("-"), "gene"))
    tops = S.emit(r, S.owl_class(F.col("top"), F.concat(lookup(F.col("kind"), RECEPTORS), F.lit(" chain")), species))
    genes = S.emit(r, S.owl_class(F.col("node"), F.concat(F.lit("Gene: "), "gene"), F.col("top")))
    proteins = S.emit(r, _protein(F.col("Assigned Protein ID"), F.col("node")))
    return tops.unionByName(genes).unionByName(proteins).unionByName(metadata(r)).distinct()


def others(rows: DataFrame, names: Names = NAMES) -> DataFrame:
    """Sources without a protein, in one bucket for each species."""
    species = F.concat(F.lit(names.protein), F.col("Species Taxon ID").cast("string"))
    bucket = F.concat(species, F.lit("-other"))
    node = F.concat(F.when(F.col("Database") == "UniProt", "UP:").otherwise("NCBI:"), "Source Accession")
    label = F.concat("Name", F.lit(" ["), "Source Accession", F.lit("]"))
    return S.emit(rows, [*S.owl_class(bucket, F.concat(F.lit("Other "), "Species Name", F.lit(" protein")), species), *S.owl_class(node, label, bucket)]).distinct()


def species_layer(organisms: DataFrame, names: Names = NAMES, roots: tuple[str, ...] = ("OBI:0100026",), top: str = "PR:000000001") -> DataFrame:
    """The organism tree without lower taxa, as protein nodes under the protein root."""
    kept = S.prune(organisms)
    kept = S.reparent(kept, list(roots), top)
    label = F.when(F.col("predicate") == "rdfs:label", F.concat("object", F.lit(" protein"))).otherwise(F.col("object"))
    return S.renumber(kept.withColumn("object", label), [names.public, names.local], names.protein)


def build(organisms: DataFrame, assigned: DataFrame, gene_layer: bool = True, names: Names = NAMES) -> DataFrame:
    """The whole protein tree."""
    a, b, c = split_parents(assigned)
    parts = [species_layer(organisms, names), normal(a, gene_layer, names), receptors(b, names), others(c, names)]
    out = parts[0].select(*S.SCHEMA.names)
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()
