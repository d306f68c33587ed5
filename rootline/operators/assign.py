"""Assigning sources and peptides their parent protein. All species go through one plan, keyed by species_taxon_id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rootline.functions.expressions import union_sorted
from rootline.operators.rank import top1
from rootline.operators.sequences import peptide_join, residue_match
from rootline.operators.shared import shared_table
from rootline.sources.schemas import ASSIGNMENT_COLUMNS

#: The order in which kinds of proteomes are preferred.
PROTEOME_TYPES = ["Reference and representative proteome", "Representative proteome", "Reference proteome", "Other proteome", "Non Reference proteome", "Redundant proteome"]


def bare_subject(subject: Column) -> Column:
    """'sp|P1|X' -> 'P1'; a bare id stays."""
    return F.when(subject.contains("|"), F.split_part(subject, F.lit("|"), F.lit(2))).otherwise(subject)


def alignment_score(alignments: DataFrame, source_lengths: DataFrame) -> DataFrame:
    """alignments with Score = alignment length * identity / query length; it may exceed 100 with gaps."""
    n = source_lengths.select(F.col("Source Accession").alias("Query"), F.col("Length").alias("_len"))
    return alignments.join(n.hint("merge"), "Query", "left").withColumn("Subject", bare_subject(F.col("Subject"))).withColumn("Score", F.try_divide(F.col("Alignment Length") * F.col("% Identity"), F.col("_len"))).drop("_len")


def top_proteins(sources: DataFrame, alignments: DataFrame, proteome: DataFrame, nulls_first: bool = True) -> DataFrame:
    """(Source Accession, Subject, Score, gene) for every source: the best subject by score, then reviewed, then id.

    nulls_first ranks a subject that the proteome lacks before others, as the legacy order does. Both sides of each join grow
    with the tables, so none is broadcast: a compressed file looks far smaller than its rows.
    """
    p = proteome.select(F.col("Protein ID").alias("Subject"), "Gene", (F.col("Database") == "sp").alias("reviewed"))
    scored = alignment_score(alignments, sources).join(p.hint("merge"), "Subject", "left")
    reviewed = F.col("reviewed").desc_nulls_first() if nulls_first else F.col("reviewed").desc_nulls_last()
    best = top1(scored, ["Query"], [F.col("Score").desc_nulls_last(), reviewed, F.col("Subject")])
    best = best.select(F.col("Query").alias("Source Accession"), F.col("Subject").alias("Source Assigned Protein ID"), F.col("Score").alias("Source Alignment Score"), F.col("Gene").alias("Source Assigned Gene"))
    return sources.select("Source Accession").distinct().join(best.hint("merge"), "Source Accession", "left")


def override(assigned: DataFrame, manual: DataFrame) -> DataFrame:
    """Manual parents (Accession, Parent Accession) replace what was found; their score is null."""
    m = manual.select(F.col("Accession").alias("Source Accession"), F.col("Parent Accession").alias("_manual")).groupBy("Source Accession").agg(F.min("_manual").alias("_manual"))
    hit = F.col("_manual").isNotNull()
    out = assigned.join(m, "Source Accession", "left")
    return out.withColumns({"Source Assigned Protein ID": F.coalesce("_manual", "Source Assigned Protein ID"), "Source Alignment Score": F.when(~hit, F.col("Source Alignment Score"))}).drop("_manual")


def receptor_label() -> Column:
    """class_chain_allele without what is null; null if all are."""
    return F.nullif(F.concat_ws("_", "class", "chain_type", "calc_mhc_allele"), F.lit(""))


def unclassified(sources: DataFrame, known: DataFrame, skip: str = "SRC") -> DataFrame:
    """Sources whose accession isn't in the stored classifier results, those with a marker left out: only these are classified."""
    return sources.where(~F.col("Source Accession").contains(skip)).join(known.select(F.col("id").alias("Source Accession")).distinct(), "Source Accession", "left_anti")


def with_receptors(assigned: DataFrame, classified: DataFrame, vertebrate: Column | None = None) -> DataFrame:
    c = classified.select(F.col("id").alias("Source Accession"), receptor_label().alias("ARC Assignment")).groupBy("Source Accession").agg(F.min("ARC Assignment").alias("ARC Assignment"))
    out = assigned.join(c, "Source Accession", "left")
    return out if vertebrate is None else out.withColumn("ARC Assignment", F.when(vertebrate, F.col("ARC Assignment")))


def peptide_parents(peptides: DataFrame, proteome: DataFrame, assigned: DataFrame, k: int = 5) -> DataFrame:
    """peptides (Sequence, Source Accession, ...) with Assigned Protein ID and positions.

    Matches are joined with what the peptide's sources were assigned: by gene (many-to-one, the source proteins reduced to
    a set first) or by the very protein. The winner of a sequence has gene priority, is the source's protein, is reviewed,
    has the lowest existence level, then the least id and position. It is joined back by gene, else by protein; peptides
    that get nothing fall back to their source's protein without positions. No side that grows with the tables is broadcast.
    """
    src = shared_table(peptides.join(assigned.hint("merge"), "Source Accession", "left"), "peptide-sources")
    p = proteome.select(F.col("Protein ID").alias("protein"), F.nullif("Gene", F.lit("")).alias("gene"), (F.col("Database") == "sp").alias("reviewed"), F.col("Protein Existence Level").cast("int").alias("level"),
                        (F.col("Gene Priority").cast("int") if "Gene Priority" in proteome.columns else F.lit(None).cast("int")).alias("priority"))
    hits = peptide_join(src.select("Sequence"), "Sequence", proteome, "Protein ID", "Sequence", k).withColumnRenamed("query", "Sequence").join(p.hint("merge"), "protein")
    genes = src.where("`Source Assigned Gene` is not null").select("Sequence", F.col("Source Assigned Gene").alias("gene"), F.col("Source Assigned Protein ID").alias("protein"))
    own = genes.where("protein is not null").distinct().withColumn("same", F.lit(True))
    by_gene = hits.join(genes.select("Sequence", "gene").distinct().hint("merge"), ["Sequence", "gene"]).join(own.hint("merge"), ["Sequence", "gene", "protein"], "left").withColumn("same", F.coalesce("same", F.lit(False)))
    exact = src.where("`Source Assigned Protein ID` is not null").select("Sequence", F.col("Source Assigned Protein ID").alias("protein")).distinct()
    by_protein = hits.join(exact.hint("merge"), ["Sequence", "protein"])
    tail = [F.col("reviewed").desc_nulls_first(), F.col("level").asc_nulls_first(), F.col("protein"), F.col("start"), F.col("end")]
    gene_best = top1(by_gene, ["Sequence", "gene"], [F.col("priority").desc_nulls_last(), F.col("same").desc_nulls_first(), *tail])
    gene_best = top1(gene_best, ["Sequence"], [F.col("priority").desc_nulls_last(), F.col("same").desc_nulls_first(), *tail])
    protein_best = top1(by_protein, ["Sequence"], [F.col("priority").desc_nulls_last(), *tail])
    g = gene_best.select("Sequence", F.col("gene").alias("Source Assigned Gene"), F.col("protein").alias("_gp"), F.col("start").alias("_gs"), F.col("end").alias("_ge"))
    x = protein_best.select("Sequence", F.col("protein").alias("Source Assigned Protein ID"), F.col("start").alias("_ps"), F.col("end").alias("_pe"))
    out = src.join(g, ["Sequence", "Source Assigned Gene"], "left").join(x, ["Sequence", "Source Assigned Protein ID"], "left")
    return out.select(*[F.col(f"`{c}`") for c in src.columns], F.coalesce("_gp", "Source Assigned Protein ID").alias("Assigned Protein ID"), F.coalesce("_gs", "_ps").alias("Assigned Protein Starting Position"), F.coalesce("_ge", "_pe").alias("Assigned Protein Ending Position"))


def one_row_per_source(assigned: DataFrame) -> DataFrame:
    """One row for each (Sequence, Source Accession): that with the least Epitope ID."""
    return top1(assigned, ["Sequence", "Source Accession"], [F.col("Epitope ID").asc_nulls_last()])


def protein_data(assigned: DataFrame, proteome: DataFrame, fragments: DataFrame, synonyms: DataFrame, manual: DataFrame) -> DataFrame:
    """Adds name, entry, review status, sequence, length, fragments (array) and synonyms of the assigned protein.

    fragments (protein_id, value: array of structs); synonyms (protein_id, value: array of text); manual (Accession, Synonyms).
    """
    p = proteome.select(F.col("Protein ID").alias("Assigned Protein ID"), F.col("Protein Name").alias("Assigned Protein Name"), F.col("Entry Name").alias("Assigned Protein Entry Name"), (F.col("Database") == "sp").alias("Assigned Protein Review Status"),
                        F.col("Sequence").alias("Assigned Protein Sequence"), F.length("Sequence").cast("long").alias("Assigned Protein Length"), F.nullif("Gene", F.lit("")).alias("_gene"))
    fr = fragments.select(F.col("protein_id").alias("Assigned Protein ID"), drop_overlapping_chain(F.col("value")).alias("Assigned Protein Fragments"))
    sy = synonyms.select(F.col("protein_id").alias("Assigned Protein ID"), F.col("value").alias("_syn"))
    ma = manual.groupBy(F.col("Accession").alias("Assigned Protein ID")).agg(F.flatten(F.collect_list(F.split("Synonyms", r",\s*"))).alias("_man"))
    out = assigned.join(p, "Assigned Protein ID", "left").join(fr, "Assigned Protein ID", "left").join(sy, "Assigned Protein ID", "left").join(ma, "Assigned Protein ID", "left")
    named = F.filter(F.array("_gene", "Assigned Protein Entry Name"), lambda x: x.isNotNull())
    return out.withColumn("Assigned Protein Synonyms", F.nullif(F.array_join(F.filter(union_sorted(F.col("_syn"), F.col("_man"), named), lambda x: x != ""), ", "), F.lit(""))).drop("_gene", "_syn", "_man")


def drop_overlapping_chain(fragments: Column) -> Column:
    """Where the first two fragments are chains from 1 and from 2 with one end, the second goes."""
    a, b = F.get(fragments, F.lit(0)), F.get(fragments, F.lit(1))
    twice = (a["type"] == "Chain") & (b["type"] == "Chain") & (a["start"] == 1) & (b["start"] == 2) & (a["end"] == b["end"])
    return F.when(twice, F.concat(F.slice(fragments, 1, 1), F.slice(fragments, F.lit(3), F.greatest(F.size(fragments) - 2, F.lit(0))))).otherwise(fragments)


def allergen_overlay(assigned: DataFrame, allergens: DataFrame, hits: DataFrame, least: float = 95.0) -> DataFrame:
    """Allergen names replace the assigned name where the protein is at least ``least`` % like one; of several the last by ordinal."""
    close = hits.where(F.col("% Identity") >= least).join(allergens.select(F.col("accession").alias("Subject"), "name", "ord"), "Subject")
    last = close.groupBy(F.col("Query").alias("Assigned Protein ID")).agg(F.max_by("name", "ord").alias("_allergen"))
    return assigned.join(last, "Assigned Protein ID", "left").withColumn("Assigned Protein Name", F.coalesce("_allergen", "Assigned Protein Name")).drop("_allergen")


def in_order(df: DataFrame) -> DataFrame:
    """The assignment columns in their fixed order; what is missing is null."""
    return df.select(*[F.col(f"`{c}`") if c in df.columns else F.lit(None).alias(c) for c in ASSIGNMENT_COLUMNS])


def coverage(peptides: DataFrame, tokens: Column, candidates: DataFrame, k: int = 5) -> DataFrame:
    """(Proteome ID, score): linear peptides found in a candidate plus discontinuous ones whose residues stand in one protein.

    peptides (Sequence); candidates (Proteome ID, Protein ID, Sequence).
    """
    ids = candidates.withColumn("_pid", F.concat_ws("\u0001", "Proteome ID", "Protein ID"))
    of = F.split_part("protein", F.lit("\u0001"), F.lit(1)).alias("Proteome ID")
    linear = peptide_join(peptides.where(~F.col("Sequence").rlike(r"\d")), "Sequence", ids, "_pid", "Sequence", k).select(of, F.col("query").alias("s")).distinct()
    listed = peptides.where(F.col("Sequence").rlike(r"\d")).select("Sequence", tokens.alias("tokens"))
    disc = residue_match(listed, "Sequence", "tokens", ids, "_pid", "Sequence").select(of, F.col("epitope").alias("s")).distinct()
    hit = linear.union(disc).groupBy("Proteome ID").agg(F.count(F.lit(1)).alias("score"))
    return candidates.select("Proteome ID").distinct().join(hit, "Proteome ID", "left").na.fill(0, ["score"])


def select_proteome(candidates: DataFrame, scores: DataFrame, many: int = 20, top: int = 200) -> DataFrame:
    """The proteome of each species: the first kind that it has; of more than ``many`` the best BUSCO score (if any has one),
    else the best coverage. Of equal ones the first listed (ord); where there are more than ``top``, only those with the
    most proteins are compared, in the order of their number."""
    at = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, PROTEOME_TYPES)), F.col("Proteome Type")), F.lit(0)), F.lit(99))
    c = candidates.withColumn("_at", at)
    first = c.groupBy("species_taxon_id").agg(F.min("_at").alias("_at"))
    c = c.join(first, ["species_taxon_id", "_at"])
    size = c.groupBy("species_taxon_id").agg(F.count(F.lit(1)).alias("_n"), F.max(F.col("BUSCO Score").isNotNull()).alias("_busco"))
    c = c.join(size, "species_taxon_id").join(scores, "Proteome ID", "left")
    by_busco = (F.col("_n") > many) & F.col("_busco")
    busco = top1(c.where(by_busco), ["species_taxon_id"], [F.col("BUSCO Score").desc_nulls_last(), F.col("ord").desc()])
    w = Window.partitionBy("species_taxon_id").orderBy(F.col("Protein Count").desc_nulls_first(), "ord")
    rest = c.where(~by_busco).withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= top).drop("_rn")
    best = top1(rest, ["species_taxon_id"], [F.coalesce("score", F.lit(0)).desc(), F.when(F.col("_n") > top, F.col("Protein Count")).desc_nulls_last(), F.col("ord")])
    return busco.unionByName(best).select("species_taxon_id", "Proteome ID", "Proteome Taxon ID", "Proteome Label", "Proteome Type")


