"""Mapping epitopes from their source to the parent protein: exact, by source alignment, by residues, or by local alignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rootline.functions.expressions import NAMES, Names, discontinuous, mark_mismatches, normal_residue_list
from rootline.operators.rank import mode, route
from rootline.operators.sequences import aligned

COLUMNS = [
    "epitope_id", "epitope_seq", "parent_accession", "source_accession", "tier", "parent_seq", "parent_start", "parent_end", "identity_alignment", "similarity_alignment",
    "gaps_source_alignment", "gaps_parent_alignment", "all_gaps", "source_alignment", "parent_alignment", "parent_alignment_modified", "source_start",
]


def tier() -> Column:
    """Which way a row goes: exact (its start in the parent is known, whatever its kind), linear or discontinuous by the
    source's alignment, local; rows without a parent, an id or, if discontinuous, a source sequence are dropped."""
    positions = F.col("source_start").isNotNull() & F.col("source_end").isNotNull()
    source, listed = F.col("source_sequence").isNotNull(), F.coalesce(discontinuous(F.col("epitope_seq")), F.lit(False))
    return route([
        ("dropped", F.col("parent_accession").isNull()), ("exact", F.col("parent_start").isNotNull()), ("dropped", F.col("epitope_id").isNull() | F.col("epitope_seq").isNull()),
        ("discontinuous", listed & source), ("dropped", listed), ("linear", positions & source),
    ], "local")


def position_map(a: Column, b: Column, start_b: Column | None = None) -> Column:
    """array of (src, pos, aa) over the columns of an alignment where the source has a residue; pos and aa are null at gaps."""
    x, y = F.split(a, ""), F.split(b, "")
    step = F.transform(F.arrays_zip(x.alias("s"), y.alias("p")), lambda c: F.struct((c["s"] != "-").cast("int").alias("s"), (c["p"] != "-").cast("int").alias("p"), c["p"].alias("aa")))
    first = F.struct(F.lit(0).alias("src"), (start_b - 1 if start_b is not None else F.lit(0)).cast("int").alias("pos"), F.array().cast("array<struct<src:int,pos:int,aa:string>>").alias("out"))
    walked = F.aggregate(step, first, lambda acc, c: F.struct(
        (acc["src"] + c["s"]).alias("src"), (acc["pos"] + c["p"]).alias("pos"),
        F.when(c["s"] == 1, F.concat(acc["out"], F.array(F.struct((acc["src"] + 1).alias("src"), F.when(c["p"] == 1, acc["pos"] + 1).alias("pos"), F.when(c["p"] == 1, c["aa"]).alias("aa"))))).otherwise(acc["out"]).alias("out"),
    ))
    return walked["out"]


def _fields(source: Column, parent: Column, start: Column, end: Column, identity: Column, gaps: Column) -> dict[str, Column]:
    return {
        "parent_seq": parent, "parent_start": start, "parent_end": end, "identity_alignment": identity, "similarity_alignment": identity, "gaps_source_alignment": F.lit(0.0),
        "gaps_parent_alignment": gaps, "all_gaps": gaps, "source_alignment": source, "parent_alignment": parent, "parent_alignment_modified": mark_mismatches(source, parent),
    }


def exact(rows: DataFrame) -> DataFrame:
    seq = F.col("epitope_seq")
    return rows.withColumns(_fields(seq, seq, F.col("parent_start"), F.col("parent_end"), F.lit(1.0), F.lit(0.0)))


def linear(rows: DataFrame) -> DataFrame:
    """Lifts source_start..source_end over the global alignment of source and parent; each pair is aligned once."""
    done = aligned(rows, "source_sequence", "parent_sequence").where("aligned_a is not null")
    n = F.col("source_end") - F.col("source_start") + 1
    done = done.withColumn("_m", F.slice(position_map(F.col("aligned_a"), F.col("aligned_b")), F.col("source_start").cast("int"), F.greatest(n, F.lit(0)).cast("int")))
    letters = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1)).cast("int")), lambda i: F.struct(F.coalesce(F.nullif(F.substring("epitope_seq", i, F.lit(1)), F.lit("")), F.lit("?")).alias("s"), F.coalesce(F.get("_m", i - 1)["aa"], F.lit("-")).alias("p")))
    done = done.withColumn("_c", letters).withColumn("_pos", F.filter(F.transform("_m", lambda m: m["pos"]), lambda p: p.isNotNull())).where(F.size("_pos") > 0)
    source, parent = F.array_join(F.transform("_c", lambda c: c["s"]), ""), F.array_join(F.transform("_c", lambda c: c["p"]), "")
    same = F.size(F.filter("_c", lambda c: (c["s"] == c["p"]) & (c["p"] != "-")))
    gaps = F.size(F.filter("_c", lambda c: c["p"] == "-")) / F.size("_c")
    out = done.withColumns({"_source": source, "_parent": parent, "_same": same / F.size("_c"), "_gaps": gaps})
    out = out.withColumns(_fields(F.col("_source"), F.col("_parent"), F.array_min("_pos").cast("long"), F.array_max("_pos").cast("long"), F.col("_same"), F.col("_gaps")))
    return out.select(*[c for c in out.columns if not c.startswith("_") and c not in ("aligned_a", "aligned_b", "start_a", "start_b", "score")])


def residue_wise(rows: DataFrame) -> DataFrame:
    """Discontinuous epitopes: each residue by the source's alignment if there is one, else at its own position; 'X' outside
    the parent. The identity's denominator counts tokens that can't be read, too."""
    done = aligned(rows, "source_sequence", "parent_sequence")
    tokens = F.split(normal_residue_list(F.col("epitope_seq")), ",")
    read = F.filter(tokens, lambda t: t.rlike(r"^[A-Za-z]\d+$"))
    done = done.withColumn("_m", F.when(F.col("aligned_a").isNotNull(), position_map(F.col("aligned_a"), F.col("aligned_b"))))

    def place(t: Column) -> Column:
        aa, src = F.substring(t, 1, 1), F.substring(t, 2, 18).try_cast("int")
        mapped = F.when(src >= 1, F.get(F.col("_m"), src - 1))
        direct = F.when(src >= 1, F.nullif(F.substring(F.col("parent_sequence"), src, F.lit(1)), F.lit("")))
        on = mapped["pos"].isNotNull()
        return F.struct(aa.alias("s"), F.when(on, mapped["aa"]).otherwise(F.coalesce(direct, F.lit("X"))).alias("p"), F.when(on, mapped["pos"]).otherwise(src).alias("pos"), (F.when(on | F.col("_m").isNull(), F.coalesce(mapped["aa"], direct)) == aa).alias("same"))

    done = done.withColumn("_n", F.size(tokens)).withColumn("_c", F.transform(read, place)).where(F.size("_c") > 0)
    source, parent = F.array_join(F.transform("_c", lambda c: c["s"]), ""), F.array_join(F.transform("_c", lambda c: c["p"]), "")
    listed = F.array_join(F.transform("_c", lambda c: F.concat(c["p"], c["pos"].cast("string"))), ", ")
    out = done.withColumns({"_source": source, "_parent": parent, "_same": F.size(F.filter("_c", lambda c: c["same"])) / F.col("_n"), "_listed": listed, "_pos": F.transform("_c", lambda c: c["pos"])})
    fields = _fields(F.col("_source"), F.col("_parent"), F.array_min("_pos").cast("long"), F.array_max("_pos").cast("long"), F.col("_same"), F.lit(0.0)) | {"parent_seq": F.col("_listed")}
    out = out.withColumns(fields)
    return out.select(*[c for c in out.columns if not c.startswith("_") and c not in ("aligned_a", "aligned_b", "start_a", "start_b", "score")])


def local(rows: DataFrame) -> DataFrame:
    """Peptides without a place in a source: the best local alignment with the parent."""
    done = aligned(rows, "epitope_seq", "parent_sequence", local=True).where(F.length("aligned_a") > 0)
    n = F.length("aligned_a")
    zipped = F.arrays_zip(F.split("aligned_a", "").alias("x"), F.split("aligned_b", "").alias("y"))
    gap_a, gap_b = F.length("aligned_a") - F.length(F.replace("aligned_a", F.lit("-"), F.lit(""))), F.length("aligned_b") - F.length(F.replace("aligned_b", F.lit("-"), F.lit("")))
    same = F.size(F.filter(zipped, lambda c: c["x"] == c["y"])) / n
    fields = _fields(F.col("aligned_a"), F.col("aligned_b"), F.col("start_b").cast("long"), (F.col("start_b") + n - gap_b - 1).cast("long"), same, gap_b / n)
    out = done.withColumns(fields | {"gaps_source_alignment": gap_a / n, "all_gaps": (gap_a + gap_b) / n})
    return out.drop("aligned_a", "aligned_b", "start_a", "start_b", "score")


def map_epitopes(rows: DataFrame) -> DataFrame:
    """rows (epitope_id, epitope_seq, source_accession, source_start, source_end, source_sequence, parent_accession,
    parent_sequence, parent_start, parent_end) -> COLUMNS; an empty tier gives no rows, not an error."""
    tiered = rows.withColumn("tier", tier())
    of = lambda name: tiered.where(F.col("tier") == name)
    out = None
    for part in (exact(of("exact")), linear(of("linear")), residue_wise(of("discontinuous")), local(of("local"))):
        part = part.select(*[F.col(c) for c in COLUMNS])
        out = part if out is None else out.unionByName(part)
    return out


def source_parents(assigned: DataFrame, names: Names = NAMES) -> DataFrame:
    """One parent for each source by the deterministic mode over its epitopes, with the strategy by its score, and the
    parent's address and database; a source without a parent goes under its species' 'other' node."""
    best = mode(assigned.select("Source Accession", "Assigned Protein ID"), ["Source Accession"], "Assigned Protein ID")
    own = assigned.groupBy("Source Accession").agg(F.max("Source Alignment Score").alias("score"), F.min("Species Taxon ID").alias("_species"))
    strategy = F.when(F.col("score") >= 90, "strong-blast-match").when(F.col("score") < 90, "weak-blast-match").otherwise("manual")
    found = F.col("Assigned Protein ID").isNotNull()
    other = F.concat(F.lit(names.protein), F.col("_species").cast("string"), F.lit("-other"))
    address = F.when(found, F.concat(F.lit("http://www.uniprot.org/uniprot/"), "Assigned Protein ID")).otherwise(other)
    out = best.join(own, "Source Accession").withColumns({"strategy": strategy, "parent_iri": address, "parent_database": F.when(found, "UniProt").otherwise(names.home)})
    return out.drop("_species")


def parent_proteins(assigned: DataFrame) -> DataFrame:
    """(accession, title, name, sequence): 'sp|acc|entry' if reviewed, else 'tr|acc|entry'; one row a protein."""
    db = F.when(F.coalesce("Assigned Protein Review Status", F.lit(False)), "sp").otherwise("tr")
    rows = assigned.where("`Assigned Protein ID` is not null").select(F.col("Assigned Protein ID").alias("accession"), F.concat_ws("|", db, "Assigned Protein ID", "Assigned Protein Entry Name").alias("title"), F.col("Assigned Protein Name").alias("name"), F.col("Assigned Protein Sequence").alias("sequence"))
    return rows.groupBy("accession").agg(F.min(F.struct("title", "name", "sequence")).alias("b")).select("accession", "b.*")
