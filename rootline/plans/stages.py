"""The core pipeline as named stages: each reads tables of a folder and writes one, so that a run can stop and go on."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rootline.operators import assign, mapping, metrics, protein_tree


@dataclass(frozen=True)
class Stage:
    name: str
    needs: tuple[str, ...]
    run: Callable[..., DataFrame]


def _sources(sources: DataFrame, alignments: DataFrame, proteome: DataFrame, manual_parents: DataFrame, classified: DataFrame) -> DataFrame:
    top = assign.top_proteins(sources, alignments, proteome)
    return assign.with_receptors(assign.override(top, manual_parents), classified)


def _peptides(peptides: DataFrame, proteome: DataFrame, source_parents: DataFrame) -> DataFrame:
    return assign.one_row_per_source(assign.peptide_parents(peptides, proteome, source_parents))


def _assignments(peptide_parents: DataFrame, proteome: DataFrame, fragments: DataFrame, synonyms: DataFrame, manual_synonyms: DataFrame) -> DataFrame:
    return assign.protein_data(peptide_parents, proteome, fragments, synonyms, manual_synonyms)


def _tree(organism_tree: DataFrame, assignments: DataFrame) -> DataFrame:
    return protein_tree.build(organism_tree, assignments)


def _counts(assignments: DataFrame) -> DataFrame:
    found = F.col("Assigned Protein ID").isNotNull()
    spec = {"epitopes": ("Epitope ID", None), "assigned": ("Epitope ID", found), "sources": ("Source Accession", None)}
    return metrics.long_with_total(metrics.distinct_metrics(assignments, ["Species Taxon ID"], spec), ["Species Taxon ID"])


STAGES = [
    Stage("source_parents", ("sources", "alignments", "proteome", "manual_parents", "classified"), _sources),
    Stage("peptide_parents", ("peptides", "proteome", "source_parents"), _peptides),
    Stage("assignments", ("peptide_parents", "proteome", "fragments", "synonyms", "manual_synonyms"), _assignments),
    Stage("parent_proteins", ("assignments",), mapping.parent_proteins),
    Stage("protein_tree", ("organism_tree", "assignments"), _tree),
    Stage("release_counts", ("assignments",), _counts),
    Stage("labels", ("protein_tree",), lambda tree: tree.where("predicate = 'rdfs:label'").select("subject", F.col("object").alias("label"))),
]


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def run(spark: SparkSession, folder: str, only: list[str] | None = None, again: bool = False) -> list[str]:
    """Runs the stages in order over the Parquet tables of a folder; gives the names of those that ran. A stage whose
    table is complete is passed over unless ``again``, or unless a stage that it needs ran."""
    ran: list[str] = []
    for stage in STAGES:
        if only is not None and stage.name not in only:
            continue
        if not again and not set(stage.needs) & set(ran) and _exists(spark, f"{folder}/{stage.name}"):
            continue
        tables = {n: spark.read.parquet(f"{folder}/{n}") for n in stage.needs}
        stage.run(*tables.values()).write.mode("overwrite").parquet(f"{folder}/{stage.name}")
        ran.append(stage.name)
    return ran
