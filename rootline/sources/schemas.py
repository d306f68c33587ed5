"""Explicit schemas of the domain tables; readers never infer types, so these don't drift between species."""

from __future__ import annotations

from pyspark.sql import types as T

_KINDS = {"s": T.StringType(), "l": T.LongType(), "i": T.IntegerType(), "d": T.DoubleType(), "b": T.BooleanType()}


def schema(columns: str, sep: str = ",") -> T.StructType:
    """'name:kind,...' with kinds s, l, i, d, b; string without a kind."""
    out = T.StructType()
    for c in columns.split(sep):
        name, _, kind = c.strip().partition(":")
        out.add(name, _KINDS[kind or "s"])
    return out


def all_strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# ids come as '57494.0', so they are read as doubles and cast
PEPTIDE = schema("Epitope ID:d,Sequence,Starting Position:d,Ending Position:d,Source Accession,Organism ID:d,Organism Name")
PEPTIDE_SOURCE = schema("Source ID:d,Source Accession,Database,Name,Aliases,Synonyms,Sequence,Organism ID:d,Organism Name,IRI")
ACTIVE_SPECIES = schema("Species Key,Species ID:d,Species Label,Active Taxa,Group,Epitope Count:d")
PROTEOME = schema("Database,Gene,Protein ID,Entry Name,Isoform Count,Protein Name,Protein Existence Level,Sequence")
PROTEOME_LIST = schema("Proteome ID,Proteome Type,Proteome Taxon ID:l,Proteome Label,Protein Count:l,Gene Count:l,BUSCO Score:d,Excluded:b,Strain")
ALIGNMENTS = schema("Query,Subject,% Identity:d,Alignment Length:l,Mismatches:l,Gap Openings:l,Query Start:l,Query End:l,Subject Start:l,Subject End:l,E-value:d,Bit Score:d")
CLASSIFIER = schema("id,class,chain_type,calc_mhc_allele")
MANUAL_PARENTS = schema("Organism ID,Organism Name,Accession,Name,Parent Database,Parent Accession,Parent Name,Gene")
MANUAL_SYNONYMS = schema("Organism ID,Organism Name,Database,Accession,Name,Synonyms")
ALLERGENS = schema("SpeciesID:d,Name,Sequence,Species")
STATEMENTS = schema("assertion:i,retraction:i,graph,subject,predicate,object,datatype,annotation")
CORE = schema("curie,label,label_source,synonyms,parent,parent_label,level,use_other")
SELECTION_REPORT = schema("Species ID,Species Name,Status,Proteome ID")
MESSAGES = schema("table,row,column,value,level,rule,message")

FRAGMENTS_JSON = "map<string,array<struct<type:string,start:int,end:int,description:string,feature_id:string>>>"
SYNONYMS_JSON = "map<string,array<string>>"

#: The field order of the taxonomy dump files.
DUMP_FIELDS = {
    "names": ["tax_id", "name", "unique", "name_class"],
    "nodes": ["tax_id", "parent_tax_id", "rank", "embl_code", "division_id", "inherited_div", "genetic_code_id", "inherited_gc", "mito_code_id", "inherited_mgc", "hidden", "hidden_subtree", "comments"],
    "merged": ["old_tax_id", "new_tax_id"],
    "citations": ["cit_id", "cit_key", "pubmed_id", "medline_id", "url", "text", "tax_id_list"],
}

#: The columns of a peptide assignment, in order.
ASSIGNMENT_COLUMNS = [
    "Species Taxon ID", "Species Name", "Organism ID", "Organism Name", "Source Accession", "Source Alignment Score", "Source Assigned Gene", "Source Assigned Protein ID",
    "Source Assigned Protein Name", "ARC Assignment", "Epitope ID", "Epitope Sequence", "Source Starting Position", "Source Ending Position", "Assigned Protein ID",
    "Assigned Protein Name", "Assigned Protein Entry Name", "Assigned Protein Review Status", "Assigned Protein Starting Position", "Assigned Protein Ending Position",
    "Assigned Protein Sequence", "Assigned Protein Length", "Assigned Protein Fragments", "Assigned Protein Synonyms",
]
