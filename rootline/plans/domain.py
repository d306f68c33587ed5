"""Registered queries of the domain operators over small fixed tables, each with an oracle that states the rule anew.

A fixture is written once; Spark reads it as a frame and the oracle as a table expression of the same name.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rootline.functions import expressions as X
from rootline.operators import assign, graph, joins, mapping, metrics, ontology, protein_tree, rank, taxonomy, validate
from rootline.operators import statements as S
from rootline.operators.shared import shared_folder
from rootline.sources import readers, schemas, writers
from rootline.streaming import incremental

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
FIXTURES: dict[str, tuple[str, list[tuple]]] = {}
RULES: dict[str, tuple[str, tuple[str, ...], Callable]] = {}  # oracle, names of the tables that it reads, query
_SQL = {"long": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def _literal(x) -> str:
    return "NULL" if x is None else str(x).upper() if isinstance(x, bool) else repr(x) if isinstance(x, int | float) else "'" + x.replace("'", "''") + "'"


def _values(name: str) -> str:
    """A fixture as a common table expression."""
    columns, rows = FIXTURES[name]
    fields = [c.strip().rsplit(" ", 1) for c in columns.split(",")]
    picked = ", ".join(f'CAST(c{i} AS {_SQL[k]}) AS "{n.strip("`")}"' for i, (n, k) in enumerate(fields))
    body = ", ".join("(" + ", ".join(map(_literal, r)) + ")" for r in rows)
    return f"{name} AS (SELECT {picked} FROM (VALUES {body}) v({', '.join(f'c{i}' for i in range(len(fields)))}))"


class Tables:
    """The driver's tables and the fixtures, by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __call__(self, name: str) -> DataFrame:
        if name in FIXTURES:
            columns, rows = FIXTURES[name]
            return self.spark.createDataFrame(rows, columns)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def folder(self) -> str:
        return f"{shared_folder(self.spark)}/files-{uuid.uuid4().hex}"

    def text(self, path: str, text: str) -> str:
        """A text file in the shared folder."""
        self.spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
        return path


def with_tables(body: str, tables: list[str]) -> str:
    """A query with table expressions before its own."""
    rest = re.sub(r"^WITH (RECURSIVE )?", "", body)
    return f"WITH RECURSIVE {', '.join(tables)}{',' if rest != body else ''} {rest}" if tables else body


def query(oracle: str | None = None, *fixtures: str):
    def register(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if oracle:
            RULES[f.__name__] = oracle.strip(), fixtures, f
            ORACLES[f.__name__] = with_tables(oracle.strip(), [_values(n) for n in fixtures])
        return f

    return register


# -- expressions ------------------------------------------------------------------------------------------------------

FIXTURES["labels"] = ("id long, label string", [(1, "Homo sapiens"), (2, "A/B virus (strain 1.5)"), (3, "Bob's \"x\" sp."), (4, ""), (5, None), (6, "two  spaces"), (7, "<b>&c'")])


@query("""SELECT id, replace(replace(replace(replace(replace(replace(replace(label, ' ', '-'), '(', ''), ')', ''), '.', ''), '''', ''), '"', ''), '/', '_') AS key,
 replace(label, '"', '\\"') AS quoted, replace(replace(replace(replace(replace(label, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;') AS html,
 regexp_replace(upper(label), '[^A-Z]', '', 'g') AS letters, CASE label WHEN 'Homo sapiens' THEN 'human' ELSE 'other' END AS known FROM labels""", "labels")
def text_expressions(t):
    label = F.col("label")
    return t("labels").select("id", X.slug(label).alias("key"), X.escape_quotes(label).alias("quoted"), X.html_escape(label).alias("html"), X.clean_sequence(label).alias("letters"), X.lookup(label, {"Homo sapiens": "human"}, F.lit("other")).alias("known"))


FIXTURES["taxa"] = ("id string, proteome string", [("9606", "UP1"), ("10000003", ""), ("10000003-other", None), ("NCBITaxon:1", "UP2"), ("12-other", "UP3")])


@query("""SELECT id, CASE WHEN TRY_CAST(id AS BIGINT) >= 10000000 THEN 'local-taxon:' || id WHEN TRY_CAST(id AS BIGINT) IS NOT NULL THEN 'NCBITaxon:' || id WHEN id LIKE '%-other' THEN 'local-taxon:' || id ELSE id END AS curie,
 CASE WHEN coalesce(proteome, '') = '' THEN 'https://www.uniprot.org/taxonomy/' || id ELSE 'https://www.uniprot.org/proteomes/' || proteome END AS link FROM taxa""", "taxa")
def curies_and_links(t):
    return t("taxa").select("id", X.curie(F.col("id")).alias("curie"), X.proteome_link(F.col("proteome"), F.col("id")).alias("link"))


@query("""SELECT o_orderkey, strftime(o_orderdate, '%G-W%V') AS week, CAST(o_orderdate AS DATE) - CAST(date_part('dow', o_orderdate) AS INTEGER) AS sunday, crc32_mod AS bucket FROM
 (SELECT *, CAST(o_orderkey % 7 AS BIGINT) AS crc32_mod FROM orders)""")
def weeks_and_sundays(t):
    return t("orders").select("o_orderkey", X.iso_week(F.col("o_orderdate")).alias("week"), X.last_sunday(F.col("o_orderdate").cast("date")).alias("sunday"), F.pmod("o_orderkey", F.lit(7)).cast("long").alias("bucket"))


FIXTURES["epitopes"] = ("id long, seq string", [(1, "SIINFEKL"), (2, "H15, G16, Y20"), (3, "H15 ,G16,  Y20,"), (4, "AC"), (5, None), (6, ""), (7, "h15 G16,,K2")])


@query("""SELECT id, coalesce(length(seq) >= 5 AND NOT regexp_matches(seq, '[0-9]'), FALSE) AS eligible, regexp_matches(seq, '[0-9]') AS listed,
 regexp_replace(replace(replace(replace(replace(replace(seq, ',  ', ', '), ' ,', ','), ', ', ','), ' ', ','), ',,', ','), ',$', '') AS normal,
 array_to_string(regexp_extract_all(seq, '[A-Za-z][0-9]+'), '|') AS tokens FROM epitopes""", "epitopes")
def residue_lists(t):
    seq = F.col("seq")
    return t("epitopes").select("id", X.eligible_peptide(seq).alias("eligible"), X.discontinuous(seq).alias("listed"), X.normal_residue_list(seq).alias("normal"),
                                F.array_join(F.transform(X.residues(seq), lambda x: F.concat(x["aa"], x["pos"].cast("string"))), "|").alias("tokens"))


# -- readers and writers ----------------------------------------------------------------------------------------------


def _nation(df: DataFrame) -> DataFrame:
    return df.select(F.col("n_nationkey").cast("long").alias("n_nationkey"), "n_name", F.col("n_regionkey").cast("long").alias("n_regionkey"))


_NATION = "SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name, CAST(n_regionkey AS BIGINT) AS n_regionkey FROM nation"
_NATION_SCHEMA = schemas.schema("n_nationkey:l,n_name,n_regionkey:l")


@query(_NATION)
def tsv_round_trip(t):
    at = t.folder()
    writers.write_tsv(_nation(t("nation")), at, one_file=True)
    return readers.read_table(t.spark, at, _NATION_SCHEMA)


@query("SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey FROM nation")
def string_tsv_scan(t):
    at = t.folder()
    writers.write_tsv(_nation(t("nation")), at)
    return readers.read_strings(t.spark, at, ["n_nationkey", "n_name", "n_regionkey"])


@query(_NATION)
def gz_tsv_scan(t):
    at = t.folder()
    _nation(t("nation")).write.option("compression", "gzip").csv(at, sep="\t", header=True)
    return readers.read_table(t.spark, at, _NATION_SCHEMA)


@query(_NATION)
def headerless_csv_scan(t):
    at = t.folder()
    _nation(t("nation")).write.csv(at, header=False)
    return readers.read_table(t.spark, at, _NATION_SCHEMA, sep=",", header=False)


@query(_NATION)
def csv_to_tsv_scan(t):
    at = t.folder()
    _nation(t("nation")).write.csv(f"{at}-csv", header=True)
    writers.csv_to_tsv(t.spark, f"{at}-csv", at)
    return readers.read_table(t.spark, at, _NATION_SCHEMA)


@query("SELECT CAST(n_regionkey AS VARCHAR) AS region, CAST(count(*) AS VARCHAR) AS n, CASE WHEN n_regionkey = 1 THEN '' ELSE max(n_name) END AS last FROM nation GROUP BY n_regionkey")
def sql_to_tsv_scan(t):
    at = t.folder()
    readers.sql_read(t.spark, {"own_nation": t("nation")}, "SELECT 1").count()
    writers.sql_to_tsv(t.spark, "SELECT n_regionkey AS region, count(*) AS n, CASE WHEN n_regionkey = 1 THEN NULL ELSE max(n_name) END AS last FROM own_nation GROUP BY n_regionkey", at)
    return readers.read_strings(t.spark, at, ["region", "n", "last"])


@query("SELECT n_regionkey, max(n_name) AS last FROM nation WHERE n_name LIKE '%1' GROUP BY n_regionkey")
def sql_pushdown(t):
    return readers.sql_read(t.spark, {"own_nation": t("nation")}, "SELECT n_regionkey, max(n_name) AS last FROM own_nation WHERE n_name LIKE '%1' GROUP BY n_regionkey")


FIXTURES["raw_ids"] = ("id string, other string, seq string", [("57494.0", "1", "A"), ("12", "x", "B"), (None, "2.0", "C"), ("1e3", "", "D")])


@query("SELECT CAST(TRY_CAST(id AS DOUBLE) AS BIGINT) AS id, CAST(TRY_CAST(other AS DOUBLE) AS BIGINT) AS other, seq FROM raw_ids", "raw_ids")
def override_then_cast(t):
    return readers.ids_to_long(t("raw_ids"), ["id", "other"])


_FASTA = ">sp|P1|A_HUMAN Alpha one, x OS=Homo OX=9606 GN=G.1 (a) PE=2 SV=1\nMKV\nLLA\n>sp|P1-2|A_HUMAN Isoform 2 of Alpha OS=Homo OX=9606 GN=G.1\nMKV\n>Q9 bare\nACD\n>tr|Q7|Q7_X Beta OS=X OX=1 PE=4 SV=1\nMMMM"


@query("""SELECT * FROM (VALUES ('sp', 'G_1__a_', 'P1', 'A_HUMAN', '1', 'Alpha one, x', 2, 'MKVLLA'), ('sp', 'G_1', 'P1-2', 'A_HUMAN', '2', 'Isoform 2 of Alpha', 2, 'MKV'),
 (NULL, '', 'Q9', NULL, '1', 'bare', 0, 'ACD'), ('tr', '', 'Q7', 'Q7_X', '1', 'Beta', 4, 'MMMM')) v(db, gene, id, entry, isoform, name, level, seq)""")
def fasta_and_isoforms(t):
    at = f"{t.folder()}/9606"
    t.text(at, _FASTA)
    p = readers.proteome_table(readers.read_fasta(t.spark, f"{at}/part-*"))
    return p.select(F.col("Database").alias("db"), F.col("Gene").alias("gene"), F.col("Protein ID").alias("id"), F.col("Entry Name").alias("entry"), F.col("Isoform Count").alias("isoform"), F.col("Protein Name").alias("name"), F.col("Protein Existence Level").alias("level"), F.col("Sequence").alias("seq"))


FIXTURES["allergens"] = ("Name string, Sequence string", [("Ara h 1", "MKVLLAAA"), ("Bet v 1", ">a:ACDEFG>b:MK>c:WWWWWW"), ("None", None), ("Short", "AC"), ("Odd", "mkv 12 llaaa")])


@query("""SELECT * FROM (VALUES ('Ara h 1', 'MKVLLAAA'), ('Bet v 1_frag_1', 'ACDEFG'), ('Bet v 1_frag_3', 'WWWWWW'), ('Odd', 'MKVLLAAA')) v(accession, sequence)""")
def allergen_fasta(t):
    at = f"{t.folder()}/1"
    writers.write_fasta(writers.allergen_records(t("allergens")), "accession", "sequence", at)
    return readers.read_fasta(t.spark, f"{at}/part-*").select(F.col("header").alias("accession"), "sequence")


@query("""SELECT * FROM (VALUES ('P1', 'Chain', 1, NULL, 'd', 'N/A'), ('P1', 'Signal', 2, 9, '', 'S1'), ('P2', 'Peptide', 3, 4, 'x', 'N/A')) v(protein_id, type, "start", "end", description, feature_id)""")
def json_map_scan(t):
    at = t.folder()
    t.text(at, '{"P1": [{"type": "Chain", "start": 1, "end": null, "description": "d", "feature_id": "N/A"}, {"type": "Signal", "start": 2, "end": 9, "description": "", "feature_id": "S1"}], "P2": [{"type": "Peptide", "start": 3, "end": 4, "description": "x", "feature_id": "N/A"}]}')
    return readers.read_json_map(t.spark, at, schemas.FRAGMENTS_JSON).select("protein_id", F.explode("value").alias("f")).select("protein_id", "f.*")


@query("SELECT CAST(n_nationkey AS VARCHAR) AS key, n_name AS value FROM nation")
def json_dump(t):
    at = t.folder()
    writers.write_json_lines(t("nation"), "n_nationkey", "n_name", at)
    return t.spark.read.text(at).select(F.explode(F.from_json("value", "map<string,string>")).alias("key", "value"))


_ANSWER = '{"results": [{"id": "UP1", "proteomeType": "Reference proteome", "proteinCount": 5, "geneCount": 4, "strain": "K", "taxonomy": {"taxonId": 9, "scientificName": "X"}, "proteomeCompletenessReport": {"buscoReport": {"score": 91.5}}}, {"id": "UP2", "proteomeType": "Excluded"}, {"id": "UP3", "taxonomy": {"taxonId": 8}}]}'


@query("""SELECT * FROM (VALUES ('UP1', 'Reference proteome', CAST(9 AS BIGINT), 'X', CAST(5 AS BIGINT), CAST(4 AS BIGINT), CAST(91.5 AS DOUBLE), 'K'), ('UP3', NULL, 8, NULL, NULL, NULL, NULL, NULL))
 v("Proteome ID", "Proteome Type", "Proteome Taxon ID", "Proteome Label", "Protein Count", "Gene Count", "BUSCO Score", "Strain")""")
def candidates_scan(t):
    return readers.read_proteome_candidates(t.spark, t.text(t.folder(), _ANSWER))


@query("""SELECT * FROM (VALUES ('1', 'root', '', 'scientific name'), ('2', 'Bacteria', 'Bacteria <b>', 'scientific name')) v(tax_id, name, "unique", name_class)""")
def dump_scan(t):
    return readers.read_dump(t.spark, t.text(t.folder(), "1\t|\troot\t|\t\t|\tscientific name\t|\n2\t|\tBacteria\t|\tBacteria <b>\t|\tscientific name\t|"), "names")


@query("SELECT CAST(n_regionkey AS BIGINT) AS species_taxon_id, n_name AS value FROM nation")
def path_keyed_scan(t):
    at = t.folder()
    for r in range(5):
        t("nation").where(F.col("n_regionkey") == r).select("n_name").coalesce(1).write.text(f"{at}/{r}")
    return readers.with_path_key(t.spark.read.text(f"{at}/*").select("value", F.col("_metadata.file_path").alias("path"))).select("species_taxon_id", "value")


FIXTURES["structures"] = ("sequence string, accession string, ids string", [("AC", "A.1", "1 + 2.0"), ("AC", "", "3"), ("D", None, " + 4"), ("E", "x", "")])


@query("SELECT sequence, nullif(accession, '') AS accession, CAST(TRY_CAST(id AS DOUBLE) AS BIGINT) AS id FROM (SELECT sequence, accession, trim(unnest(string_split(ids, '+'))) AS id FROM structures) WHERE id <> ''", "structures")
def structure_id_lists(t):
    return readers.structure_ids(t("structures"))


FIXTURES["expected"] = ("species_taxon_id long, proteome_type string, has_metadata boolean, candidates long", [(1, "Reference proteome", True, 3), (2, "Orphans ", True, 1), (3, "x", True, 0), (4, None, False, 5), (5, "x", False, None), (6, "x", False, 2), (7, None, False, None)])
FIXTURES["folders"] = ("species_taxon_id long", [(1,), (2,), (3,), (4,), (6,), (7,)])
FIXTURES["sequence_files"] = ("path string, bytes long", [("/s/1/proteome.fasta", 100), ("/s/2/proteome.fasta", 7), ("/s/3/proteome.fasta", 0), ("/s/6/proteome.fasta", 9)])


@query("""SELECT e.species_taxon_id, CASE WHEN f.species_taxon_id IS NULL THEN 'MISSING' WHEN coalesce(bytes, 0) = 0 THEN 'EMPTY' WHEN lower(trim(proteome_type)) = 'orphans' THEN 'ORPHANS' ELSE 'SELECTED' END AS status,
 CASE WHEN f.species_taxon_id IS NULL THEN 'no species dir' WHEN coalesce(bytes, 0) = 0 THEN CASE WHEN coalesce(candidates, 0) = 0 THEN 'no-candidates' ELSE 'fetch-empty' END
 WHEN coalesce(lower(trim(proteome_type)), '') <> 'orphans' AND NOT has_metadata THEN 'no-metadata' ELSE 'ok' END AS reason
 FROM expected e LEFT JOIN folders f ON e.species_taxon_id = f.species_taxon_id LEFT JOIN sequence_files s ON s.path = '/s/' || e.species_taxon_id || '/proteome.fasta'""", "expected", "folders", "sequence_files")
def folder_statuses(t):
    files = t("sequence_files")
    return metrics.proteome_status(readers.candidate_files(t("expected"), t("folders"), files, files)).select("species_taxon_id", "status", "reason")


@query("SELECT 'ORPHANS 1, SELECTED 1' AS line UNION ALL SELECT 'EMPTY 3, SELECTED 2, MISSING 1, ORPHANS 1'")
def status_line(t):
    both = folder_statuses(t)
    lines = [metrics.one_line(both.where("species_taxon_id < 3"), "status"), metrics.one_line(both, "status")]
    return t.spark.createDataFrame([(x,) for x in lines], "line string")


@query("SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, CAST(row_number() OVER (ORDER BY translate(n_name, '0123456789', '9876543210')) AS BIGINT) AS row_number, CASE WHEN n_regionkey = 1 THEN NULL ELSE n_name END AS text FROM nation")
def numbered_rows(t):
    df = _nation(t("nation")).withColumn("text", F.when(F.col("n_regionkey") == 1, "").otherwise(F.col("n_name"))).withColumn("back", F.translate("n_name", "0123456789", "9876543210"))
    return writers.numbered(df, ["back"]).select("n_nationkey", "row_number", "text")


@query("SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, '2026_02' AS release FROM nation WHERE n_regionkey < 2")
def release_rotation(t):
    at, n = t.folder(), _nation(t("nation")).select("n_nationkey", "n_regionkey")
    for release, most in (("2026_01", 4), ("2026_02", 3), ("2026_03", 5), ("2026_02", 2)):
        writers.write_release(n.where(F.col("n_regionkey") < most).select("n_nationkey"), at, release)
    return writers.previous_release(t.spark.read.parquet(at), "2026_03").select("n_nationkey", F.col("release").cast("string").alias("release"))


FIXTURES["graph_rows"] = ("subject string, predicate string, object string, datatype string, annotation string", [
    ("x:a", "rdf:type", "owl:Class", "_IRI", None), ("x:a", "rdfs:label", 'a "q" \\ b', "xsd:string", None), ("x:a", "rdfs:subClassOf", "x:b", "_IRI", None),
    ("x:b", "rdf:type", "owl:Class", "_IRI", None), ("x:b", "rdfs:label", "asymptomatic b", "xsd:string", None), ("x:c", "rdf:type", "owl:Class", "_IRI", None),
    ("x:c", "rdfs:subClassOf", "x:a", "_IRI", None), ("y:d", "rdf:type", "owl:Class", "_IRI", None), ("y:d", "rdfs:subClassOf", "x:b", "_IRI", None), ("y:d", "rdfs:subClassOf", "x:a", "_IRI", None),
    ("y:d", "owl:equivalentClass", "x:c", "_IRI", None), ("y:d", "x:level", "lower", "xsd:string", None), ("x:a", "x:count", "5", "xsd:integer", None),
    ("y:d", "rdfs:subClassOf", "_:blank", "_IRI", None), ("_:e", "rdf:type", "owl:Class", "_IRI", None),
])


def _statements(df: DataFrame) -> DataFrame:
    return df.select(F.lit(1).alias("assertion"), F.lit(0).alias("retraction"), F.lit("graph").alias("graph"), "subject", "predicate", "object", "datatype", "annotation")


_FOUR = ["subject", "predicate", "object", "datatype"]


@query("SELECT subject, predicate, object, datatype FROM graph_rows", "graph_rows")
def turtle_round_trip(t):
    at = t.folder()
    writers.write_turtle(_statements(t("graph_rows")), at)
    return readers.read_turtle(t.spark, at).select(*_FOUR)


@query("""SELECT * FROM (VALUES ('x:a', 'rdf:type', 'owl:Class', '_IRI'), ('x:a', 'rdfs:label', 'A. b', '@en'), ('x:a', 'rdfs:label', 'two' || chr(10) || 'lines', 'xsd:string'), ('x:a', 'x:n', '5', 'xsd:integer'), ('x:a', 'x:n', 'true', 'xsd:boolean'),
 ('x:b', 'rdfs:subClassOf', 'x:a', '_IRI'), ('_', 'owl:onProperty', 'x:p', '_IRI'), ('x:b', 'rdfs:subClassOf', '_', '_IRI'), ('x:b', 'x:seen', '2026-01-01', 'xsd:date'), ('x:c', 'x:p', '<http://other/d>', '_IRI')) v(subject, predicate, object, datatype)""")
def turtle_lists(t):
    text = """@prefix x: <http://e/> .
# a comment, and .
x:a a owl:Class ; rdfs:label "A. b"@en , "two\\nlines" ;
    x:n 5 , true .
<http://e/b> rdfs:subClassOf x:a , [ owl:onProperty x:p ] ; x:seen "2026-01-01"^^xsd:date . x:c x:p <http://other/d> ."""
    df = readers.read_turtle(t.spark, t.text(t.folder(), text), {"x": "http://e/"})
    bare = lambda c: F.when(F.col(c).startswith("_:"), "_").otherwise(F.col(c)).alias(c)
    return df.select(bare("subject"), "predicate", bare("object"), "datatype")


@query("SELECT subject, predicate, object, datatype FROM graph_rows", "graph_rows")
def statements_round_trip(t):
    at = t.folder()
    writers.write_statements(_statements(t("graph_rows")), at)
    return readers.read_statements(t.spark, at).select(*_FOUR)


@query("SELECT subject, predicate, object, datatype FROM graph_rows", "graph_rows")
def statements_append(t):
    at, s = t.folder(), _statements(t("graph_rows"))
    writers.append_statements(s.where("predicate = 'rdf:type'"), at)
    writers.append_statements(s.where("predicate <> 'rdf:type'"), at)
    return t.spark.read.parquet(at).select(*_FOUR)


@query("""SELECT '<ul><li>a</li><ul><li>b &lt;x&gt;</li></ul><li>c</li></ul>' AS html UNION ALL SELECT '<table><tr><th>n</th></tr><tr><td>NATION_0</td></tr></table><p>The first 1 rows; there are more.</p>'
 UNION ALL SELECT 'run is RED with a CRITICAL - 2026-W01'""")
def html_digests(t):
    table = writers.html_table(t("nation").orderBy("n_name").select(F.col("n_name").alias("n")), 1)
    mail = writers.digest_mail(writers.digest_subject("critical", "2026-W01", "run"), table, "a@b", "c@d")
    return t.spark.createDataFrame([(writers.html_tree([(["r"], "a"), (["r", "s"], "b <x>"), (["r"], "c")]),), (table,), (mail["Subject"],)], "html string")


FIXTURES["releases"] = ("accepted string, pending string, seen_hours long, release string, modified_hours long", [("b", None, None, "b", None), ("a", None, None, "b", 120), ("a", None, None, "b", 12), ("a", "b", 24, "b", None), ("a", "b", 72, "b", 10), ("a", "b", None, "b", None), ("a", "c", 500, "b", None), (None, None, None, "b", 48)])


@query("""SELECT *, CASE WHEN release = accepted THEN 'known' WHEN modified_hours >= 48 THEN 'confirmed' WHEN pending IS DISTINCT FROM release THEN 'sighted' WHEN seen_hours >= 48 THEN 'confirmed' ELSE 'settling' END AS decision FROM releases""", "releases")
def release_decisions(t):
    from datetime import UTC, datetime, timedelta

    now = datetime(2026, 3, 1, tzinfo=UTC)
    ago = lambda h: None if h is None else now - timedelta(hours=h)
    columns, rows = FIXTURES["releases"]
    out = [(*r, incremental.release_decision(r[0], r[1] and (r[1], ago(r[2])), r[3], now, ago(r[4]))) for r in rows]
    return t.spark.createDataFrame(out, columns + ", decision string")


# -- choosing rows, joins ---------------------------------------------------------------------------------------------


@query("SELECT * FROM (SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= (SELECT min(o_orderdate) FROM orders WHERE o_custkey = (SELECT min(o_custkey) FROM orders)))")
def resume_from_key(t):
    o = t("orders")
    first = rank.only_row(o.agg(F.min("o_custkey").alias("k"))).k
    return rank.resume_from(o, "o_orderdate", "o_custkey", first).select("o_orderkey", "o_totalprice")


@query("""SELECT n_nationkey AS id, n_name AS name, NULL AS comment FROM nation UNION ALL SELECT r_regionkey, NULL, r_name FROM region""")
def union_with_patch(t):
    return joins.union_patched([t("nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")), t("region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("comment"))])


@query("""SELECT n_name, 'region ' || n_regionkey AS n_regionkey FROM nation WHERE n_regionkey <> 2 AND (regexp_matches(n_name, '1$|^2') OR regexp_matches(CAST(n_nationkey AS VARCHAR), '1$|^2'))""")
def cut_search_rewrite(t):
    found = joins.search_rows(t("nation"), "1$|^2", ["n_name", "n_nationkey"])
    named = joins.rewrite_where(found, F.col("n_regionkey") != 2, {"n_regionkey": F.concat(F.lit("region "), "n_regionkey")}).select("n_nationkey", "n_name", "n_regionkey")
    return joins.cut(named, [2, 3])


FIXTURES["allergen_species"] = ("name string", [("Bos domesticus (Bos taurus)",), ("Musca",), ("Apis mellifera (honey bee)",), ("Exopalaemon modestus",), ("Zea",), ("Canis lupus familiaris x",)])
FIXTURES["active"] = ("id long, label string", [(1, "Musca domestica"), (2, "MuscaDomestica virus (x)"), (3, "Honey bee"), (4, "Zea mays"), (5, "canis lupus (dog)"), (6, "Exopalaemon modestus"), (7, "a"), (8, "Zealand")])


@query("""WITH v AS (SELECT name, trim(split_part(lower(name), '(', 1)) AS v FROM allergen_species UNION ALL SELECT name, trim(split_part(split_part(lower(name), '(', 2), ')', 1)) FROM allergen_species WHERE name LIKE '%(%'),
 h AS (SELECT name, id FROM v, active WHERE contains(lower(label), v) OR contains(v, trim(split_part(lower(label), '(', 1))))
 SELECT name, max(id) AS id FROM h WHERE name NOT IN ('Exopalaemon modestus', 'Bos domesticus (Bos taurus)') GROUP BY name UNION ALL SELECT 'Bos domesticus (Bos taurus)', 9913""", "allergen_species", "active")
def allergen_species_map(t):
    return joins.contains_last_wins(t("allergen_species"), "name", t("active").withColumn("ord", F.col("id")), "label", "id", "ord", {"Bos domesticus (Bos taurus)": 9913}, ("Exopalaemon modestus",))


@query("SELECT DISTINCT a.p_type AS x, b.p_name AS y FROM (SELECT DISTINCT split_part(lower(p_type), ' ', 1) AS p_type FROM part) a, (SELECT DISTINCT lower(p_name || p_type) AS p_name FROM part) b WHERE contains(b.p_name, a.p_type)")
def substring_pairs(t):
    a = t("part").select(F.split_part(F.lower("p_type"), F.lit(" "), F.lit(1)).alias("x"))
    return joins.contained(a, "x", t("part").select(F.lower(F.concat("p_name", "p_type")).alias("y")), "y")


# -- assignment -------------------------------------------------------------------------------------------------------

FIXTURES["candidates"] = ("species_taxon_id long, `Proteome ID` string, `Proteome Type` string, `Proteome Taxon ID` long, `Proteome Label` string, `Protein Count` long, `BUSCO Score` double, ord long",
    [(1, f"U{i}", "Other proteome", 1, "l", 100 + (i * 7) % 10, None, i) for i in range(6)] + [(2, f"R{i}", "Reference proteome", 2, "m", 5, None if i == 2 else float(i % 4), i) for i in range(5)]
    + [(2, "X", "Redundant proteome", 2, "m", 999, 99.0, 99), (3, "Z", "Strange", 3, "n", 1, None, 1), (4, "A1", "Other proteome", 4, "o", 3, 9.0, 1), (4, "A2", "Other proteome", 4, "o", 4, 8.0, 2)])
FIXTURES["coverages"] = ("`Proteome ID` string, score long", [("U1", 7), ("U2", 7), ("U4", 7), ("A2", 5), ("A1", 5)])


@query("""WITH k AS (SELECT c.*, coalesce(list_position(['Reference and representative proteome', 'Representative proteome', 'Reference proteome', 'Other proteome', 'Non Reference proteome', 'Redundant proteome'], "Proteome Type"), 99) AS kind FROM candidates c),
 f AS (SELECT *, count(*) OVER (PARTITION BY species_taxon_id) AS n, max("BUSCO Score") OVER (PARTITION BY species_taxon_id) AS busco,
   row_number() OVER (PARTITION BY species_taxon_id ORDER BY "Protein Count" DESC, ord) AS size FROM (SELECT *, min(kind) OVER (PARTITION BY species_taxon_id) AS best FROM k) WHERE kind = best),
 r AS (SELECT f.*, row_number() OVER (PARTITION BY species_taxon_id ORDER BY CASE WHEN n > 4 AND busco IS NOT NULL THEN "BUSCO Score" END DESC NULLS LAST, CASE WHEN n > 4 AND busco IS NOT NULL THEN -ord END,
   CASE WHEN n > 4 AND busco IS NULL OR n <= 4 THEN coalesce(score, 0) END DESC, CASE WHEN n > 5 THEN size END, ord) AS rn FROM f LEFT JOIN coverages USING ("Proteome ID") WHERE (n > 4 AND busco IS NOT NULL) OR size <= 5)
 SELECT species_taxon_id, "Proteome ID", "Proteome Taxon ID", "Proteome Label", "Proteome Type" FROM r WHERE rn = 1""", "candidates", "coverages")
def proteome_selection(t):
    return assign.select_proteome(t("candidates"), t("coverages"), many=4, top=5)


FIXTURES["proteome"] = ("Database string, Gene string, `Protein ID` string, `Entry Name` string, `Protein Name` string, `Protein Existence Level` long, Sequence string", [
    ("tr", "gB", "Q0002", "B_T", "b", 4, "AASIINFEKLAASIINFEKL"), ("sp", "gA", "P0001", "A_T", "a", 1, "MSIINFEKLTT"), ("tr", "gA", "Q0003", "C_T", "c", 2, "GGSIINFEKLGGWWWWWW"), ("sp", "", "P0004", "D_T", "d", 1, "WWWWWWACDEF"),
])
FIXTURES["sources"] = ("`Source Accession` string, Length long", [("S1", 20), ("S2", 11), ("S3", 9), ("S4", 0)])
FIXTURES["alignments"] = ("Query string, Subject string, `% Identity` double, `Alignment Length` long", [("S1", "sp|P0001|A_T", 90.0, 20), ("S1", "tr|Q0002|B_T", 90.0, 20), ("S2", "Q0002", 80.0, 11), ("S2", "Q0003", 100.0, 5), ("S4", "P0004", 50.0, 3)])
_TOP = """a AS (SELECT Query, CASE WHEN Subject LIKE '%|%' THEN split_part(Subject, '|', 2) ELSE Subject END AS Subject, "Alignment Length" * "% Identity" / nullif(Length, 0) AS Score FROM alignments LEFT JOIN sources ON Query = "Source Accession"),
 b AS (SELECT a.*, Gene, row_number() OVER (PARTITION BY Query ORDER BY Score DESC NULLS LAST, (Database = 'sp') DESC NULLS FIRST, Subject) AS rn FROM a LEFT JOIN proteome ON Subject = "Protein ID"),
 top AS (SELECT s."Source Accession", Subject AS "Source Assigned Protein ID", Score AS "Source Alignment Score", Gene AS "Source Assigned Gene" FROM sources s LEFT JOIN b ON Query = "Source Accession" AND rn = 1)"""


@query(f"WITH {_TOP} SELECT * FROM top", "proteome", "sources", "alignments")
def top_source_proteins(t):
    return assign.top_proteins(t("sources"), t("alignments"), t("proteome"))


FIXTURES["manual"] = ("Accession string, `Parent Accession` string", [("S3", "P0001"), ("S1", "Q0003"), ("S9", "P0004")])


@query(f"""WITH {_TOP} SELECT top."Source Accession", coalesce("Parent Accession", "Source Assigned Protein ID") AS "Source Assigned Protein ID", CASE WHEN "Parent Accession" IS NULL THEN "Source Alignment Score" END AS "Source Alignment Score",
 "Source Assigned Gene" FROM top LEFT JOIN manual ON Accession = top."Source Accession\"""", "proteome", "sources", "alignments", "manual")
def manual_parents(t):
    return assign.override(top_source_proteins(t), t("manual"))


FIXTURES["classified"] = ("id string, class string, chain_type string, calc_mhc_allele string", [("S1", "TCR", "alpha", None), ("S2", None, None, None), ("S4", "MHC-I", None, "A*02"), ("S4", "MHC-I", None, "A*01")])


@query("""SELECT s."Source Accession", (SELECT min(nullif(concat_ws('_', class, chain_type, calc_mhc_allele), '')) FROM classified WHERE id = s."Source Accession") AS "ARC Assignment" FROM sources s""", "sources", "classified")
def receptor_labels(t):
    return assign.with_receptors(t("sources").select("Source Accession"), t("classified"))


@query("""SELECT "Source Accession" FROM sources WHERE "Source Accession" NOT IN (SELECT id FROM classified) AND "Source Accession" NOT LIKE '%SRC%'""", "sources", "classified")
def only_new_are_classified(t):
    return assign.unclassified(t("sources"), t("classified")).select("Source Accession")


FIXTURES["peptides"] = ("`Epitope ID` long, Sequence string, `Source Accession` string", [(1, "SIINFEKL", "S1"), (2, "SIINFEKL", "S2"), (3, "WWWWWW", "S1"), (4, "SIINFEKL", "S3"), (5, "WWWWWW", "S4"), (6, "ACDEF", "S4"), (7, "SIINFEKL", "S1"), (8, "AAAAA", "S2")])


@query(f"""WITH {_TOP},
 src AS (SELECT p.*, "Source Assigned Protein ID" AS sp, "Source Assigned Gene" AS sg, "Source Alignment Score" FROM peptides p LEFT JOIN top USING ("Source Accession")),
 hit AS (SELECT s.Sequence AS q, "Protein ID" AS protein, nullif(Gene, '') AS gene, Database = 'sp' AS reviewed, "Protein Existence Level" AS level, i AS "start", i + length(s.Sequence) - 1 AS "end"
   FROM (SELECT DISTINCT Sequence FROM peptides) s, proteome p, range(1, 40) r(i) WHERE substr(p.Sequence, i, length(s.Sequence)) = s.Sequence),
 g AS (SELECT hit.*, EXISTS (SELECT 1 FROM src WHERE src.Sequence = q AND sg = gene AND sp = protein) AS same FROM hit WHERE EXISTS (SELECT 1 FROM src WHERE src.Sequence = q AND sg = gene)),
 gb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY same DESC, reviewed DESC, level, protein, "start") AS rn FROM g) WHERE rn = 1),
 pb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY reviewed DESC, level, protein, "start") AS rn FROM hit WHERE EXISTS (SELECT 1 FROM src WHERE src.Sequence = q AND sp = protein)) WHERE rn = 1)
 SELECT "Epitope ID", coalesce(gb.protein, sp) AS protein, coalesce(gb."start", pb."start") AS "start", coalesce(gb."end", pb."end") AS "end"
 FROM src LEFT JOIN gb ON gb.q = Sequence AND gb.gene = sg LEFT JOIN pb ON pb.q = Sequence AND pb.protein = sp""", "proteome", "sources", "alignments", "peptides")
def peptide_assignment(t):
    out = assign.peptide_parents(t("peptides"), t("proteome"), top_source_proteins(t))
    return out.select("Epitope ID", F.col("Assigned Protein ID").alias("protein"), F.col("Assigned Protein Starting Position").cast("long").alias("start"), F.col("Assigned Protein Ending Position").cast("long").alias("end"))


@query("""SELECT Sequence, "Source Accession", min("Epitope ID") AS "Epitope ID" FROM peptides GROUP BY 1, 2""", "peptides")
def first_row_per_source(t):
    return assign.one_row_per_source(t("peptides")).select("Sequence", "Source Accession", "Epitope ID")


FIXTURES["synonym_rows"] = ("protein_id string, name string", [("P0001", "alpha"), ("P0001", "A one"), ("Q0002", "beta")])
FIXTURES["manual_synonyms"] = ("Accession string, Synonyms string", [("P0001", "own,  alpha"), ("P0004", "delta"), ("P0001", "zeta")])


@query("""WITH s AS (SELECT protein_id AS id, name FROM synonym_rows UNION SELECT Accession, trim(unnest(string_split(Synonyms, ','))) FROM manual_synonyms UNION SELECT "Protein ID", Gene FROM proteome UNION SELECT "Protein ID", "Entry Name" FROM proteome),
 l AS (SELECT id, array_to_string(list_sort(list(DISTINCT name)), ', ') AS synonyms FROM s WHERE name <> '' GROUP BY id)
 SELECT c.id, "Protein Name" AS name, "Entry Name" AS entry, Database = 'sp' AS reviewed, CAST(length(Sequence) AS BIGINT) AS length, synonyms FROM (VALUES ('P0001'), ('Q0002'), ('P0004'), ('none'), (NULL)) c(id) LEFT JOIN proteome ON "Protein ID" = c.id LEFT JOIN l ON l.id = "Protein ID\"""", "proteome", "synonym_rows", "manual_synonyms")
def assigned_protein_data(t):
    a = t.spark.createDataFrame([("P0001",), ("Q0002",), ("P0004",), ("none",), (None,)], "`Assigned Protein ID` string")
    syn = t("synonym_rows").groupBy("protein_id").agg(F.collect_list("name").alias("value"))
    fr = t.spark.createDataFrame([], "protein_id string, value array<struct<type:string,start:int,end:int,description:string,feature_id:string>>")
    out = assign.protein_data(a, t("proteome"), fr, syn, t("manual_synonyms"))
    return out.select(F.col("Assigned Protein ID").alias("id"), F.col("Assigned Protein Name").alias("name"), F.col("Assigned Protein Entry Name").alias("entry"), F.col("Assigned Protein Review Status").alias("reviewed"), F.col("Assigned Protein Length").alias("length"), F.col("Assigned Protein Synonyms").alias("synonyms"))


FIXTURES["allergen_hits"] = ("Query string, Subject string, `% Identity` double", [("P0001", "a1", 96.0), ("P0001", "a2", 95.0), ("Q0002", "a1", 94.9), ("P0004", "a3", 100.0)])
FIXTURES["allergen_names"] = ("accession string, name string, ord long", [("a1", "Ara h 1", 2), ("a2", "Bet v 1", 1), ("a3", "Cyn d 1", 3)])


@query("""SELECT p."Protein ID" AS id, coalesce((SELECT max_by(name, ord) FROM allergen_hits JOIN allergen_names ON Subject = accession WHERE Query = p."Protein ID" AND "% Identity" >= 95), "Protein Name") AS name FROM proteome p""", "proteome", "allergen_hits", "allergen_names")
def allergen_names_win(t):
    a = t("proteome").select(F.col("Protein ID").alias("Assigned Protein ID"), F.col("Protein Name").alias("Assigned Protein Name"))
    return assign.allergen_overlay(a, t("allergen_names"), t("allergen_hits")).select(F.col("Assigned Protein ID").alias("id"), F.col("Assigned Protein Name").alias("name"))


@query("""WITH e AS (SELECT 'SIINFEKL' AS s UNION ALL SELECT 'WWWWWW' UNION ALL SELECT 'S2, I3' UNION ALL SELECT 'W1, W2, A7' UNION ALL SELECT 'QQQQQ'),
 c AS (SELECT "Protein ID" AS p, Database AS id, Sequence AS q FROM proteome),
 l AS (SELECT DISTINCT id, s FROM e, c WHERE NOT regexp_matches(s, '[0-9]') AND contains(q, s)),
 d AS (SELECT DISTINCT id, s FROM e, c WHERE regexp_matches(s, '[0-9]') AND len(list_filter(string_split(s, ', '), lambda x: substr(q, CAST(substr(x, 2) AS INTEGER), 1) <> substr(x, 1, 1))) = 0)
 SELECT id AS "Proteome ID", count(s) AS score FROM (SELECT DISTINCT id FROM c) LEFT JOIN (SELECT * FROM l UNION ALL SELECT * FROM d) USING (id) GROUP BY id""", "proteome")
def coverage_scores(t):
    e = t.spark.createDataFrame([("SIINFEKL",), ("WWWWWW",), ("S2, I3",), ("W1, W2, A7",), ("QQQQQ",)], "Sequence string")
    c = t("proteome").select(F.col("Database").alias("Proteome ID"), "Protein ID", "Sequence")
    return assign.coverage(e, X.residues(F.col("Sequence")), c)


FIXTURES["chains"] = ("protein_id string, nth long, type string, `start` long, `end` long", [("A", 0, "Chain", 1, 9), ("A", 1, "Chain", 2, 9), ("A", 2, "Peptide", 3, 4), ("B", 0, "Chain", 1, 9), ("C", 0, "Chain", 1, 9), ("C", 1, "Chain", 2, 8)])


@query("""SELECT protein_id, count(*) - CASE WHEN bool_or(nth = 0 AND type = 'Chain' AND "start" = 1) AND bool_or(nth = 1 AND type = 'Chain' AND "start" = 2) AND max(CASE WHEN nth = 0 THEN "end" END) = max(CASE WHEN nth = 1 THEN "end" END) THEN 1 ELSE 0 END AS kept FROM chains GROUP BY protein_id""", "chains")
def overlapping_chains(t):
    listed = t("chains").groupBy("protein_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("nth", "type", "start", "end"))), lambda x: F.struct(x["type"].alias("type"), x["start"].alias("start"), x["end"].alias("end"))).alias("fs"))
    return listed.select("protein_id", F.size(assign.drop_overlapping_chain(F.col("fs"))).cast("long").alias("kept"))


# -- mapping ----------------------------------------------------------------------------------------------------------

FIXTURES["mapped"] = ("epitope_id long, epitope_seq string, source_accession string, source_start int, source_end int, source_sequence string, parent_accession string, parent_sequence string, parent_start long, parent_end long", [
    (1, "VLAA", "S", 3, 6, "MKVLAAGIVG", "P", "GGMKVLAAGIVGTT", 5, 8), (2, "VLAA", "S", 3, 6, "MKVLAAGIVG", "P", "GGMKVLAAGIVGTT", None, None), (3, "V3, A6", "S", None, None, "MKVLAAGIVG", "P", "GGMKVLAAGIVGTT", None, None),
    (4, "KVLAA", "T", None, None, None, "P", "GGMKVLAAGIVGTT", None, None), (5, "V3", "T", None, None, None, "P", "GGMKVLAAGIVGTT", None, None), (6, "AAA", "S", 1, 3, "MKVLAAGIVG", None, None, None, None),
    (7, "V3, L4", "S", None, None, None, "P", None, 9, None), (None, "VLAA", "S", 3, 6, "MKVLAAGIVG", "P", "GGMKVLAAGIVGTT", None, None), (8, "GIVG", "S", 7, None, "MKVLAAGIVG", "P", "GGMKVLAAGIVGTT", None, None),
])


@query("""SELECT epitope_id, epitope_seq, CASE WHEN parent_accession IS NULL THEN 'dropped' WHEN parent_start IS NOT NULL THEN 'exact' WHEN epitope_id IS NULL THEN 'dropped'
 WHEN regexp_matches(epitope_seq, '[0-9]') THEN CASE WHEN source_sequence IS NULL THEN 'dropped' ELSE 'discontinuous' END WHEN source_sequence IS NOT NULL AND source_start IS NOT NULL AND source_end IS NOT NULL THEN 'linear' ELSE 'local' END AS tier FROM mapped""", "mapped")
def mapping_tiers(t):
    return t("mapped").select("epitope_id", "epitope_seq", mapping.tier().alias("tier"))


@query("""SELECT epitope_id, 'exact' AS tier, parent_start, parent_end, epitope_seq AS parent_seq, CAST(1 AS DOUBLE) AS identity_alignment, epitope_seq AS parent_alignment_modified FROM mapped WHERE parent_start IS NOT NULL AND parent_accession IS NOT NULL
 UNION ALL SELECT epitope_id, 'linear', strpos(parent_sequence, source_sequence) + source_start - 1, strpos(parent_sequence, source_sequence) + source_end - 1, epitope_seq, 1, epitope_seq FROM mapped WHERE epitope_id = 2
 UNION ALL SELECT epitope_id, 'local', strpos(parent_sequence, epitope_seq), strpos(parent_sequence, epitope_seq) + length(epitope_seq) - 1, epitope_seq, 1, epitope_seq FROM mapped WHERE epitope_id IN (4, 8)
 UNION ALL SELECT epitope_id, 'discontinuous', 5, 8, 'V5, A8', 1, 'VA' FROM mapped WHERE epitope_id = 3""", "mapped")
def mapped_epitopes(t):
    return mapping.map_epitopes(t("mapped")).select("epitope_id", "tier", "parent_start", "parent_end", "parent_seq", "identity_alignment", "parent_alignment_modified")


FIXTURES["assigned"] = ("`Source Accession` string, `Species Taxon ID` long, `Assigned Protein ID` string, `Source Alignment Score` double, `Assigned Protein Review Status` boolean, `Assigned Protein Entry Name` string, `Assigned Protein Name` string, `Assigned Protein Sequence` string", [
    ("S1", 9, "P1", 95.0, True, "A_T", "a", "MK"), ("S1", 9, "P1", 95.0, True, "A_T", "a", "MK"), ("S1", 9, "P22", 95.0, False, "B_T", "b", "MM"), ("S2", 9, "P22", 89.9, False, "B_T", "b", "MM"),
    ("S2", 9, "P1", 89.9, True, "A_T", "a", "MK"), ("S3", 8, None, None, None, None, None, None), ("S4", 8, "P3", None, None, "C_T", None, None), ("S5", 8, None, 97.0, None, None, None, None),
])


@query("""WITH c AS (SELECT "Source Accession", "Assigned Protein ID", count(*) AS n FROM assigned GROUP BY 1, 2), b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "Source Accession" ORDER BY n DESC, "Assigned Protein ID" IS NULL, length("Assigned Protein ID"), "Assigned Protein ID") AS rn FROM c) WHERE rn = 1),
 s AS (SELECT "Source Accession", max("Source Alignment Score") AS score, min("Species Taxon ID") AS sp FROM assigned GROUP BY 1)
 SELECT b."Source Accession", b."Assigned Protein ID", score, CASE WHEN score >= 90 THEN 'strong-blast-match' WHEN score < 90 THEN 'weak-blast-match' ELSE 'manual' END AS strategy,
 CASE WHEN b."Assigned Protein ID" IS NULL THEN 'local-protein:' || sp || '-other' ELSE 'http://www.uniprot.org/uniprot/' || b."Assigned Protein ID" END AS parent_iri, CASE WHEN b."Assigned Protein ID" IS NULL THEN 'local' ELSE 'UniProt' END AS parent_database
 FROM b JOIN s USING ("Source Accession")""", "assigned")
def source_parent_rows(t):
    return mapping.source_parents(t("assigned"))


@query("""SELECT DISTINCT "Assigned Protein ID" AS accession, CASE WHEN "Assigned Protein Review Status" THEN 'sp' ELSE 'tr' END || '|' || "Assigned Protein ID" || '|' || "Assigned Protein Entry Name" AS title, "Assigned Protein Name" AS name, "Assigned Protein Sequence" AS sequence FROM assigned WHERE "Assigned Protein ID" IS NOT NULL""", "assigned")
def parent_protein_rows(t):
    return mapping.parent_proteins(t("assigned"))


# -- graphs -----------------------------------------------------------------------------------------------------------

FIXTURES["links"] = ("child string, parent string", [("b", "a"), ("c", "a"), ("d", "b"), ("d", "c"), ("d", "a"), ("e", "d"), ("f", "e"), ("f", "a"), ("x", "y"), ("y", "x"), ("g", "x")])
FIXTURES["marks"] = ("node string", [("b",), ("d",)])
_UP = """UP AS (SELECT DISTINCT child AS node, child AS anc FROM links UNION SELECT DISTINCT parent, parent FROM links UNION SELECT u.node, l.parent FROM UP u JOIN links l ON u.anc = l.child)"""


@query(f"WITH RECURSIVE {_UP} SELECT DISTINCT node FROM UP WHERE anc IN (SELECT node FROM marks)", "links", "marks")
def descendants_of_several(t):
    return graph.reachable(t("links"), t("marks"))


@query(f"""WITH RECURSIVE {_UP} SELECT DISTINCT child, parent FROM links l WHERE NOT EXISTS (SELECT 1 FROM links o JOIN UP u ON u.node = o.parent WHERE o.child = l.child AND o.parent <> l.parent AND u.anc = l.parent
 AND NOT EXISTS (SELECT 1 FROM UP c WHERE c.node = l.parent AND c.anc = l.child))""", "links")
def reduced_edges(t):
    return graph.reduction(t("links"))


@query("""WITH f AS (SELECT child, min(parent) AS parent FROM links WHERE child NOT IN ('x', 'y', 'g') GROUP BY child),
 p AS (SELECT f.child AS node, CASE WHEN g.parent IN ('b', 'd') THEN g.parent WHEN f.parent IN ('b', 'd') THEN f.parent END AS found FROM f LEFT JOIN f g ON 1 = 0)
 SELECT node, 'local-taxon:' || found || '-other' AS found FROM p WHERE found = 'd' UNION ALL SELECT node, found FROM p WHERE found = 'b' UNION ALL SELECT 'f', 'local-taxon:d-other' WHERE (SELECT parent FROM f WHERE child = 'f') = 'e'""", "links")
def nearest_with_redirect(t):
    tree = graph.first_parents(t("links").where("child not in ('x', 'y', 'g')"))
    d = t("marks").where("node = 'd'")
    return graph.redirect_other(graph.nearest(tree, t("marks")), d, F.concat(F.lit("local-taxon:"), "found", F.lit("-other")))


FIXTURES["curated"] = ("child string, parent string", [("d", "q"), ("z", "a")])


@query("SELECT child, parent FROM curated UNION ALL SELECT child, parent FROM links WHERE child NOT IN (SELECT child FROM curated)", "links", "curated")
def curated_parents_first(t):
    return graph.resolve_parents(t("curated"), t("links"))


@query("""WITH RECURSIVE one AS (SELECT child, min(parent) AS parent FROM links WHERE child NOT IN ('x', 'y', 'g') GROUP BY child), w(node, path) AS (SELECT 'a', 'a' UNION ALL SELECT child, path || '/' || child FROM w JOIN one ON parent = node)
 SELECT node, path FROM w""", "links")
def depth_first_paths(t):
    tree = graph.first_parents(t("links").where("child not in ('x', 'y', 'g')"))
    return graph.depth_first(tree, "a").select("node", F.array_join("path", "/").alias("path"))


# -- statements and rules ---------------------------------------------------------------------------------------------


def _spo(df: DataFrame) -> DataFrame:
    return df.select("subject", "predicate", "object")


_EDGES = "E AS (SELECT subject AS child, object AS parent FROM graph_rows WHERE predicate = 'rdfs:subClassOf' AND object NOT LIKE '\\_:%' ESCAPE '\\')"
_DOWN = "D AS (SELECT 'x:a' AS node UNION SELECT child FROM D JOIN E ON parent = node)"


@query(f"WITH RECURSIVE {_EDGES}, {_DOWN} SELECT subject, predicate, object FROM graph_rows WHERE subject IN (SELECT node FROM D)", "graph_rows")
def keep_branch(t):
    return _spo(ontology.keep_with_descendants(_statements(t("graph_rows")), ["x:a"]))


@query(f"WITH RECURSIVE {_EDGES}, {_DOWN} SELECT subject, predicate, object FROM graph_rows WHERE subject NOT IN (SELECT node FROM D)", "graph_rows")
def drop_branch(t):
    return _spo(ontology.remove_with_descendants(_statements(t("graph_rows")), ["x:a"]))


@query("""WITH n AS (SELECT 'y:d' AS node UNION SELECT object FROM graph_rows WHERE subject = 'y:d' AND predicate IN ('rdfs:subClassOf', 'owl:equivalentClass'))
 SELECT subject, predicate, object FROM graph_rows WHERE subject IN (SELECT node FROM n)""", "graph_rows")
def keep_self_parents_equivalents(t):
    return _spo(ontology.keep_with_parents(_statements(t("graph_rows")), ["y:d"]))


@query("SELECT subject, predicate, object FROM graph_rows WHERE subject NOT IN ('x:b', 'x:c') AND object NOT IN ('x:b', 'x:c')", "graph_rows")
def remove_by_terms(t):
    return _spo(ontology.remove_terms(_statements(t("graph_rows")), t.spark.createDataFrame([("x:b",), ("x:c",)], "node string")))


@query("SELECT subject, predicate, object FROM graph_rows WHERE subject = 'x:a' UNION SELECT subject, predicate, object FROM graph_rows WHERE predicate = 'rdf:type'", "graph_rows")
def merged_graphs(t):
    s = _statements(t("graph_rows"))
    return _spo(ontology.merge(s.where("subject = 'x:a'"), s.where("predicate = 'rdf:type'").drop("annotation")))


@query("SELECT subject, predicate, object FROM graph_rows WHERE NOT (predicate = 'owl:equivalentClass' OR predicate = 'rdfs:subClassOf' AND (object LIKE '\\_:%' ESCAPE '\\' OR subject = 'y:d' AND object = 'x:b'))", "graph_rows")
def reduced_statements(t):
    return _spo(ontology.reduce_edges(_statements(t("graph_rows"))))


@query("SELECT DISTINCT subject FROM graph_rows WHERE predicate = 'rdf:type' AND object = 'owl:Class' AND NOT (subject LIKE 'x:%')", "graph_rows")
def classes_outside_prefixes(t):
    return ontology.classes_outside(_statements(t("graph_rows")), ["x:"])


@query("SELECT DISTINCT subject FROM graph_rows g WHERE predicate = 'rdf:type' AND object = 'owl:Class' AND NOT starts_with(subject, '_:') AND NOT EXISTS (SELECT 1 FROM graph_rows l WHERE l.subject = g.subject AND l.predicate = 'rdfs:label')", "graph_rows")
def unlabelled_classes(t):
    return ontology.classes_without_label(_statements(t("graph_rows")))


FIXTURES["disease"] = ("subject string, predicate string, object string, datatype string, annotation string", [
    ("obo:DOID_7", "rdfs:subClassOf", "obo:DOID_4", "_IRI", None), ("obo:DOID_150", "rdfs:subClassOf", "x:1", "_IRI", None), ("obo:DOID_417", "rdfs:subClassOf", "x:2", "_IRI", None),
    ("obo:DOID_1205", "rdfs:subClassOf", "x:3", "_IRI", None), ("x:9", "rdfs:label", "asymptomatic x", "xsd:string", None), ("x:9", "obo:OBI_9991118", "no symptoms", "xsd:string", None),
    ("x:8", "rdfs:label", "plain", "xsd:string", None), ("obo:DOID_0060039", "rdfs:subClassOf", "obo:DOID_0060032", "_IRI", None), ("obo:DOID_0060039", "rdfs:subClassOf", "x:5", "_IRI", None),
])


@query("""SELECT * FROM (VALUES ('obo:DOID_7', 'rdfs:subClassOf', 'ONTIE:0003542'), ('obo:DOID_150', 'rdfs:subClassOf', 'x:1'), ('obo:DOID_150', 'rdfs:subClassOf', 'ONTIE:0003542'), ('obo:DOID_0014667', 'rdfs:subClassOf', 'ONTIE:0003542'),
 ('obo:DOID_630', 'rdfs:subClassOf', 'ONTIE:0003542'), ('obo:DOID_225', 'rdfs:subClassOf', 'ONTIE:0003542'), ('obo:DOID_417', 'rdfs:subClassOf', 'obo:DOID_4'), ('obo:DOID_1205', 'rdfs:subClassOf', 'obo:DOID_4'),
 ('x:9', 'rdfs:subClassOf', 'ONTIE:0003424'), ('x:9', 'rdfs:label', 'no symptoms'), ('x:9', 'oio:hasExactSynonym', 'asymptomatic x'), ('x:9', 'obo:OBI_9991118', 'no symptoms'), ('x:8', 'rdfs:label', 'plain'),
 ('obo:DOID_4', 'rdfs:subClassOf', 'ONTIE:0003543'), ('obo:DOID_0060039', 'rdfs:subClassOf', 'x:5'), ('obo:DOID_0060039', 'rdfs:subClassOf', 'obo:DOID_417'), ('obo:DOID_6196', 'rdfs:subClassOf', 'obo:DOID_0060032')) v(subject, predicate, object)""")
def disease_update_rules(t):
    return _spo(ontology.disease_rules(_statements(t("disease"))))


@query("SELECT 'new' AS graph, subject, predicate, object FROM graph_rows WHERE subject IN ('x:a', 'y:d') AND predicate NOT IN ('rdfs:subClassOf', 'rdf:type')", "graph_rows")
def copied_statements(t):
    s = _statements(t("graph_rows"))
    return S.rename_graph(S.copy_for(s, s.where("subject in ('x:a', 'y:d')"), ("rdfs:subClassOf", "rdf:type")), "new").select("graph", "subject", "predicate", "object")


@query("SELECT subject, 'oio:hasExactSynonym' AS predicate, object FROM graph_rows WHERE predicate = 'rdfs:label' AND subject = 'x:a'", "graph_rows")
def names_become_synonyms(t):
    s = _statements(t("graph_rows"))
    label = F.when(F.col("subject") == "x:a", "other").otherwise(F.upper("object"))
    return _spo(S.names_as_synonyms(s, s.withColumn("object", F.when(F.col("predicate") == "rdfs:label", label).otherwise(F.col("object")))))


@query("SELECT subject, CASE WHEN predicate = 'rdfs:label' THEN regexp_replace(object, '^asymptomatic', 'silent', 'g') WHEN predicate = 'rdfs:subClassOf' AND object = 'x:b' THEN 'x:root' ELSE object END AS object FROM graph_rows", "graph_rows")
def relabel_reparent(t):
    return S.relabel(S.reparent(_statements(t("graph_rows")), ["x:b"], "x:root"), "^asymptomatic", "silent").select("subject", "object")


# -- taxonomy ---------------------------------------------------------------------------------------------------------

FIXTURES["dump_nodes"] = ("tax_id string, parent_tax_id string, rank string, genetic_code_id string", [("1", "1", "no rank", ""), ("2", "1", "species group", "11"), ("3", "2", "species", ""), ("4", "3", "subspecies", "1"), ("5", "2", "genus", "")])
FIXTURES["dump_names"] = ("tax_id string, name string, `unique` string, name_class string", [
    ("1", "root", "", "scientific name"), ("2", "Twin", "Twin <a>", "scientific name"), ("3", "Twin", "Twin <b>", "scientific name"), ("3", "genb", "", "genbank common name"), ("3", "com", "", "common name"),
    ("4", "Sub", "", "scientific name"), ("4", "mis", "", "misspelling"), ("5", "Genus", "", "scientific name"), ("5", "odd", "", "authority"), ("5", "gsyn", "", "genbank synonym"), ("5", "eq", "", "equivalent name"),
])
FIXTURES["dump_merged"] = ("old_tax_id string, new_tax_id string", [("9", "3"), ("8", "3")])
FIXTURES["dump_citations"] = ("pubmed_id string, tax_id_list string", [("77", "2 3"), ("0", "3"), ("", "4"), ("78", " 3 ")])
_KINDS = """CASE name_class WHEN 'acronym' THEN 'Broad' WHEN 'genbank acronym' THEN 'Broad' WHEN 'common name' THEN 'Exact' WHEN 'equivalent name' THEN 'Exact' WHEN 'genbank common name' THEN 'Exact' WHEN 'misspelling' THEN 'Related' WHEN 'genbank synonym' THEN 'Related' WHEN 'synonym' THEN 'Related' END"""
_DUMP = f"""lab AS (SELECT tax_id, CASE WHEN count(*) OVER (PARTITION BY name) > 1 AND "unique" <> '' THEN "unique" ELSE name END AS label FROM dump_names WHERE name_class = 'scientific name'),
 st AS (SELECT 'NCBITaxon:' || tax_id AS subject, 'rdf:type' AS predicate, 'owl:Class' AS object, CAST(NULL AS VARCHAR) AS kind FROM dump_nodes UNION ALL SELECT 'NCBITaxon:' || tax_id, 'rdfs:label', label, NULL FROM lab
 UNION ALL SELECT 'NCBITaxon:' || tax_id, 'rdfs:subClassOf', 'NCBITaxon:' || parent_tax_id, NULL FROM dump_nodes WHERE parent_tax_id <> tax_id
 UNION ALL SELECT 'NCBITaxon:' || tax_id, 'ncbitaxon:has_rank', CASE WHEN rank = 'species group' THEN '<http://purl.obolibrary.org/obo/NCBITaxon#_species_group>' ELSE 'NCBITaxon:' || rank END, NULL FROM dump_nodes WHERE rank <> 'no rank'
 UNION ALL SELECT 'NCBITaxon:' || tax_id, 'oio:hasDbXref', 'GC_ID:' || genetic_code_id, NULL FROM dump_nodes WHERE genetic_code_id <> '' UNION ALL SELECT 'NCBITaxon:' || tax_id, 'oio:hasOBONamespace', 'ncbi_taxonomy', NULL FROM dump_nodes
 UNION ALL SELECT 'NCBITaxon:' || new_tax_id, 'oio:hasAlternativeId', 'NCBITaxon:' || old_tax_id, NULL FROM dump_merged
 UNION ALL SELECT 'NCBITaxon:' || unnest(string_split(trim(tax_id_list), ' ')), 'oio:hasDbXref', 'PMID:' || pubmed_id, NULL FROM dump_citations WHERE pubmed_id NOT IN ('', '0')
 UNION ALL SELECT 'NCBITaxon:' || tax_id, 'oio:has' || {_KINDS} || 'Synonym', name, replace(name_class, 'genbank', 'GenBank') FROM dump_names WHERE name_class <> 'scientific name' AND {_KINDS} IS NOT NULL)"""
_DUMP_FIXTURES = ("dump_nodes", "dump_names", "dump_merged", "dump_citations")


def _dump(t) -> DataFrame:
    return taxonomy.dump_statements(*map(t, _DUMP_FIXTURES))


@query(f"WITH {_DUMP} SELECT * FROM st", *_DUMP_FIXTURES)
def dump_to_statements(t):
    return _dump(t).select("subject", "predicate", "object", taxonomy.synonym_type(F.col("annotation")).alias("kind"))


@query(f"""WITH {_DUMP}, s AS (SELECT subject, object, kind, row_number() OVER (PARTITION BY subject ORDER BY list_position(['common name', 'GenBank common name', 'equivalent name'], kind), object) AS rn FROM st WHERE kind IN ('common name', 'GenBank common name', 'equivalent name'))
 SELECT l.subject, l.object || coalesce(' (' || s.object || ')', '') AS label, CASE s.kind WHEN 'common name' THEN 'NCBI Taxonomy scientific name (NCBI Taxonomy common name)' WHEN 'GenBank common name' THEN 'NCBI Taxonomy scientific name (GenBank common name)' WHEN 'equivalent name' THEN 'NCBI Taxonomy scientific name (NCBI Taxonomy equivalent name)' ELSE 'NCBI Taxonomy scientific name' END AS label_source
 FROM st l LEFT JOIN s ON s.subject = l.subject AND rn = 1 WHERE l.predicate = 'rdfs:label'""", *_DUMP_FIXTURES)
def best_synonym_labels(t):
    return taxonomy.best_labels(_dump(t))


FIXTURES["core"] = ("curie string, label string, label_source string, parent string, parent2 string, level string", [("NCBITaxon:1", "Root", "curated", None, None, "upper"), ("NCBITaxon:5", "My genus", "curated", "NCBITaxon:1", None, "upper")])
FIXTURES["local_taxa"] = ("curie string, label string, label_source string, parent string, parent2 string, level string", [("local-taxon:10000001", "own strain", "local", "NCBITaxon:3", None, "lower"), ("NCBITaxon:5", "late", "local", None, None, "lower")])
FIXTURES["counts"] = ("curie string, epitope_count long", [("NCBITaxon:4", 5), ("local-taxon:10000001", 2)])


@query(f"""WITH RECURSIVE {_DUMP}, w(node) AS (SELECT curie FROM counts UNION SELECT parent FROM local_taxa WHERE parent IS NOT NULL UNION SELECT object FROM w JOIN st ON st.subject = node AND predicate = 'rdfs:subClassOf' WHERE node NOT IN (SELECT curie FROM core UNION SELECT curie FROM local_taxa)),
 n AS (SELECT DISTINCT node FROM w WHERE node NOT IN (SELECT curie FROM core UNION SELECT curie FROM local_taxa)),
 r AS (SELECT curie, label, parent, level FROM core UNION ALL SELECT curie, label, parent, level FROM local_taxa WHERE curie NOT IN (SELECT curie FROM core) UNION ALL
 SELECT node, CASE node WHEN 'NCBITaxon:3' THEN 'Twin <b> (com)' ELSE (SELECT object FROM st WHERE subject = node AND predicate = 'rdfs:label') END, (SELECT object FROM st WHERE subject = node AND predicate = 'rdfs:subClassOf'),
 CASE node WHEN 'NCBITaxon:3' THEN 'species' WHEN 'NCBITaxon:4' THEN 'lower' WHEN 'NCBITaxon:2' THEN 'upper' END FROM n)
 SELECT r.*, epitope_count FROM r LEFT JOIN counts USING (curie)""", *_DUMP_FIXTURES, "core", "local_taxa", "counts")
def organism_tree_rows(t):
    core, local = t("core"), t("local_taxa")
    return taxonomy.assemble(core, local, core.select("curie"), t("counts"), _dump(t)).select("curie", "label", "parent", "level", "epitope_count")


FIXTURES["marked"] = ("curie string", [("NCBITaxon:5", ), ("NCBITaxon:3",)])


@query("""SELECT * FROM (VALUES ('NCBITaxon:3', 'missing-other', 'local-taxon:3-other'), ('NCBITaxon:5', 'missing-other', 'local-taxon:5-other'), ('NCBITaxon:5', 'label', 'My genus / late')) v(curie, problem, detail)""")
def assembly_checks(t):
    return taxonomy.assembly_problems(t("core"), t("local_taxa"), t("marked"), organism_tree_rows(t))


FIXTURES["tree_rows"] = ("curie string, label string, level string", [("NCBITaxon:2", "Up", "upper"), ("NCBITaxon:4", "Sub", None), ("x:own", "Own", "species"), ("x:low", "Low", ""), ("NCBITaxon:1", "root", "upper")])


@query(f"""WITH {_DUMP} SELECT * FROM (VALUES ('NCBITaxon:2', 'Up', 'upper', NULL, NULL), ('NCBITaxon:1', 'root', 'upper', NULL, NULL), ('NCBITaxon:4', 'Sub', 'lower', 'NCBITaxon:3', (SELECT object || ' (com)' FROM st WHERE subject = 'NCBITaxon:3' AND predicate = 'rdfs:label')),
 ('x:own', 'Own', 'species', 'x:own', 'Own'), ('x:low', 'Low', 'lower', 'x:own', 'Own'), ('NCBITaxon:3', 'Twin <b> (com)', 'species', 'NCBITaxon:3', 'Twin <b> (com)')) v(curie, label, level, species, species_label)""", *_DUMP_FIXTURES)
def species_of_rows(t):
    s = _dump(t)
    up = graph.first_parents(S.edges(s)).unionByName(t.spark.createDataFrame([("x:own", "NCBITaxon:2"), ("x:low", "x:own")], "child string, parent string"))
    ranks = s.where("predicate = 'ncbitaxon:has_rank'").select("subject", F.split_part("object", F.lit(":"), F.lit(2)).alias("rank"))
    labels = taxonomy.best_labels(s).join(ranks, "subject", "left")
    return taxonomy.with_species(t("tree_rows"), up, labels).select("curie", "label", "level", "species", "species_label")


FIXTURES["ranks"] = ("rank string", [("species",), ("genus",), ("subspecies",), ("superkingdom",), ("strain",), ("no rank",), (None,), ("varietas",), ("clade",)])


@query("SELECT rank, CASE WHEN rank = 'species' THEN 'species' WHEN rank IN ('genus', 'superkingdom', 'clade') THEN 'upper' WHEN rank IN ('subspecies', 'strain', 'varietas') THEN 'lower' END AS level FROM ranks", "ranks")
def rank_levels(t):
    return t("ranks").select("rank", taxonomy.level(F.col("rank")).alias("level"))


FIXTURES["organism_links"] = ("child string, parent string", [
    ("NCBITaxon:10239", "OBI:0100026"), ("NCBITaxon:11", "NCBITaxon:10239"), ("NCBITaxon:2759", "OBI:0100026"), ("NCBITaxon:7742", "NCBITaxon:2759"), ("NCBITaxon:9593", "NCBITaxon:7742"), ("NCBITaxon:9595", "NCBITaxon:9593"),
    ("local-taxon:9593-other", "NCBITaxon:9593"), ("NCBITaxon:58024", "NCBITaxon:2759"), ("NCBITaxon:3702", "NCBITaxon:58024"), ("NCBITaxon:4932", "NCBITaxon:2759"), ("NCBITaxon:2", "OBI:0100026"), ("NCBITaxon:562", "NCBITaxon:2"),
    ("NCBITaxon:2157", "OBI:0100026"), ("NCBITaxon:99", "NCBITaxon:2157"), ("NCBITaxon:7", "x:odd"),
])
FIXTURES["species_rows"] = ("node string, label string", [("local-taxon:10002316", "CoV 1"), ("NCBITaxon:11", "Virus/V (x)"), ("NCBITaxon:9593", "Gorilla gorilla"), ("NCBITaxon:3702", "A. thaliana"), ("NCBITaxon:4932", "Yeast"), ("NCBITaxon:562", "E. coli"), ("NCBITaxon:99", "Arch"), ("NCBITaxon:7", "Odd")])
FIXTURES["organism_counts"] = ("curie string, epitope_count long", [("NCBITaxon:11", 1), ("NCBITaxon:9595", 4), ("NCBITaxon:9593", 3), ("local-taxon:9593-other", 50), ("NCBITaxon:3702", 2), ("NCBITaxon:4932", 2), ("NCBITaxon:562", 9), ("NCBITaxon:99", 1), ("NCBITaxon:694009", 6), ("local-taxon:10002316", 3)])
_ABOVE = "U AS (SELECT node, node AS anc FROM species_rows UNION SELECT U.node, parent FROM U JOIN organism_links ON child = anc)"
_GROUPS = """G AS (SELECT node, CASE WHEN NOT bool_or(anc = 'OBI:0100026') THEN 'other' WHEN bool_or(anc = 'NCBITaxon:2157') THEN 'archeobacterium' WHEN bool_or(anc = 'NCBITaxon:2') THEN 'bacterium' WHEN bool_or(anc = 'NCBITaxon:10239') THEN 'virus'
 WHEN bool_or(anc = 'NCBITaxon:58024') THEN 'plant' WHEN bool_or(anc = 'NCBITaxon:7742') THEN 'vertebrate' WHEN bool_or(anc = 'NCBITaxon:2759') THEN 'other-eukaryote' END AS "group" FROM U GROUP BY node)"""


@query(f"WITH RECURSIVE {_ABOVE}, {_GROUPS} SELECT * FROM G", "organism_links", "species_rows")
def taxon_groups(t):
    return taxonomy.groups(t("organism_links"), t("species_rows").select("node"))


@query(f"""WITH RECURSIVE {_ABOVE}, {_GROUPS}, B AS (SELECT node AS sp, node FROM species_rows UNION SELECT 'local-taxon:10002316', 'NCBITaxon:694009' UNION SELECT sp, child FROM B JOIN organism_links ON parent = B.node),
 A AS (SELECT sp, array_to_string(list_sort(list(CAST(regexp_replace(B.node, '^[a-zA-Z-]+:', '') AS BIGINT))), ', ') AS taxa, CAST(sum(epitope_count) AS BIGINT) AS n FROM B JOIN organism_counts ON curie = B.node WHERE regexp_matches(B.node, '^[a-zA-Z-]+:[0-9]+$') GROUP BY sp)
 SELECT regexp_replace(sp, '^[a-zA-Z-]+:', '') || '-' || replace(replace(replace(replace(replace(label, ' ', '-'), '(', ''), ')', ''), '.', ''), '/', '_') AS "Species Key", CAST(regexp_replace(sp, '^[a-zA-Z-]+:', '') AS BIGINT) AS "Species ID", label AS "Species Label", taxa AS "Active Taxa", "group" AS "Group", n AS "Epitope Count"
 FROM A JOIN species_rows s ON s.node = sp LEFT JOIN G ON G.node = sp""", "organism_links", "species_rows", "organism_counts")
def active_species_table(t):
    return taxonomy.active_species(t("organism_links"), t("species_rows"), t("organism_counts"))


@query("SELECT 'NCBITaxon:' || o_custkey AS curie, count(*) AS epitope_count FROM orders GROUP BY o_custkey")
def organism_counts(t):
    return taxonomy.peptide_counts(t("orders").select(F.col("o_custkey").alias("Organism ID")))


@query("SELECT * FROM (VALUES ('x:1', 'rdf:type', 'owl:AnnotationProperty'), ('x:1', 'rdfs:label', 'one'), ('x:2', 'rdf:type', 'owl:AnnotationProperty'), ('x:2', 'rdfs:label', 'two')) v(subject, predicate, object)")
def annotation_header(t):
    return _spo(S.emit(t.spark.range(1), taxonomy.header({"x:1": "one", "x:2": "two"})))


FIXTURES["small_tree"] = ("subject string, predicate string, object string, datatype string, annotation string", [("NCBITaxon:2", "x:level", "upper", "xsd:string", None), ("NCBITaxon:3", "x:level", "species", "xsd:string", None), ("NCBITaxon:3", "rdfs:subClassOf", "NCBITaxon:2", "_IRI", None)])


@query(f"""WITH {_DUMP} SELECT subject, predicate, object FROM small_tree UNION ALL SELECT subject, predicate, object FROM st WHERE subject = 'NCBITaxon:4' UNION ALL SELECT 'NCBITaxon:4', 'ONTIE:0003619', 'NCBITaxon:3'""", *_DUMP_FIXTURES, "small_tree")
def subspecies_tree(t):
    return _spo(taxonomy.subspecies(_statements(t("small_tree")), _dump(t)))


# -- protein tree -----------------------------------------------------------------------------------------------------

FIXTURES["tree_sources"] = ("`Source Accession` string, Database string, Name string, `Species Taxon ID` long, `Species Name` string, `Source Assigned Gene` string, `Assigned Protein ID` string, `Assigned Protein Name` string, `Assigned Protein Review Status` boolean, `Assigned Protein Length` long, `Assigned Protein Synonyms` string, `ARC Assignment` string", [
    ("S1", "UniProt", "src 1", 9, "Sp", "geneA", "P1", "Prot", True, 90, "syn one, bad@x", None), ("S2", "UniProt", "src 2", 9, "Sp", "GENEA", "P2-2", "Prot", True, 90, None, None), ("S3", "NCBI", "src 3", 9, "Sp", None, "P3", "Prot", False, 90, "", None),
    ("S4", "UniProt", "src 4", 9, "Sp", "g\\x", "P4", "Prot", None, 90, "s{1}, t", "BCR_heavy"), ("S5", "UniProt", "src 5", 9, "Sp", "x", None, None, None, None, None, "TCR_a"), ("S6", "GenBank", "src 6", 9, "Sp", None, None, None, None, None, None, ""), ("S7", "UniProt", "src 7", 8, "Sq", None, None, None, None, None, None, None),
])
FIXTURES["tree_fragments"] = ("pid string, nth long, type string, `start` long, `end` long, description string, feature_id string", [("P1", 0, "Chain", 1, 90, "", "PRO_1"), ("P1", 1, "Signal", 1, 20, "", "N/A"), ("P1", 2, "Chain", 21, 90, "Beta", "N/A"), ("P1", 3, "Peptide", None, 3, "", "N/A"), ("P1", 4, "Peptide", 30, 40, "Prot", "PEP_2")])


def _tree(t) -> tuple[DataFrame, DataFrame, DataFrame]:
    item = F.struct("nth", "type", F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"), "description", "feature_id")
    listed = t("tree_fragments").groupBy(F.col("pid").alias("Assigned Protein ID")).agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x.dropFields("nth")).alias("Assigned Protein Fragments"))
    return protein_tree.split_parents(t("tree_sources").join(listed, "Assigned Protein ID", "left"))


_PROTEIN = """SELECT 'UP:' || p AS subject, 'rdf:type' AS predicate, 'owl:Class' AS object FROM {0} UNION SELECT 'UP:' || p, 'rdfs:label', 'Prot (UniProt:' || p || ')' FROM {0} UNION SELECT 'UP:' || p, 'rdfs:subClassOf', parent FROM {0}"""


@query(f"""WITH n AS (SELECT "Assigned Protein ID" AS p, 'local-protein:9-' || CASE "Source Accession" WHEN 'S1' THEN 'geneA' WHEN 'S2' THEN 'GENEA_dup1' ELSE 'Unknown' END AS parent, coalesce("Source Assigned Gene", 'Unknown') AS gene FROM tree_sources WHERE "Source Accession" IN ('S1', 'S2', 'S3'))
 {_PROTEIN.format("n")} UNION SELECT parent, 'rdf:type', 'owl:Class' FROM n UNION SELECT parent, 'rdfs:label', 'Gene: ' || gene FROM n UNION SELECT parent, 'rdfs:subClassOf', 'local-protein:9' FROM n UNION SELECT parent, 'ONTIE:0003674', gene FROM n""", "tree_sources")
def gene_layer(t):
    own = protein_tree.normal(_tree(t)[0])
    meta = ["ONTIE:0003673", "ONTIE:0003622", "ONTIE:0003623", "ONTIE:0003624", "ONTIE:0003625", "ONTIE:0003627", "ONTIE:0003628", "ONTIE:0003620"]
    return _spo(own.where(~F.col("predicate").isin(meta) & ~F.col("subject").rlike("^UP:P1-(PRO|PEP|fragment)")))


@query("""WITH r AS (SELECT "Assigned Protein ID" AS p, split_part("ARC Assignment", '_', 1) AS kind, upper(replace("Source Assigned Gene", '\\', '-')) AS gene FROM tree_sources WHERE "ARC Assignment" <> ''),
 k AS (SELECT p, gene, 'local-protein:9-' || lower(kind) || CASE WHEN kind = 'BCR' THEN '-ig' ELSE '' END AS top, CASE kind WHEN 'BCR' THEN 'B Cell Receptor / Immunoglobulin' ELSE 'T Cell Receptor' END || ' chain' AS label FROM r)
 SELECT top AS subject, 'rdfs:label' AS predicate, label AS object FROM k UNION SELECT top, 'rdfs:subClassOf', 'local-protein:9' FROM k UNION SELECT top || '-' || gene, 'rdfs:label', 'Gene: ' || gene FROM k
 UNION SELECT top || '-' || gene, 'rdfs:subClassOf', top FROM k UNION SELECT 'UP:' || p, 'rdfs:label', 'Prot (UniProt:' || p || ')' FROM k WHERE p IS NOT NULL UNION SELECT 'UP:' || p, 'rdfs:subClassOf', top || '-' || gene FROM k WHERE p IS NOT NULL""", "tree_sources")
def receptor_layer(t):
    return _spo(protein_tree.receptors(_tree(t)[1]).where("predicate in ('rdfs:label', 'rdfs:subClassOf')"))


@query("""WITH o AS (SELECT CASE WHEN Database = 'UniProt' THEN 'UP:' ELSE 'NCBI:' END || "Source Accession" AS node, Name || ' [' || "Source Accession" || ']' AS label, 'local-protein:' || "Species Taxon ID" AS species, "Species Name" AS sp FROM tree_sources WHERE "Assigned Protein ID" IS NULL AND coalesce("ARC Assignment", '') = '')
 SELECT node AS subject, 'rdf:type' AS predicate, 'owl:Class' AS object FROM o UNION SELECT node, 'rdfs:label', label FROM o UNION SELECT node, 'rdfs:subClassOf', species || '-other' FROM o
 UNION SELECT species || '-other', 'rdf:type', 'owl:Class' FROM o UNION SELECT species || '-other', 'rdfs:label', 'Other ' || sp || ' protein' FROM o UNION SELECT species || '-other', 'rdfs:subClassOf', species FROM o""", "tree_sources")
def other_bucket(t):
    return _spo(protein_tree.others(_tree(t)[2]))


@query("""WITH p AS (SELECT DISTINCT "Assigned Protein ID" AS p, coalesce("Assigned Protein Review Status", FALSE) AS reviewed, "Assigned Protein Synonyms" AS syn FROM tree_sources WHERE "Source Accession" IN ('S1', 'S2', 'S3'))
 SELECT 'UP:' || p AS subject, 'ONTIE:0003673' AS predicate, CASE WHEN reviewed AND p NOT LIKE '%-%' THEN 'true' ELSE 'false' END AS object FROM p UNION ALL SELECT 'UP:' || p, 'ONTIE:0003623', p FROM p UNION ALL SELECT 'UP:' || p, 'ONTIE:0003624', 'http://www.uniprot.org/uniprot/' || p FROM p
 UNION ALL SELECT 'UP:' || p, 'ONTIE:0003625', 'UniProt' FROM p UNION ALL SELECT 'UP:' || p, 'ONTIE:0003622', s FROM (SELECT p, unnest(string_split(syn, ', ')) AS s FROM p) WHERE s <> '' AND s NOT LIKE '%@%' AND s NOT LIKE '%{%'""", "tree_sources")
def protein_metadata(t):
    return _spo(protein_tree.metadata(_tree(t)[0]).where("predicate in ('ONTIE:0003673', 'ONTIE:0003622', 'ONTIE:0003623', 'ONTIE:0003624', 'ONTIE:0003625')"))


@query("""WITH f AS (SELECT *, sum(CASE WHEN feature_id = 'N/A' THEN 1 ELSE 0 END) OVER (PARTITION BY pid ORDER BY nth) AS k FROM tree_fragments WHERE "start" IS NOT NULL AND "end" IS NOT NULL AND NOT ("start" = 1 AND "end" = 90)),
 g AS (SELECT *, CASE WHEN feature_id = 'N/A' THEN 'fragment-' || CAST(k AS BIGINT) ELSE feature_id END AS fid, CASE type WHEN 'Chain' THEN 'mature protein' || CASE WHEN description <> '' AND description <> 'Prot' THEN ' (' || description || ')' ELSE '' END WHEN 'Signal' THEN 'signal peptide' ELSE 'peptide' END || ' (' || "start" || '-' || "end" || ')' AS label FROM f)
 SELECT 'UP:' || pid || '-' || fid AS subject, 'rdfs:label' AS predicate, label AS object FROM g UNION ALL SELECT 'UP:' || pid || '-' || fid, 'rdfs:subClassOf', 'UP:' || pid FROM g UNION ALL SELECT 'UP:' || pid || '-' || fid, 'ONTIE:0003627', CAST("start" AS VARCHAR) FROM g
 UNION ALL SELECT 'UP:' || pid || '-' || fid, 'ONTIE:0003628', CAST("end" AS VARCHAR) FROM g UNION ALL SELECT 'UP:' || pid || '-' || fid, 'ONTIE:0003620', fid || ' ' || label FROM g""", "tree_fragments")
def fragment_nodes(t):
    return _spo(protein_tree.fragments(_tree(t)[0].where("`Assigned Protein ID` = 'P1'")).where("predicate <> 'rdf:type'"))


# -- metrics and validation -------------------------------------------------------------------------------------------

FIXTURES["sheet"] = ("species string, metric string, week string, value long", [("9606", "b", "2026-W01", 5), ("9606", "a", "2026-W01", 4), ("10", "a", "2026-W01", 3), ("TOTAL", "a", "2026-W01", 7), ("10", "a", "2026-W02", 8), ("x", "a", "2026-W02", 1)])


@query("""SELECT row_number() OVER (ORDER BY species <> 'TOTAL', TRY_CAST(species AS BIGINT) NULLS LAST, species, CASE metric WHEN 'b' THEN 0 ELSE 1 END) AS place, species, metric, max(value) FILTER (WHERE week = '2026-W01') AS "2026-W01", max(value) FILTER (WHERE week = '2026-W02') AS "2026-W02" FROM sheet GROUP BY species, metric""", "sheet")
def wide_sheet_in_order(t):
    wide = metrics.sheet_order(metrics.widen(t("sheet"), ["species", "metric"], ["2026-W01", "2026-W02"]), "species", {"b": 0, "a": 1}).collect()
    return t.spark.createDataFrame([(i + 1, *r) for i, r in enumerate(wide)], "place long, species string, metric string, `2026-W01` long, `2026-W02` long")


@query("""SELECT "Source Accession", count(DISTINCT "Assigned Protein ID") + CASE WHEN bool_or("Assigned Protein ID" IS NULL) THEN 1 ELSE 0 END AS proteins, count(DISTINCT CASE WHEN "Assigned Protein Review Status" THEN "Assigned Protein ID" END) AS reviewed FROM assigned GROUP BY 1""", "assigned")
def counts_with_nulls(t):
    one = metrics.distinct_metrics(t("assigned"), ["Source Accession"], {"proteins": ("Assigned Protein ID", None)}, null_counts=True)
    return one.join(metrics.distinct_metrics(t("assigned"), ["Source Accession"], {"reviewed": ("Assigned Protein ID", F.col("Assigned Protein Review Status"))}), "Source Accession")


FIXTURES["core_table"] = ("curie string, label string, label_source string, parent string, parent_label string, level string", [
    ("x:1", "Root", "curated", None, None, "upper"), ("x:2", "Two", "taxonomy", "x:1", "Root", "species"), ("x:3", "Three", "", "x:2", "Wrong", "odd"), ("x:4", "Lost", "taxonomy", "x:9", None, "lower"), ("x:5", "New", "curated", "x:1", "Root", "lower"),
])
FIXTURES["known_taxa"] = ("subject string, label string", [("x:1", "root"), ("x:2", "Second"), ("x:3", "Three"), ("x:4", "Lost")])


@query("""SELECT * FROM (VALUES ('x:4', 'path', 'error'), ('x:4', 'parent', 'error'), ('x:3', 'parent-label', 'error'), ('x:3', 'level', 'error'), ('x:5', 'missing-taxon', 'error'), ('x:3', 'label-source', 'warn'), ('x:2', 'label', 'error')) v("row", rule, level)""")
def core_table_checks(t):
    return validate.core_checks(t("core_table"), t("known_taxa"), "x:1").select("row", "rule", "level")


@query("SELECT curie, CASE WHEN label_source = 'taxonomy' THEN coalesce((SELECT k.label FROM known_taxa k WHERE subject = curie), label) ELSE label END AS label FROM core_table", "core_table", "known_taxa")
def core_labels_fixed(t):
    return validate.fixed_labels(t("core_table"), t("known_taxa")).select("curie", "label")


@query("SELECT curie AS \"row\", 'datatype:level' AS rule FROM core_table WHERE level NOT IN ('upper', 'species', 'lower') UNION ALL SELECT curie, 'datatype:word' FROM core_table WHERE label_source <> '' AND NOT regexp_full_match(label_source, '[a-t]+') UNION ALL SELECT curie, 'datatype:word' FROM core_table WHERE label_source = ''", "core_table")
def null_types(t):
    types = validate.datatypes([("level", None, "in('upper', 'species', 'lower')"), ("word", None, "match(/[a-t]+/)")])
    c = t("core_table")
    out = validate.check_datatype(c, "core", "curie", "level", "level", types)
    return out.union(validate.check_datatype(c, "core", "curie", "label_source", "word", types, nulltype=None)).select("row", "rule")


@query("SELECT curie AS \"row\", 'required' AS rule FROM core_table WHERE coalesce(parent_label, '') = '' UNION ALL SELECT curie, 'level' FROM core_table WHERE level = 'odd'", "core_table")
def replaced_messages(t):
    c = t("core_table")
    old = validate.core_checks(c, t("known_taxa"), "x:1").where("rule in ('level', 'path')")
    return validate.replace_messages(old, ["path"], validate.check_required(c, "core", "curie", "parent_label")).select("row", "rule")


@query("SELECT n_name FROM nation WHERE n_regionkey IN (1, 2) AND n_name LIKE 'NATION_1%' AND n_nationkey <> 11")
def filtered_rows(t):
    n = t("nation").select("n_name", F.col("n_regionkey").cast("string").alias("r"), F.col("n_nationkey").cast("string").alias("k"))
    return validate.filter_rows(n, {"r": "in.(1, 2)", "n_name": 'like."NATION_1*"', "k": 'ne."11"'}).select("n_name")


@query("SELECT p_type, CASE WHEN starts_with(lower(p_type), 'st') THEN 0 ELSE 1 END AS \"order\" FROM (SELECT DISTINCT p_type FROM part) WHERE contains(lower(p_type), 'st') ORDER BY 2, length(p_type), p_type LIMIT 10")
def typeahead_values(t):
    return validate.typeahead(t("part").select("p_type").distinct(), "p_type", "St", 10)


@query("SELECT curie, parent, CASE WHEN parent = 'x:9' THEN 'from' END AS problem FROM core_table WHERE parent = 'x:9'", "core_table")
def tree_parents_known(t):
    bad = validate.check_tree(t("core_table"), "core", "curie", "parent")
    return bad.select(F.col("row").alias("curie"), F.col("value").alias("parent"), F.split_part("rule", F.lit(":"), F.lit(1)).alias("problem"))


#: The queries over the driver's tables; the others work on small fixed ones, and are run and compared as tests alone.
ON_TABLES = (
    "csv_to_tsv_scan", "cut_search_rewrite", "filtered_rows", "gz_tsv_scan", "headerless_csv_scan", "html_digests", "json_dump", "numbered_rows", "organism_counts", "path_keyed_scan",
    "release_rotation", "resume_from_key", "sql_pushdown", "sql_to_tsv_scan", "string_tsv_scan", "substring_pairs", "tsv_round_trip", "typeahead_values", "union_with_patch", "weeks_and_sundays",
)
REGISTERED = {name: QUERIES[name] for name in ON_TABLES}
