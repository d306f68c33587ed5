"""Domain operators on hand-written fixtures in the shapes of FIXTURES.md."""

import math
import random
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rootline.functions import expressions as X
from rootline.operators import assign, graph, mapping, metrics, ontology, protein_tree, rank, sequences, taxonomy, validate
from rootline.operators import statements as S
from rootline.sources import readers, turtle, writers
from rootline.streaming import incremental


def rows(df, *cols):
    return sorted([tuple(r[c] for c in cols or df.columns) for r in df.collect()], key=str)


def spo(spark, triples):
    return spark.createDataFrame([(1, 0, "graph", s, p, o, "_IRI" if ":" in o and p != "rdfs:label" else "xsd:string", None) for s, p, o in triples], S.SCHEMA)


# -- sources ----------------------------------------------------------------------------------------------------------


def test_fasta_headers_isoforms_and_other_text(spark, tmp_path):
    (tmp_path / "9606").mkdir()
    (tmp_path / "9606" / "proteome.fasta").write_text(">sp|P1|A_HUMAN Alpha one, x OS=Homo OX=9606 GN=G.1 (a) PE=2 SV=1\nMKV\nLLA\n>sp|P1-2|A_HUMAN Isoform 2 of Alpha OS=Homo OX=9606 GN=G.1\nMKV\n>Q9 bare\nACD\n")
    (tmp_path / "1").mkdir()
    (tmp_path / "1" / "proteome.fasta").write_text("")
    (tmp_path / "2").mkdir()
    (tmp_path / "2" / "proteome.fasta").write_text("Error: service unavailable\n")
    records = readers.read_fasta(spark, f"{tmp_path}/*/proteome.fasta")
    p = readers.proteome_table(readers.with_path_key(records), ("species_taxon_id",))
    got = rows(p, "species_taxon_id", "Database", "Gene", "Protein ID", "Isoform Count", "Protein Existence Level", "Sequence")
    assert got == [(9606, "sp", "G_1", "P1-2", "2", 2, "MKV"), (9606, "sp", "G_1__a_", "P1", "1", 2, "MKVLLA"), (9606, None, "", "Q9", "1", 0, "ACD")]


def test_tables_keep_empty_strings_apart_from_nulls(spark, tmp_path):
    (tmp_path / "t.tsv").write_text('Epitope ID\tSequence\tStarting Position\tEnding Position\tSource Accession\tOrganism ID\tOrganism Name\n57494.0\tSIIN""FEKL\t\t\tA.1\t9606.0\t""\n')
    df = readers.ids_to_long(readers.read_table(spark, f"{tmp_path}/t.tsv", readers.schemas.PEPTIDE), ["Epitope ID", "Organism ID"])
    r = df.first()
    assert (r["Epitope ID"], r["Starting Position"], r["Organism ID"], r["Organism Name"]) == (57494, None, 9606, "")


def test_turtle_of_several_statements(spark, tmp_path):
    text = 'x:a x:p ( x:b "c" ) .\n[ x:p x:q ] .\nx:d x:p """long "q" text,\nmore""" ; .\r\nx:e x:p <http://e/#f>, 1.5 .\n'
    got = turtle.parse(text)
    first, second = (s for s, p, *_ in got if p == "rdf:first")
    assert [r for r in got if not r[0].startswith("_:")] == [("x:a", "x:p", second, "_IRI"), ("x:d", "x:p", 'long "q" text,\nmore', "xsd:string"), ("x:e", "x:p", "<http://e/#f>", "_IRI"), ("x:e", "x:p", "1.5", "xsd:decimal")]
    assert {(second, "rdf:rest", first, "_IRI"), (first, "rdf:rest", "rdf:nil", "_IRI"), (first, "rdf:first", "c", "xsd:string")} <= set(got)
    assert [r[1:] for r in got if r[0].startswith("_:") and r[1] == "x:p"] == [("x:p", "x:q", "_IRI")]
    for wrong in ("x:a x:b", 'x:a x:b "c', 'x:a x:b """c.', "x:a x:b x:c x:d .", "x:a x:b [ x:c x:d .", "x:a x:b ( x:c"):
        with pytest.raises(ValueError):
            turtle.parse(wrong)
    assert turtle.parse("") == turtle.parse("# only a comment") == turtle.parse("@prefix x: <http://e/> ") == []
    kinds = [("x:a", "x:p", 'l1.\nl2 \\ "q"', "xsd:string"), ("x:a", "x:p", "hallo", "@de"), ("x:a", "x:p", "5", "xsd:integer"), ("x:a", "x:p", "x:b", "_IRI")]
    s = spark.createDataFrame(kinds, "subject string, predicate string, object string, datatype string")
    writers.write_turtle(s, f"{tmp_path}/k.ttl")
    assert sorted(tuple(r) for r in readers.read_turtle(spark, f"{tmp_path}/k.ttl").select(*s.columns).collect()) == sorted(kinds)


def test_dump_json_map_turtle_and_statements_round_trip(spark, tmp_path):
    (tmp_path / "names.dmp").write_text("1\t|\troot\t|\t\t|\tscientific name\t|\n2\t|\tBacteria\t|\tBacteria <b>\t|\tscientific name\t|\n")
    assert rows(readers.read_dump(spark, f"{tmp_path}/names.dmp", "names")) == [("1", "root", "", "scientific name"), ("2", "Bacteria", "Bacteria <b>", "scientific name")]
    (tmp_path / "f.json").write_text('{"P1": [{"type": "Chain", "start": 1, "end": null, "description": "d", "feature_id": "N/A"}]}')
    assert readers.read_json_map(spark, f"{tmp_path}/f.json", readers.schemas.FRAGMENTS_JSON).select("protein_id", F.col("value")[0]["start"].alias("s"), F.col("value")[0]["end"].alias("e")).collect() == [("P1", 1, None)]
    s = spo(spark, [("x:a", "rdf:type", "owl:Class"), ("x:a", "rdfs:label", 'a "q" \\ b'), ("x:a", "rdfs:subClassOf", "x:b")])
    writers.write_turtle(s, f"{tmp_path}/t.ttl")
    assert rows(readers.read_turtle(spark, f"{tmp_path}/t.ttl"), "subject", "predicate", "object", "datatype") == rows(s, "subject", "predicate", "object", "datatype")
    writers.write_statements(s, f"{tmp_path}/s.tsv")
    assert rows(readers.read_statements(spark, f"{tmp_path}/s.tsv")) == rows(s)


def test_releases_and_numbering(spark, tmp_path):
    for r in ("2026-01", "2026-02", "2026-03"):
        writers.write_release(spark.createDataFrame([(r,)], "v string"), f"{tmp_path}/rel", r)
    writers.write_release(spark.createDataFrame([("again",)], "v string"), f"{tmp_path}/rel", "2026-02")
    assert rows(writers.previous_release(spark.read.parquet(f"{tmp_path}/rel"), "2026-03"), "v") == [("again",)]
    df = spark.createDataFrame([(i, "" if i % 2 else "x") for i in range(40)], "k int, s string").repartition(5)
    assert rows(writers.numbered(df, ["k"]), "k", "row_number", "s") == sorted([(i, i + 1, None if i % 2 else "x") for i in range(40)], key=str)


def test_allergen_fragments_pages_and_signals(spark):
    df = spark.createDataFrame([("A", ">f1:MKVLAA>f2:ACD>f3:acdefg"), ("B", "mkv-laa"), ("C", None)], "Name string, Sequence string")
    assert rows(writers.allergen_records(df)) == [("A_frag_1", "MKVLAA"), ("A_frag_3", "ACDEFG"), ("B", "MKVLAA")]
    pages = {"u1": ("a", {"Link": '<u2>; rel="next"'}), "u2": ("b", {})}
    assert list(readers.land_pages(pages.get, "u1")) == ["a", "b"]
    failing = iter([ConnectionError(), TimeoutError(), None, None])

    def fetch(url):
        e = next(failing)
        if e:
            raise e
        return pages[url]

    assert list(readers.land_pages(fetch, "u1")) == ["a", "b"]
    with pytest.raises(KeyError):
        list(readers.land_pages(lambda u: pages["none"], "u1"))
    assert [readers.agreed_release(x) for x in (["a", "a", None], ["a", "b", "a"], ["a", None, None], [])] == ["a", None, None, None]
    assert readers.release_signal({}, "<version>2026_03</version>", "<version>(.*?)<")[0] == "2026_03"
    assert writers.html_tree([(["r"], "r & x"), (["r", "a"], "a")]) == "<ul><li>r &amp; x</li><ul><li>a</li></ul></ul>"


# -- expressions, ranking ---------------------------------------------------------------------------------------------


def test_expressions(spark):
    df = spark.createDataFrame([("9606", "57494.0"), ("10000005", "x"), ("694009-other", None), ("OBI:0100026", "1")], "t string, f string")
    got = df.select(X.curie(F.col("t")), X.taxon_id(X.curie(F.col("t"))), X.float_text_to_long(F.col("f"))).collect()
    assert [tuple(r) for r in got] == [("NCBITaxon:9606", "9606", 57494), ("local-taxon:10000005", "10000005", None), ("local-taxon:694009-other", "694009", None), ("OBI:0100026", "OBI:0100026", 1)]
    d = spark.createDataFrame([("2026-01-05",), ("2027-01-01",)], "d string").select(X.iso_week(F.to_date("d"))).collect()
    assert [r[0] for r in d] == ["2026-W02", "2026-W53"]
    one = spark.range(1).select(X.mark_mismatches(F.lit("ABCD"), F.lit("AXCY")).alias("m"), X.normal_residue_list(F.lit("H15,  G16 , Y20,")).alias("r"), F.size(X.residues(F.lit("H15, G16"))).alias("n"), X.html_escape(F.lit("<a&'>")).alias("h")).first()
    assert tuple(one) == ("AxCy", "H15,G16,Y20", 2, "&lt;a&amp;&#x27;&gt;")


def test_mode_counts_nulls_and_breaks_ties(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("a", "x"), ("b", "yy"), ("b", "z"), ("c", None), ("c", "w")], "k string, v string")
    assert rows(rank.mode(df, ["k"], "v")) == [("a", None), ("b", "z"), ("c", "w")]
    with pytest.raises(LookupError):
        rank.only_row(df)
    assert rank.resume_from(spark.range(5).withColumn("o", F.col("id") * 2), "o", "id", 3).count() == 2


def test_top1_is_the_same_however_it_is_partitioned(spark):
    r = random.Random(1)
    df = spark.createDataFrame([(r.randrange(9), r.randrange(4), i) for i in range(500)], "k int, v int, i int")
    was = rows(rank.top1(df, ["k"], [F.col("v").desc(), F.col("i")]))
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    assert rows(rank.top1(df.repartition(7), ["k"], [F.col("v").desc(), F.col("i")])) == was
    spark.conf.set("spark.sql.shuffle.partitions", "4")


# -- graphs -----------------------------------------------------------------------------------------------------------

EDGES = [("a", "r"), ("b", "r"), ("c", "a"), ("c", "b"), ("d", "c"), ("d", "a"), ("x", "y"), ("y", "x")]


def test_closure_handles_diamonds_cycles_and_orphans(spark):
    e = spark.createDataFrame(EDGES, "child string, parent string")
    got = {(x.ancestor, x.node): x.depth for x in graph.closure(e).collect()}
    assert got[("r", "d")] == 2 and got[("r", "c")] == 2 and got[("x", "x")] == 0 and got[("x", "y")] == 1 and ("r", "x") not in got
    nodes = spark.createDataFrame([(n,) for n in "rabcdxyz"], "node string")
    assert rows(graph.without_path_to(e, nodes, "r")) == [("x",), ("y",), ("z",)]
    assert ("d", "a") not in rows(graph.reduction(e)) and ("x", "y") in rows(graph.reduction(e))
    tree = spark.createDataFrame([("a", "r"), ("b", "r"), ("a2", "a"), ("a1", "a")], "child string, parent string")
    assert [x.node for x in graph.depth_first(tree, "r").collect()] == ["r", "a", "a1", "a2", "b"]
    with pytest.raises(RuntimeError):
        graph.closure(spark.createDataFrame([(str(i), str(i + 1)) for i in range(9)], "child string, parent string"), most=3)


def test_statement_rules(spark):
    good = spo(spark, [("x:a", "rdf:type", "owl:Class"), ("x:a", "rdfs:label", "a")])
    assert S.checked(good).count() == 2
    with pytest.raises(PySparkException, match="labels must be"):
        S.checked(good.withColumn("datatype", F.lit("_IRI"))).collect()
    with pytest.raises(PySparkException, match="unknown datatype"):
        S.checked(good.withColumn("datatype", F.lit("z"))).collect()


def test_ordered_rules_and_extracts(spark):
    s = spo(spark, [("x:a", "rdfs:subClassOf", "x:r"), ("x:a", "rdfs:label", "asymptomatic a"), ("x:b", "rdfs:subClassOf", "x:a"), ("x:b", "rdf:type", "owl:Class"), ("x:a", "x:alt", "alt a"), ("x:c", "rdfs:subClassOf", "x:q")])
    out = ontology.promote_labels(ontology.add_parent_by_label(ontology.move(s, ["x:b"], ["x:a"], "x:r"), "asymptomatic", "x:z"), "x:alt", "x:syn")
    got = rows(out, "subject", "predicate", "object")
    assert ("x:b", "rdfs:subClassOf", "x:r") in got and ("x:b", "rdfs:subClassOf", "x:a") not in got and ("x:a", "rdfs:subClassOf", "x:z") in got
    assert ("x:a", "rdfs:label", "alt a") in got and ("x:a", "x:syn", "asymptomatic a") in got and ("x:a", "rdfs:label", "asymptomatic a") not in got
    assert rows(ontology.classes_without_label(s)) == [("x:b",)] and rows(ontology.classes_outside(s, ["y:"])) == [("x:b",)]
    assert {r.subject for r in ontology.keep_with_descendants(s, ["x:r"]).collect()} == {"x:a", "x:b"}
    assert {r.subject for r in ontology.keep_with_parents(s, ["x:b"]).collect()} == {"x:a", "x:b"}
    assert ontology.remove_terms(s, spark.createDataFrame([("x:a",)], "node string")).count() == 2


# -- sequences --------------------------------------------------------------------------------------------------------


def gotoh_score(a, b, local):
    """The score alone, by the plain recurrences over all gap lengths."""
    t = sequences.letter_scores()
    n, m = len(a), len(b)
    gap = lambda k: -(sequences.OPEN + (k - 1) * sequences.EXTEND)
    h = [[0] * (m + 1) for _ in range(n + 1)]
    best = 0
    for i in range(n + 1):
        for j in range(m + 1):
            if i or j:
                c = [0] if local else []
                if i and j:
                    c.append(h[i - 1][j - 1] + int(t[ord(a[i - 1]), ord(b[j - 1])]))
                c += [h[i - k][j] + gap(k) for k in range(1, i + 1)] + [h[i][j - k] + gap(k) for k in range(1, j + 1)]
                h[i][j] = max(c)
                best = max(best, h[i][j])
    return best if local else h[n][m]


@pytest.mark.parametrize("local", [False, True])
def test_alignments_against_plain_recurrences(local):
    r = random.Random(3)
    for _ in range(60):
        a, b = ("".join(r.choice("ARNDCQEGHILKMFPSTWYV") for _ in range(r.randrange(1, 14))) for _ in range(2))
        b = b[: r.randrange(len(b) + 1)] + a[r.randrange(len(a)) :]
        x, y, i, j, score = sequences.align(a, b, local)
        assert score == gotoh_score(a, b, local)
        assert len(x) == len(y) and x.replace("-", "") in a and y.replace("-", "") in b
        if x:
            assert a[i - 1 :].startswith(x.replace("-", "")) and b[j - 1 :].startswith(y.replace("-", ""))


@pytest.mark.parametrize("local", [False, True])
def test_alignments_do_not_depend_on_their_company(local):
    r = random.Random(6)
    pairs = [tuple("".join(r.choice("ACDWKé"[: r.randrange(2, 7)]) for _ in range(r.randrange(1, 30))) for _ in "ab") for _ in range(60)]
    alone = [sequences.align(a, b, local) for a, b in pairs]
    assert sequences.align_all(pairs, local) == sequences.align_all(pairs, local, 50) == alone
    assert sequences.align_all([], local) == []


def test_peptides_are_found_everywhere(spark):
    r = random.Random(5)
    prot = ["".join(r.choice("ACD") for _ in range(60)) for _ in range(12)] + ["AAAAAAAAAA", "AC", ""]
    pep = list({p[i : i + n] for p in prot for i, n in ((r.randrange(50), r.randrange(4, 9)),) if len(p[i : i + n]) >= 4}) + ["AAAAA", "WWWWW", "AC"]
    p = spark.createDataFrame(list(enumerate(prot)), "id int, seq string")
    got = rows(sequences.peptide_join(spark.createDataFrame([(x,) for x in pep], "q string"), "q", p, "id", "seq", 4))
    want = sorted([(q, k, i + 1, i + len(q)) for q in set(pep) if len(q) >= 4 for k, s in enumerate(prot) for i in range(len(s)) if s.startswith(q, i)], key=str)
    assert got == want


def test_similarity_search_finds_the_relative(spark):
    q = spark.createDataFrame([("q1", "MKVLAAGIVGLLLAQPW"), ("q2", "WWWWWWWW")], "qid string, qs string")
    s = spark.createDataFrame([("s1", "GGMKVLAAGIVGLLLAQPWGG"), ("s2", "MKVLDDGIVGLLLAQPW"), ("s3", "PPPPPPPPPP")], "sid string, ss string")
    got = {(r.Query, r.Subject): r for r in sequences.similarity_join(q, "qid", "qs", s, "sid", "ss").collect()}
    assert set(got) == {("q1", "s1"), ("q1", "s2")}
    r = got[("q1", "s1")]
    assert (r["% Identity"], r["Alignment Length"], r["Subject Start"], r["Subject End"], r["Mismatches"], r["Gap Openings"]) == (100.0, 17, 3, 19, 0, 0)
    assert got[("q1", "s2")]["Mismatches"] == 2


def test_similarity_search_finds_members_of_a_large_family(spark):
    r = random.Random(4)
    seq = lambda n: "".join(r.choice("ACDEFGHIKLMNPQRSTVWY") for _ in range(n))
    family = seq(40)
    s = [(f"f{i:02}", family[:i] + "W" + family[i + 1 :]) for i in range(10)] + [(f"x{i:02}", seq(40)) for i in range(20)]
    df = spark.createDataFrame(s, "sid string, ss string")
    q = spark.createDataFrame([s[3]], "qid string, qs string")
    got = {x.Subject: round((x["Bit Score"] * math.log(2) + math.log(0.041)) / 0.267) for x in sequences.similarity_join(q, "qid", "qs", df, "sid", "ss").collect()}
    assert {i for i, _ in s[:10]} <= set(got) and got["f03"] == max(got.values())


def test_similarity_search_keeps_the_best_scores(spark):
    query = "MIKEVDLIRWIAEYIKGVDHIQAFINCVPTIYRLISGVEM"
    far = query.translate(str.maketrans("IVDE", "VIED"))  # scores high, shares few 3-mers
    s = [("z", far), ("y", far)] + [(f"a{i}", query[i : i + 12]) for i in range(8)]
    df = spark.createDataFrame(s, "sid string, ss string")
    got = sequences.similarity_join(spark.createDataFrame([("q", query)], "qid string, qs string"), "qid", "qs", df, "sid", "ss", top=2).collect()
    assert sorted(x.Subject for x in got) == ["y", "z"]


# -- assignment and mapping -------------------------------------------------------------------------------------------

PROTEOME = "Database string, Gene string, `Protein ID` string, `Entry Name` string, `Protein Name` string, `Protein Existence Level` int, Sequence string"


def test_sources_and_peptides_get_parents(spark):
    p = spark.createDataFrame([("tr", "gB", "Q0002", "B_T", "b", 4, "AASIINFEKLAASIINFEKL"), ("sp", "gA", "P0001", "A_T", "a", 1, "MSIINFEKLTT")], PROTEOME)
    sources = spark.createDataFrame([("S1", 20), ("S2", 11), ("S3", 9)], "`Source Accession` string, Length long")
    al = spark.createDataFrame([("S1", "sp|P0001|A_T", 90.0, 20), ("S1", "tr|Q0002|B_T", 90.0, 20), ("S2", "Q0002", 80.0, 11)], "Query string, Subject string, `% Identity` double, `Alignment Length` long")
    top = assign.top_proteins(sources, al, p)
    assert rows(top, "Source Accession", "Source Assigned Protein ID", "Source Alignment Score") == [("S1", "P0001", 90.0), ("S2", "Q0002", 80.0), ("S3", None, None)]
    manual = spark.createDataFrame([("S3", "P0001")], "Accession string, `Parent Accession` string")
    assert rows(assign.override(top, manual), "Source Accession", "Source Assigned Protein ID")[2] == ("S3", "P0001")
    pep = spark.createDataFrame([(1, "SIINFEKL", "S1"), (2, "SIINFEKL", "S2"), (3, "WWWWWW", "S1"), (4, "SIINFEKL", "S3")], "`Epitope ID` long, Sequence string, `Source Accession` string")
    got = rows(assign.peptide_parents(pep, p, top), "Epitope ID", "Assigned Protein ID", "Assigned Protein Starting Position", "Assigned Protein Ending Position")
    # the winner of a sequence is P0001; where the source's gene is another, the source's own protein is the fallback
    assert got == [(1, "P0001", 2, 9), (2, "Q0002", None, None), (3, "P0001", None, None), (4, None, None, None)]
    c = spark.createDataFrame([("S1", "TCR", "alpha", None), ("S2", None, None, None)], "id string, class string, chain_type string, calc_mhc_allele string")
    assert rows(assign.with_receptors(top, c), "Source Accession", "ARC Assignment") == [("S1", "TCR_alpha"), ("S2", None), ("S3", None)]


def test_proteome_choice(spark):
    c = [(1, f"UP{i}", "Other proteome", 100 + i, None, i) for i in range(3)] + [(2, f"R{i}", "Reference proteome", 5, float(i), i) for i in range(25)] + [(2, "X", "Redundant proteome", 999, 99.0, 99)]
    df = spark.createDataFrame([(a, b, k, 1, "l", n, s, o) for a, b, k, n, s, o in c], "species_taxon_id int, `Proteome ID` string, `Proteome Type` string, `Proteome Taxon ID` int, `Proteome Label` string, `Protein Count` int, `BUSCO Score` double, ord int")
    scores = spark.createDataFrame([("UP1", 7), ("UP2", 7)], "`Proteome ID` string, score long")
    assert rows(assign.select_proteome(df, scores), "species_taxon_id", "Proteome ID") == [(1, "UP1"), (2, "R24")]
    pep = spark.createDataFrame([("ACDEF",), ("A1, D3",), ("W1",)], "Sequence string")
    cand = spark.createDataFrame([("UP1", "P1", "ACDEFG"), ("UP2", "P2", "WCCCC")], "`Proteome ID` string, `Protein ID` string, Sequence string")
    assert rows(assign.coverage(pep, X.residues(F.col("Sequence")), cand)) == [("UP1", 2), ("UP2", 1)]


def test_overlapping_first_chain_goes(spark):
    kind = "fs array<struct<type:string,start:int,end:int,description:string,feature_id:string>>"
    df = spark.createDataFrame([([("Chain", 1, 9, "", "a"), ("Chain", 2, 9, "", "b"), ("Peptide", 3, 4, "", "c")],), ([("Chain", 1, 9, "", "a")],)], kind)
    assert [[f.feature_id for f in r[0]] for r in df.select(assign.drop_overlapping_chain(F.col("fs"))).collect()] == [["a", "c"], ["a"]]


MAPPING = "epitope_id long, epitope_seq string, source_accession string, source_start int, source_end int, source_sequence string, parent_accession string, parent_sequence string, parent_start long, parent_end long"


def test_mapping_tiers(spark):
    src, par = "MKVLAAGIVG", "GGMKVLADGIVG"
    data = [
        (1, "VLAA", "S", 3, 6, src, "P", par, 5, 8), (2, "VLAA", "S", 3, 6, src, "P", par, None, None), (3, "V3, A6, Z", "S", None, None, src, "P", par, None, None),
        (4, "KVLAD", "S", None, None, None, "P", par, None, None), (5, "V3", "S", None, None, None, "P", par, None, None), (6, "AAA", "S", 1, 3, src, None, None, None, None),
        (7, "V3, L4", "S", None, None, None, "P", None, 9, None), (None, "VLAA", "S", 3, 6, src, "P", par, None, None),
    ]
    got = {r.epitope_id: r for r in mapping.map_epitopes(spark.createDataFrame(data, MAPPING)).collect()}
    assert set(got) == {1, 2, 3, 4, 7}
    assert (got[1].tier, got[1].identity_alignment) == ("exact", 1.0)
    assert (got[2].tier, got[2].parent_start, got[2].parent_end, got[2].parent_alignment_modified, got[2].identity_alignment) == ("linear", 5, 8, "VLAd", 0.75)
    assert (got[3].tier, got[3].parent_seq, got[3].identity_alignment) == ("discontinuous", "V5, D8", pytest.approx(1 / 3))
    assert (got[4].tier, got[4].parent_start, got[4].parent_end) == ("local", 4, 8)
    assert (got[7].tier, got[7].parent_start, got[7].parent_end) == ("exact", 9, None)
    assert mapping.map_epitopes(spark.createDataFrame([], MAPPING)).count() == 0


# -- taxonomy and protein tree ----------------------------------------------------------------------------------------


def test_dump_to_statements_and_labels(spark):
    nodes = spark.createDataFrame([("1", "1", "no rank", ""), ("2", "1", "species group", "11"), ("3", "2", "species", "")], "tax_id string, parent_tax_id string, rank string, genetic_code_id string")
    names = spark.createDataFrame([("1", "root", "", "scientific name"), ("2", "Twin", "Twin <a>", "scientific name"), ("3", "Twin", "Twin <b>", "scientific name"), ("3", "genb", "", "genbank common name"), ("3", "com", "", "common name")], "tax_id string, name string, unique string, name_class string")
    merged = spark.createDataFrame([("9", "3")], "old_tax_id string, new_tax_id string")
    cites = spark.createDataFrame([("77", "2 3"), ("0", "3")], "pubmed_id string, tax_id_list string")
    s = taxonomy.dump_statements(nodes, names, merged, cites)
    got = rows(s, "subject", "predicate", "object")
    for t in [("NCBITaxon:2", "rdfs:label", "Twin <a>"), ("NCBITaxon:2", "ncbitaxon:has_rank", "<http://purl.obolibrary.org/obo/NCBITaxon#_species_group>"), ("NCBITaxon:3", "oio:hasAlternativeId", "NCBITaxon:9"), ("NCBITaxon:2", "oio:hasDbXref", "GC_ID:11"), ("NCBITaxon:3", "oio:hasDbXref", "PMID:77")]:
        assert t in got
    assert ("NCBITaxon:1", "rdfs:subClassOf", "NCBITaxon:1") not in got
    labels = {r.subject: (r.label, r.label_source) for r in taxonomy.best_labels(s).collect()}
    assert labels["NCBITaxon:3"] == ("Twin <b> (com)", "NCBI Taxonomy scientific name (NCBI Taxonomy common name)")
    core = spark.createDataFrame([("NCBITaxon:1", "Root", "curated", None, None, "upper")], "curie string, label string, label_source string, parent string, parent2 string, level string")
    counts = spark.createDataFrame([("NCBITaxon:3", 5)], "curie string, epitope_count long")
    tree = taxonomy.assemble(core, core.where("1 = 0"), core.select("curie"), counts, s)
    assert rows(tree, "curie", "label", "level", "epitope_count") == [("NCBITaxon:1", "Root", "upper", None), ("NCBITaxon:2", "Twin <a>", "upper", None), ("NCBITaxon:3", "Twin <b> (com)", "species", 5)]
    assert ("NCBITaxon:3", "ONTIE:0003618", "true") in rows(taxonomy.tree_statements(tree), "subject", "predicate", "object")


def test_species_groups_and_active_taxa(spark):
    e = spark.createDataFrame([("NCBITaxon:2759", "OBI:0100026"), ("NCBITaxon:7742", "NCBITaxon:2759"), ("NCBITaxon:9593", "NCBITaxon:7742"), ("NCBITaxon:9595", "NCBITaxon:9593"), ("NCBITaxon:10239", "OBI:0100026"), ("NCBITaxon:11", "NCBITaxon:10239")], "child string, parent string")
    sp = spark.createDataFrame([("NCBITaxon:9593", "Gorilla gorilla"), ("NCBITaxon:11", "V (x)")], "node string, label string")
    counts = spark.createDataFrame([("NCBITaxon:9593", 3), ("NCBITaxon:9595", 4), ("NCBITaxon:11", 1)], "curie string, epitope_count long")
    assert rows(taxonomy.active_species(e, sp, counts)) == [("11-V-x", 11, "V (x)", "11", "virus", 1), ("9593-Gorilla-gorilla", 9593, "Gorilla gorilla", "9593, 9595", "vertebrate", 7)]
    levels = spark.createDataFrame([("NCBITaxon:9593", "species"), ("NCBITaxon:7742", "upper")], "curie string, level string")
    species, parents = taxonomy.species_of(e, levels, spark.createDataFrame([("NCBITaxon:9593",)], "node string"))
    assert rows(species, "node", "found") == [("NCBITaxon:9595", "NCBITaxon:9593")]
    assert ("NCBITaxon:9595", "local-taxon:9593-other") in rows(parents, "node", "found")


ASSIGNED = """`Source Accession` string, Database string, Name string, `Species Taxon ID` long, `Species Name` string, `Source Assigned Gene` string, `Assigned Protein ID` string, `Assigned Protein Name` string,
`Assigned Protein Review Status` boolean, `Assigned Protein Length` long, `Assigned Protein Synonyms` string, `ARC Assignment` string, `Assigned Protein Fragments` array<struct<type:string,start:int,end:int,description:string,feature_id:string>>"""


def test_protein_tree_layers(spark):
    fr = [("Chain", 1, 90, "", "PRO_1"), ("Signal", 1, 20, "", "N/A"), ("Chain", 21, 90, "Beta", "N/A"), ("Peptide", None, 3, "", "N/A")]
    base = lambda a, g, p, arc=None, f=None: (a, "UniProt", "src " + a, 9, "Sp", g, p, "Prot", True, 90, "syn one, bad@x", arc, f)
    df = spark.createDataFrame([base("S1", "geneA", "P1", f=fr), base("S2", "GENEA", "P2"), base("S3", None, "P3"), base("S4", "g\\x", "P4", "BCR_heavy"), base("S5", "x", None, "TCR_a"), base("S6", None, None)], ASSIGNED)
    a, b, c = protein_tree.split_parents(df)
    got = rows(protein_tree.normal(a), "subject", "predicate", "object")
    for t in [
        ("local-protein:9-geneA", "rdfs:label", "Gene: geneA"), ("local-protein:9-GENEA_dup1", "rdfs:label", "Gene: GENEA"), ("UP:P2", "rdfs:subClassOf", "local-protein:9-GENEA_dup1"), ("UP:P3", "rdfs:subClassOf", "local-protein:9-Unknown"),
        ("UP:P1", "ONTIE:0003622", "syn one"), ("UP:P1-fragment-1", "rdfs:label", "signal peptide (1-20)"), ("UP:P1-fragment-2", "rdfs:label", "mature protein (Beta) (21-90)"), ("UP:P1", "ONTIE:0003673", "true"),
    ]:
        assert t in got, t
    assert not any("PRO_1" in x[0] or "bad@x" in x[2] for x in got)
    got = rows(protein_tree.receptors(b), "subject", "predicate", "object")
    assert ("local-protein:9-bcr-ig", "rdfs:label", "B Cell Receptor / Immunoglobulin chain") in got and ("UP:P4", "rdfs:subClassOf", "local-protein:9-bcr-ig-G-X") in got
    assert not any(x[0] is None or "None" in x[0] for x in got) and ("local-protein:9-tcr-X", "rdfs:subClassOf", "local-protein:9-tcr") in got
    assert ("UP:S6", "rdfs:label", "src S6 [S6]") in rows(protein_tree.others(c), "subject", "predicate", "object")
    org = spo(spark, [("NCBITaxon:9", "rdfs:label", "taxon"), ("NCBITaxon:9", "rdfs:subClassOf", "OBI:0100026"), ("NCBITaxon:10", "l:level", "lower")])
    top = rows(protein_tree.species_layer(org), "subject", "predicate", "object")
    assert top == [("local-protein:9", "rdfs:label", "taxon protein"), ("local-protein:9", "rdfs:subClassOf", "PR:000000001")]
    assert protein_tree.build(org, df).count() > 50


# -- metrics, gate, validation, watching ------------------------------------------------------------------------------


@pytest.mark.parametrize("before,now,total,want", [(10, 10, False, None), (5000, 3990, False, "CRITICAL"), (2000, 1800, False, "CRITICAL"), (900, 690, False, "WARNING"), (100, 75, False, "WARNING"), (50, 20, False, "INFO"), (50, None, False, "INFO"), (10000, 9600, True, "INFO"), (10000, 9500, True, "CRITICAL"), (None, 5, False, None)])
def test_severity(spark, before, now, total, want):
    df = spark.createDataFrame([(before, now, total)], "a long, b long, t boolean")
    assert df.select(metrics.severity(F.col("a"), F.col("b"), F.col("t"))).first()[0] == want


def test_thresholds_sheet_and_gate(spark):
    assert metrics.Thresholds.from_env({"ALERT_HARD_ABS": "5", "ALERT_CRIT_PCT": "x"}) == metrics.Thresholds(hard_abs=5)
    sheet = spark.createDataFrame([("9", "m", "2026-W01", 5), ("9", "m", "2026-W02", 3), ("8", "m", "2026-W01", 9)], "sid string, metric string, week string, value long")
    assert rows(metrics.last_two_weeks(sheet, ["sid"])) == [("8", 9, 0), ("9", 5, 3)]
    new = spark.createDataFrame([("7", "m", "2026-W02", 1)], "sid string, metric string, week string, value long")
    once = metrics.upsert_week(sheet, new, ["sid"])
    assert rows(metrics.upsert_week(once, new, ["sid"])) == rows(once) and once.count() == 3
    for values, want in (([], 0), (["INFO"], 0), (["INFO", "WARNING"], 10), (["CRITICAL", None], 20)):
        assert metrics.verdict(spark.createDataFrame([(v,) for v in values], "severity string")).first()[0] == want
    df = spark.createDataFrame([("g", "x"), ("g", None), ("g", "x")], "k string, v string")
    assert metrics.distinct_metrics(df, ["k"], {"n": ("v", None)}, null_counts=True).first().n == 2


def test_proteome_statuses(spark):
    df = spark.createDataFrame([(False, None, None, False, 0), (True, 0, None, False, 0), (True, 0, None, True, 3), (True, 9, "Orphans ", True, 0), (True, 9, "x", True, 1), (True, 9, None, False, 1)], "exists boolean, bytes long, proteome_type string, has_metadata boolean, candidates int")
    got = [(r.status, r.reason) for r in metrics.proteome_status(df).collect()]
    assert got == [("MISSING", "no species dir"), ("EMPTY", "no-candidates"), ("EMPTY", "fetch-empty"), ("ORPHANS", "ok"), ("SELECTED", "ok"), ("SELECTED", "no-metadata")]


def test_validation(spark):
    types = validate.datatypes([("text", None, None), ("empty", "text", "equals('')"), ("word", "text", r"exclude(/\W/)"), ("number", "word", r"match(/\d+/)"), ("pick", "word", "in('a', 'b')")])
    df = spark.createDataFrame([("1", "7", "a", None), ("2", "7x", "c", "1"), ("3", "", None, "9"), ("3", "a b", "b", "2")], "id string, n string, p string, parent string")
    assert rows(validate.check_datatype(df, "t", "id", "n", "number", types), "row", "value") == [("2", "7x"), ("3", "a b")]
    assert rows(validate.check_datatype(df, "t", "id", "p", "pick", types), "row", "value") == [("2", "c")]
    assert validate.check_primary(df, "t", "id", "id").count() == 2
    assert rows(validate.check_tree(df, "t", "id", "parent"), "row", "rule") == [("3", "from:t.id")]
    loop = spark.createDataFrame([("a", "b"), ("b", "a"), ("c", "a")], "id string, parent string")
    assert rows(validate.check_tree(loop, "t", "id", "parent"), "row", "rule") == [("a", "tree:id"), ("b", "tree:id")]
    assert validate.filter_rows(df, {"id": 'eq."3"', "p": "is.null"}).count() == 1 and validate.typeahead(df, "n", "7").count() == 2
    core = spark.createDataFrame([("OBI:1", "r", "x", None, None, "upper"), ("T:1", "one", "taxonomy", "OBI:1", "bad", "species"), ("T:2", "two", "", "T:9", None, "odd")], "curie string, label string, label_source string, parent string, parent_label string, level string")
    tax = spark.createDataFrame([("T:1", "uno"), ("OBI:1", "r")], "subject string, label string")
    got = {(r.row, r.rule) for r in validate.core_checks(core, tax, "OBI:1").collect()}
    assert got == {("T:2", "path"), ("T:2", "parent"), ("T:1", "parent-label"), ("T:2", "level"), ("T:2", "missing-taxon"), ("T:2", "label-source"), ("T:1", "label")}
    assert rows(validate.fixed_labels(core, tax), "curie", "label")[1] == ("T:1", "uno")


def test_release_watch():
    now, day = datetime(2026, 8, 10, tzinfo=UTC), timedelta(days=1)
    f = incremental.release_decision
    assert [f("b", None, "b", now), f("a", None, "b", now, now - 5 * day), f("a", None, "b", now, now - day / 2), f("a", ("b", now - day), "b", now), f("a", ("b", now - 3 * day), "b", now)] == ["known", "confirmed", "sighted", "settling", "confirmed"]


def test_streams(spark, tmp_path):
    events = spark.createDataFrame([("a", "2026-01-05"), ("a", "2026-01-06"), ("b", "2026-01-12")], "k string, d string").select("k", F.to_timestamp("d").alias("ts"))
    events.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(events.schema).parquet(f"{tmp_path}/in")
    for _ in range(2):
        incremental.weekly_upsert(stream, f"{tmp_path}/out", f"{tmp_path}/c1", ["k"]).awaitTermination()
    assert rows(spark.read.parquet(f"{tmp_path}/out"), "k", "week", "value") == [("a", "2026-W02", 2), ("b", "2026-W03", 1)]
    incremental.classify_new(stream, "k", lambda df: df.select("k", F.lit("c").alias("class")), f"{tmp_path}/known", f"{tmp_path}/c2").awaitTermination()
    events.write.mode("append").parquet(f"{tmp_path}/in")
    incremental.classify_new(stream, "k", lambda df: df.select("k", F.lit("c").alias("class")), f"{tmp_path}/known", f"{tmp_path}/c2").awaitTermination()
    assert rows(spark.read.parquet(f"{tmp_path}/known"), "k") == [("a",), ("b",)]


def test_pages_are_landed_and_read(spark, tmp_path):
    bodies = ['{"results": [{"id": "UP1", "proteinCount": 5}]}', '{"results": [{"id": "UP2"}, {"id": "UP3", "proteomeType": "Excluded"}]}']
    assert readers.land(spark, bodies, f"{tmp_path}/pages") == 2
    assert rows(readers.read_proteome_candidates(spark, f"{tmp_path}/pages/*"), "Proteome ID") == [("UP1",), ("UP2",)]


def test_tables_are_replaced_and_read_by_jdbc(spark, tmp_path):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k long, v string")
    writers.replace_table(a, "own_table")
    writers.replace_table(a.where("k = 2"), "own_table")
    assert rows(spark.table("own_table")) == [(2, "y")]
    spark.sql("drop table own_table")
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    rows_ = spark.createDataFrame([(i, f"a\r{i}") for i in range(20)], "k long, v string")
    rows_.write.jdbc(url, "t")
    got = readers.read_jdbc(spark, url, "SELECT * FROM t", ("k", 0, 20, 3))
    assert got.rdd.getNumPartitions() == 3 and sorted((r[0], r[1]) for r in got.collect()) == [(i, f"a{i}") for i in range(20)]


def test_sizes_of_files_come_from_the_listing(spark, tmp_path):
    (tmp_path / "9").mkdir()
    (tmp_path / "9" / "proteome.fasta").write_text("abc")
    assert [(r.path.rsplit("/", 2)[1:], r.bytes) for r in readers.file_sizes(spark, f"{tmp_path}/*/proteome.fasta").collect()] == [(["9", "proteome.fasta"], 3)]


def test_bit_scores_and_expectations(spark):
    s = "MKVLAAGIVGWWCHHPQ"
    df = spark.createDataFrame([("a", s), ("b", "GGGGGGGGG"), ("c", s[:9])], "id string, seq string")
    q = df.where("id = 'a'").select(F.col("id").alias("qid"), F.col("seq").alias("qseq"))
    got = {r.Subject: r for r in sequences.similarity_join(q, "qid", "qseq", df, "id", "seq").collect()}
    raw = sequences.align(s, s, True)[4]
    bits = (0.267 * raw - math.log(0.041)) / math.log(2)
    assert got["a"]["Bit Score"] == pytest.approx(bits) and got["a"]["E-value"] == pytest.approx(17 * 35 * 2**-bits)
    least = got["c"]["E-value"]
    assert {r.Subject for r in sequences.similarity_join(q, "qid", "qseq", df, "id", "seq", evalue=least / 2).collect()} == {"a"}


def test_core_stages_run_in_order_and_resume(spark, tmp_path, capsys):
    from rootline import __main__ as cli
    from rootline.plans import domain, stages

    t = domain.Tables(spark, "")
    tables = {n: t(n) for n in ("sources", "alignments", "proteome", "classified", "manual_synonyms")}
    tables["manual_parents"] = t("manual")
    tables["peptides"] = t("peptides").withColumns({"Species Taxon ID": F.lit(9).cast("long"), "Species Name": F.lit("Sp"), "Database": F.lit("UniProt"), "Name": F.lit("n")})
    tables["fragments"] = spark.createDataFrame([], "protein_id string, value array<struct<type:string,start:int,end:int,description:string,feature_id:string>>")
    tables["synonyms"] = spark.createDataFrame([("P0001", ["alpha"])], "protein_id string, value array<string>")
    tables["organism_tree"] = spo(spark, [("NCBITaxon:9", "rdf:type", "owl:Class"), ("NCBITaxon:9", "rdfs:label", "Sp")])
    for n, df in tables.items():
        df.write.parquet(f"{tmp_path}/{n}")
    names = [s.name for s in stages.STAGES]
    assert stages.run(spark, str(tmp_path)) == names
    assert stages.run(spark, str(tmp_path)) == []
    assert stages.run(spark, str(tmp_path), ["assignments", "release_counts"], again=True) == ["assignments", "release_counts"]
    # one row for each (sequence, source): peptide 7 repeats 1
    assert ("9", "epitopes", 7) in rows(spark.read.parquet(f"{tmp_path}/release_counts"), "Species Taxon ID", "metric", "value")
    assert spark.read.parquet(f"{tmp_path}/labels").count() > 3
    assert cli.main(["list"]) == 0 and "stage protein_tree" in capsys.readouterr().out
    assert cli.main(["query", "text_expressions", "--data", str(tmp_path), "--out", f"{tmp_path}/out", "--format", "tsv"]) == 0
    assert spark.read.csv(f"{tmp_path}/out", sep="\t", header=True).count() == 7


def test_a_missing_other_node_is_an_error(spark):
    problems = spark.createDataFrame([("NCBITaxon:5", "missing-other", "x"), ("NCBITaxon:1", "label", "y")], "curie string, problem string, detail string")
    with pytest.raises(ValueError, match="NCBITaxon:5"):
        taxonomy.checked_assembly(problems)
    taxonomy.checked_assembly(problems.where("problem = 'label'"))
