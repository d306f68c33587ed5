"""Releases under a manifest, pages as a data source, the index of beginnings, collections and relaxing."""

import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from rootline.operators import ontology, prefixes, statements
from rootline.sources import paged, snapshots


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_a_release_is_read_whole_or_not_at_all(spark, tmp_path):
    at = str(tmp_path / "r")
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "id int, s string")
    b = spark.createDataFrame([], "id int")
    assert snapshots.releases(spark, at) == []
    with pytest.raises(FileNotFoundError):
        snapshots.read_release(spark, at)
    snapshots.publish({"a": a, "b": b}, at, "1")

    broken = a.selectExpr("assert_true(id > 5) as id")  # its tables fail while they are written
    with pytest.raises(Exception, match="is not true"):
        snapshots.publish({"a": a.where("id = 1"), "b": broken}, at, "2")
    got = snapshots.read_release(spark, at, verify=True)
    assert rows(got["a"]) == rows(a) and got["b"].count() == 0 and snapshots.releases(spark, at) == ["1"]

    reader = snapshots.read_release(spark, at)  # opened before the next release, so it goes on with the old one
    snapshots.publish({"a": a.where("id = 2"), "c": b}, at, "2")
    assert rows(reader["a"]) == rows(a) and rows(snapshots.read_release(spark, at)["a"]) == [(2, None)]
    assert snapshots.changed_tables(spark, at, "1", "2") == {"a": "changed", "b": "removed", "c": "added"}
    with pytest.raises(FileExistsError):
        snapshots.publish({"a": a}, at, "2")


def test_a_changed_table_is_told(spark, tmp_path):
    at = str(tmp_path / "r")
    told = snapshots.publish({"a": spark.createDataFrame([(1, "x")], "id int, s string")}, at, "1")
    spark.createDataFrame([(1, "y")], "id int, s string").write.mode("overwrite").parquet(f"{at}/{told['tables']['a']['path']}")
    with pytest.raises(ValueError, match="isn't what its manifest says"):
        snapshots.read_release(spark, at, verify=True)


def test_digests_tell_rows_apart_but_not_orders(spark):
    d = lambda data: snapshots.digest(spark.createDataFrame(data, "a string, b string"))
    assert d([("x", "y"), ("z", None)]) == d([("z", None), ("x", "y")])
    assert len({d([]), d([("x", None)]), d([("x", "")]), d([(None, "x")]), d([("x", None)] * 2), d([("x", None)] * 3)}) == 6


class Answers(BaseHTTPRequestHandler):
    failing: set[str] = set()

    def do_GET(self):  # noqa: N802
        page = int(self.path.rsplit("/", 1)[1])
        code = 404 if page > 9 else 503 if self.path in self.failing else 200
        self.failing.discard(self.path)
        body = json.dumps([{"n": page * 10 + i} for i in range(page % 3)]).encode()
        self.send_response(code)
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *_):
        pass


def test_pages_are_read_in_ranges_and_tried_again(spark):
    server = HTTPServer(("127.0.0.1", 0), Answers)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        paged.register(spark)
        url = f"http://127.0.0.1:{server.server_port}/p/{{page}}"
        Answers.failing |= {"/p/4", "/p/5"}
        read = lambda **o: spark.read.format("pages").options(url=url, pause=0.01, **o).load()
        want = [(p, i, json.dumps({"n": p * 10 + i})) for p in range(3, 10) for i in range(p % 3)]
        got = read(first=0, resume=3, last=9, per_task=2)
        assert got.rdd.getNumPartitions() == 4 and rows(got) == sorted(want, key=repr)
        assert read(first=5, last=4).count() == 0
        with pytest.raises(Exception, match="404"):
            read(first=9, last=10).collect()
    finally:
        server.shutdown()


def test_a_page_that_is_not_there_is_an_error(spark, tmp_path):
    paged.register(spark)
    (tmp_path / "0.json").write_text('{"a": 1}\n\n{"a": "ñ"}\n')
    read = lambda last: spark.read.format("pages").options(url=f"{tmp_path}/{{page}}.json", last=last).load()
    assert rows(read(0)) == [(0, 0, '{"a": 1}'), (0, 1, '{"a": "ñ"}')]
    with pytest.raises(Exception, match="FileNotFoundError"):
        read(1).collect()


def test_beginnings_are_those_of_a_scan_also_after_merging(spark, tmp_path):
    words = [f"{a}{b}{c}" for a in "AaBñ" for b in "xyXZ" for c in ("", "1", "22", "333", " long tail of it")] + ["", None, "A"]
    first, second = (spark.createDataFrame([(w,) for w in ws], "v string") for ws in (words[::2], words[1::2] + words[:7]))
    one, two, whole = (str(tmp_path / n) for n in ("one", "two", "whole"))
    prefixes.write_index(first, "v", one, longest=4, keep=5)
    prefixes.merge_index(spark, one, second, "v", two, longest=4, keep=5)
    prefixes.write_index(first.union(second), "v", whole, longest=4, keep=5)
    cols = ["prefix", "value", "place"]
    assert rows(spark.read.parquet(two).select(cols)) == rows(spark.read.parquet(whole).select(cols))
    for typed in ("a", "AX", "ñx", "q", ""):
        hits = sorted((w for w in set(words) if w and typed and w.lower().startswith(typed.lower())), key=lambda w: (len(w), w))
        assert [r["value"] for r in prefixes.lookup(spark, two, typed, 4).orderBy("place").collect()] == hits[:4]


def test_a_lookup_reads_one_partition_and_building_cuts_before_the_shuffle(spark, tmp_path):
    words = spark.range(500).selectExpr("concat('Customer ', id) as v")
    prefixes.write_index(words, "v", str(tmp_path / "i"))
    hits = prefixes.lookup(spark, str(tmp_path / "i"), "Cust")
    assert "PartitionFilters: [isnotnull(bucket" in hits._jdf.queryExecution().executedPlan().toString() and hits.count() == 40
    assert "WindowGroupLimit [prefix" in prefixes.prefix_rows(words, "v")._jdf.queryExecution().executedPlan().toString().split("Exchange")[1]


def graph(spark, triples):
    return spark.createDataFrame([(1, 0, "g", s, p, o, "_IRI", None) for s, p, o in triples], "assertion int, retraction int, graph string, subject string, predicate string, object string, datatype string, annotation string")


def cells(name, members, end="rdf:nil"):
    out = [(f"_:{name}{i}", "rdf:first", m) for i, m in enumerate(members)]
    return out + [(f"_:{name}{i}", "rdf:rest", f"_:{name}{i + 1}" if i + 1 < len(members) else end) for i in range(len(members))]


def test_collections_long_and_circular(spark):
    g = graph(spark, cells("a", [f"x:{i}" for i in range(70)]) + cells("b", ["x:1"]) + cells("c", ["x:1", "x:2"], "_:c0"))
    got = rows(ontology.list_members(g))
    assert got == sorted([("_:a0", i, f"x:{i}") for i in range(70)] + [("_:b0", 0, "x:1")], key=repr)


def test_relaxing(spark):
    eq, of = "owl:equivalentClass", "owl:intersectionOf"
    g = graph(spark, [("x:a", eq, "_:i"), ("_:i", of, "_:l0"), *cells("l", ["x:b", "_:r", "_:j"]), ("_:j", of, "_:m0"), *cells("m", ["x:c", "_:i"]), ("x:d", eq, "x:e"),
                      ("x:f", eq, "_:r2"), ("_:q", eq, "_:i"), ("_:i", eq, "x:g"), ("x:h", eq, "_:s"), ("_:s", of, "_:n0"), *cells("n", ["x:h", "x:b"])])
    new = ontology.relax(g).where("predicate = 'rdfs:subClassOf'").select("subject", "object")
    want = [(a, b) for a in ("x:a", "x:g") for b in ("x:b", "x:c", "_:r")] + [("x:f", "_:r2"), ("x:h", "x:b")]
    assert rows(new) == sorted(want, key=repr)
    plain = graph(spark, [("x:a", "rdfs:subClassOf", "x:b")])
    assert rows(ontology.relax(plain)) == rows(plain)


def test_relaxing_works_the_statements_out_once(spark):
    """And sends none of them to the driver to be broadcast."""
    seen = spark.sparkContext.accumulator(0)

    def told(x):
        seen.add(1)
        return x

    own = [("x:a", "owl:equivalentClass", "_:e"), ("_:e", "owl:intersectionOf", "_:l"), ("_:l", "rdf:first", "x:b"), ("_:l", "rdf:rest", "_:m"), ("_:m", "rdf:first", "x:c"), ("_:m", "rdf:rest", "rdf:nil")]
    g = spark.createDataFrame([(1, 0, "g", *x, "_IRI", None) for x in own], statements.SCHEMA)
    out = ontology.relax(g.withColumn("subject", F.udf(told)("subject")).coalesce(1))
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    got = rows(out.where("predicate = 'rdfs:subClassOf'").select("subject", "object"))
    assert got == [("x:a", "x:b"), ("x:a", "x:c")] and seen.value == len(own)


def test_rules_broadcast_no_statements(spark):
    own = [("x:a", "rdfs:label", "A"), ("x:a", "x:level", "upper"), ("x:b", "rdfs:label", "B"), ("x:a", "rdfs:subClassOf", "x:b")]
    s = spark.createDataFrame([(1, 0, "g", *x, "xsd:string", None) for x in own], statements.SCHEMA)
    out = ontology.promote_labels(ontology.move_all(s, ["x:a"], "x:top"), "x:level", "x:synonym")
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    want = [("x:a", "rdfs:label", "upper"), ("x:a", "x:synonym", "A"), ("x:a", "x:level", "upper"), ("x:b", "rdfs:label", "B"), ("x:a", "rdfs:subClassOf", "x:top")]
    assert rows(out.select("subject", "predicate", "object")) == sorted(want, key=repr)
