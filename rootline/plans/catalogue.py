"""The registered queries over the driver's tables and, where ANSI SQL can say the same, their oracle."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rootline.functions import expressions as X
from rootline.operators import graph, joins, metrics, minimizers, ontology, prefixes, rank, sequences, statements, tree, validate
from rootline.operators.shared import shared_folder
from rootline.sources import paged, snapshots
from rootline.sources.readers import fasta_header

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def register(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return register


# -- aggregation ------------------------------------------------------------------------------------------------------


@query("SELECT user_id, count(*) AS n FROM events GROUP BY user_id")
def count_star_by_key(t):
    return t("events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


_METRICS = {"orders": "l_orderkey", "parts": "l_partkey", "suppliers": "l_suppkey", "lines": "l_linenumber"}


def _distinct(t):
    spec = {k: (v, None) for k, v in _METRICS.items()} | {"open_orders": ("l_orderkey", F.col("l_linestatus") == "O")}
    return metrics.long_with_total(metrics.distinct_metrics(t("lineitem"), ["l_returnflag"], spec), ["l_returnflag"])


@query("""
WITH g AS (SELECT l_returnflag, count(DISTINCT l_orderkey) orders, count(DISTINCT l_partkey) parts, count(DISTINCT l_suppkey) suppliers,
  count(DISTINCT l_linenumber) lines, count(DISTINCT CASE WHEN l_linestatus = 'O' THEN l_orderkey END) open_orders FROM lineitem GROUP BY 1),
l AS (SELECT l_returnflag, 'orders' AS metric, orders AS value FROM g UNION ALL SELECT l_returnflag, 'parts', parts FROM g
  UNION ALL SELECT l_returnflag, 'suppliers', suppliers FROM g UNION ALL SELECT l_returnflag, 'lines', lines FROM g UNION ALL SELECT l_returnflag, 'open_orders', open_orders FROM g)
SELECT * FROM l UNION ALL SELECT 'TOTAL', metric, CAST(sum(value) AS BIGINT) FROM l GROUP BY metric""")
def distinct_metrics_long(t):
    return _distinct(t)


_MODE = """
WITH c AS (SELECT l_suppkey, l_partkey, count(*) n FROM lineitem GROUP BY 1, 2)
SELECT l_suppkey, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, length(CAST(l_partkey AS VARCHAR)), CAST(l_partkey AS VARCHAR)) rn FROM c) WHERE rn = 1"""


@query(_MODE)
def mode_deterministic(t):
    return rank.mode(t("lineitem"), ["l_suppkey"], "l_partkey")


@query("""
SELECT o_custkey, o_orderkey, o_totalprice, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
  ORDER BY o_totalprice DESC, o_orderpriority DESC NULLS FIRST, o_orderkey) rn FROM orders) WHERE rn = 1""")
def top1_multikey(t):
    order = [F.col("o_totalprice").desc(), F.col("o_orderpriority").desc_nulls_first(), F.col("o_orderkey")]
    return rank.top1(t("orders"), ["o_custkey"], order).select("o_custkey", "o_orderkey", "o_totalprice", "o_orderpriority")


@query("""
SELECT p_brand, count(*) AS n, count(DISTINCT p_type) AS types, bool_or(p_size > 45) AS any_large, bool_and(p_size > 2) AS all_over_two, min(p_size) AS least, max(p_size) AS most FROM part GROUP BY p_brand""")
def any_all_min_max(t):
    return t("part").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("p_type").alias("types"), F.bool_or(F.col("p_size") > 45).alias("any_large"), F.bool_and(F.col("p_size") > 2).alias("all_over_two"), F.min("p_size").alias("least"), F.max("p_size").alias("most"))


@query("SELECT p_name, count(DISTINCT p_brand) AS owners FROM part GROUP BY p_name HAVING count(DISTINCT p_brand) > 1")
def shared_names(t):
    return rank.shared_by_several(t("part"), "p_name", "p_brand")


# -- joins and sets ---------------------------------------------------------------------------------------------------


@query("""
WITH p AS (SELECT l_orderkey, list_sort(list(DISTINCT l_partkey)) AS parts FROM lineitem GROUP BY 1)
SELECT o_orderkey, o_custkey, array_to_string(parts, ',') AS parts FROM orders JOIN p ON o_orderkey = l_orderkey""")
def reduce_then_join(t):
    facts = t("orders").select("o_orderkey", "o_custkey")
    many = t("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey")
    return joins.reduce_then_join(facts, many, ["o_orderkey"], "l_partkey", "parts").withColumn("parts", F.array_join(F.transform("parts", lambda x: x.cast("string")), ","))


@query("""
WITH e AS (SELECT c_nationkey, c_mktsegment, min(c_custkey) v FROM customer WHERE c_custkey % 5 = 0 GROUP BY 1, 2),
r AS (SELECT c_nationkey, min(c_custkey) v FROM customer WHERE c_custkey % 5 = 0 GROUP BY 1)
SELECT c.c_custkey, coalesce(e.v, r.v) AS leader FROM customer c LEFT JOIN e ON c.c_nationkey = e.c_nationkey AND c.c_mktsegment = e.c_mktsegment
LEFT JOIN r ON c.c_nationkey = r.c_nationkey""")
def fallback_join(t):
    c = t("customer")
    leaders = c.where("c_custkey % 5 = 0").select("c_nationkey", "c_mktsegment", F.col("c_custkey").alias("leader"))
    return joins.fallback_join(c.select("c_custkey", "c_nationkey", "c_mktsegment"), leaders, ["c_nationkey", "c_mktsegment"], ["c_nationkey"], "leader").select("c_custkey", "leader")


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def anti_new_rows(t):
    return metrics.new_rows(t("lineitem").select(F.col("l_orderkey").alias("o_orderkey")), t("orders").select("o_orderkey"), "o_orderkey")


@query("SELECT DISTINCT o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 49)")
def semi_in_subquery(t):
    big = t("lineitem").where("l_quantity > 49").select(F.col("l_orderkey").alias("o_orderkey"))
    return t("orders").join(big, "o_orderkey", "left_semi").select("o_custkey").distinct()


@query("""
WITH l AS (SELECT l_orderkey, count(*) n, max(l_extendedprice) top FROM lineitem GROUP BY 1)
SELECT o_orderkey, n AS lines, top FROM orders LEFT JOIN l ON o_orderkey = l_orderkey""")
def full_outer_readd(t):
    best = t("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("lines"), F.max("l_extendedprice").alias("top"))
    return joins.readd(t("orders").select("o_orderkey"), best, "o_orderkey")


@query("""
SELECT n_name FROM nation JOIN customer ON n_nationkey = c_nationkey UNION SELECT n_name FROM nation JOIN supplier ON n_nationkey = s_nationkey""")
def union_distinct_two_branches(t):
    n = t("nation")
    branch = lambda other, key: n.join(other, n.n_nationkey == other[key]).select("n_name")
    return branch(t("customer"), "c_nationkey").union(branch(t("supplier"), "s_nationkey")).distinct()


@query("SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 250000")
def except_ids(t):
    rich = t("orders").where("o_totalprice > 250000").select(F.col("o_custkey").alias("c_custkey"))
    return t("customer").select("c_custkey").distinct().join(rich, "c_custkey", "left_anti")


@query("""
WITH l AS (SELECT DISTINCT p_type FROM part), w AS (SELECT r_regionkey AS id, lower(r_name) AS word FROM region UNION ALL SELECT 100 + s_suppkey, lower(split_part(p_type, ' ', 2)) FROM supplier JOIN part ON p_partkey = s_suppkey)
SELECT p_type, max(id) AS id FROM l JOIN w ON contains(word, lower(p_type)) OR contains(lower(p_type), word) GROUP BY p_type""")
def theta_contains_lastwins(t):
    words = t("region").select(F.col("r_regionkey").cast("long").alias("id"), F.lower("r_name").alias("word"))
    more = t("supplier").join(t("part"), F.col("p_partkey") == F.col("s_suppkey")).select((F.col("s_suppkey") + 100).alias("id"), F.lower(F.split_part("p_type", F.lit(" "), F.lit(2))).alias("word"))
    both = words.union(more)
    return joins.contains_last_wins(t("part").select("p_type").distinct(), "p_type", both.withColumn("ord", F.col("id")), "word", "id", "ord")


# -- releases, weeks, gate --------------------------------------------------------------------------------------------


def _sheet(t):
    return t("events").groupBy("event_type", X.iso_week(F.col("ts")).alias("week")).agg(F.count(F.lit(1)).alias("value"))


_SHEET = "SELECT event_type, strftime(ts, '%G-W%V') AS week, count(*) AS value FROM events GROUP BY 1, 2"


@query(_SHEET)
def weekly_sheet_long(t):
    return _sheet(t)


@query(f"""
WITH s AS ({_SHEET}), last AS (SELECT max(week) w FROM s)
SELECT event_type, week, value FROM s, last WHERE week <> w UNION ALL SELECT event_type, week, value * 2 FROM s, last WHERE week = w AND event_type <> 'click'""")
def weekly_upsert(t):
    sheet = _sheet(t)
    last = sheet.join(F.broadcast(sheet.agg(F.max("week").alias("week"))), "week").where("event_type <> 'click'")
    return metrics.upsert_week(sheet, last.select("event_type", "week", (F.col("value") * 2).alias("value")), ["event_type"])


_GRADED = f"""
WITH s AS ({_SHEET}), w AS (SELECT min(week) a, max(week) b FROM (SELECT DISTINCT week FROM s ORDER BY week DESC LIMIT 2)),
k AS (SELECT event_type, CAST(coalesce(max(CASE WHEN week = a THEN value END), 0) AS BIGINT) AS before, CAST(coalesce(max(CASE WHEN week = b THEN value END), 0) AS BIGINT) AS now
  FROM s, w WHERE week >= a GROUP BY 1),
r AS (SELECT event_type, before, now, FALSE AS total FROM k UNION ALL SELECT 'TOTAL', CAST(sum(before) AS BIGINT), CAST(sum(now) AS BIGINT), TRUE FROM k),
d AS (SELECT *, before - now AS drop_, CASE WHEN before > 0 THEN (before - now) * 100.0 / before ELSE 100.0 END AS pct FROM r)
SELECT event_type, before, now, CASE WHEN drop_ <= 0 THEN NULL WHEN total THEN CASE WHEN drop_ >= 1000 OR pct >= 5 THEN 'CRITICAL' ELSE 'INFO' END
  WHEN drop_ >= 1000 OR (before >= 1000 AND pct >= 10) THEN 'CRITICAL' WHEN drop_ >= 200 OR (before >= 100 AND pct >= 25) THEN 'WARNING' ELSE 'INFO' END AS severity FROM d"""


def _graded(t):
    two = metrics.last_two_weeks(_sheet(t), ["event_type"])
    total = two.agg(F.lit("TOTAL").alias("event_type"), F.sum("before").alias("before"), F.sum("now").alias("now"))
    return two.unionByName(total).withColumn("severity", metrics.severity(F.col("before"), F.col("now"), F.col("event_type") == "TOTAL"))


@query(_GRADED)
def weekly_drop_severity(t):
    return _graded(t)


@query(f"SELECT CASE WHEN bool_or(severity = 'CRITICAL') THEN 20 WHEN bool_or(severity = 'WARNING') THEN 10 ELSE 0 END AS verdict FROM ({_GRADED})")
def gate_verdict(t):
    return metrics.verdict(_graded(t))


_HALVES = """
WITH a AS (SELECT c_custkey, count(*) n, max(o_orderstatus) s FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_orderdate < TIMESTAMP '1995-06-17' GROUP BY 1),
b AS (SELECT c_custkey, count(*) n, max(o_orderstatus) s FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_orderdate >= TIMESTAMP '1995-06-17' GROUP BY 1)"""


def _halves(t):
    o = t("orders").withColumnRenamed("o_custkey", "c_custkey").join(t("customer").select("c_custkey"), "c_custkey", "left_semi")
    half = lambda ok: o.where(ok).groupBy("c_custkey").agg(F.count(F.lit(1)).alias("n"), F.max("o_orderstatus").alias("s"))
    cut = F.lit("1995-06-17").cast("timestamp_ntz")
    return half(F.col("o_orderdate") < cut), half(F.col("o_orderdate") >= cut)


@query(_HALVES + """
SELECT a.c_custkey, 'n' AS field, CAST(a.n AS VARCHAR) AS before, CAST(b.n AS VARCHAR) AS now FROM a JOIN b USING (c_custkey) WHERE a.n <> b.n
UNION ALL SELECT a.c_custkey, 's', a.s, b.s FROM a JOIN b USING (c_custkey) WHERE a.s <> b.s""")
def release_status_diff(t):
    a, b = _halves(t)
    return metrics.status_diff(a, b, "c_custkey", ["n", "s"])


@query("""
WITH a AS (SELECT o_orderpriority p, count(o_orderkey) n FROM orders WHERE o_orderdate < TIMESTAMP '1995-06-17' GROUP BY 1),
b AS (SELECT o_orderpriority p, count(o_orderkey) n FROM orders WHERE o_orderdate >= TIMESTAMP '1995-06-17' GROUP BY 1),
j AS (SELECT coalesce(a.p, b.p) o_orderpriority, coalesce(a.n, 0) AS before, coalesce(b.n, 0) AS now FROM a FULL JOIN b ON a.p = b.p),
u AS (SELECT * FROM j UNION ALL SELECT 'TOTAL', CAST(sum(before) AS BIGINT), CAST(sum(now) AS BIGINT) FROM j)
SELECT *, now - before AS change FROM u""")
def release_count_diff(t):
    o, cut = t("orders"), F.lit("1995-06-17").cast("timestamp_ntz")
    return metrics.count_diff(o.where(F.col("o_orderdate") < cut), o.where(F.col("o_orderdate") >= cut), ["o_orderpriority"], "o_orderkey")


# -- predicates, routing, cascade -------------------------------------------------------------------------------------


@query("""
SELECT doc_id, CASE WHEN text IS NULL OR text = '' THEN 'dropped' WHEN length(text) >= 5 AND NOT regexp_matches(text, '[0-9]') AND n_chars < 1000 THEN 'exact'
 WHEN NOT regexp_matches(text, '[0-9]') THEN 'linear' WHEN n_chars < 4000 THEN 'discontinuous' ELSE 'local' END AS tier FROM documents""")
def route_tiers(t):
    text = F.col("text")
    tiers = [("dropped", X.blank(text)), ("exact", X.eligible_peptide(text) & (F.col("n_chars") < 1000)), ("linear", ~X.discontinuous(text)), ("discontinuous", F.col("n_chars") < 4000)]
    return t("documents").select("doc_id", rank.route(tiers, "local").alias("tier"))


_KINDS = ["PROMO", "ECONOMY", "STANDARD", "SMALL", "MEDIUM", "LARGE"]


@query("""
WITH k AS (SELECT *, split_part(p_type, ' ', 1) AS kind FROM part),
r AS (SELECT *, CASE kind WHEN 'PROMO' THEN 1 WHEN 'ECONOMY' THEN 2 WHEN 'STANDARD' THEN 3 WHEN 'SMALL' THEN 4 WHEN 'MEDIUM' THEN 5 WHEN 'LARGE' THEN 6 ELSE 7 END AS o FROM k)
SELECT p_brand, p_partkey, kind FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY o, p_retailprice DESC, p_partkey) rn FROM r) WHERE rn = 1""")
def cascade_select(t):
    p = t("part").withColumn("kind", F.split_part("p_type", F.lit(" "), F.lit(1)))
    return rank.cascade(p, "p_brand", "kind", _KINDS, [F.col("p_retailprice").desc(), F.col("p_partkey")]).select("p_brand", "p_partkey", "kind")


@query("""
WITH v AS (SELECT p_size, p_partkey, CASE p_partkey % 3 WHEN 0 THEN lower(p_brand) WHEN 1 THEN upper(p_brand) ELSE p_brand END AS symbol FROM part),
f AS (SELECT p_size, symbol, min(p_partkey) k FROM v GROUP BY 1, 2)
SELECT p_size, symbol, row_number() OVER (PARTITION BY p_size, lower(symbol) ORDER BY k, symbol) - 1 AS variant FROM f""")
def ordinal_case_variants(t):
    symbol = F.when(F.col("p_partkey") % 3 == 0, F.lower("p_brand")).when(F.col("p_partkey") % 3 == 1, F.upper("p_brand")).otherwise(F.col("p_brand"))
    return rank.case_variant_ids(t("part").withColumn("symbol", symbol), "p_size", "symbol", "p_partkey")


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier ORDER BY s_acctbal DESC, s_suppkey LIMIT 20")
def top_k_report(t):
    return t("supplier").select("s_suppkey", "s_name", "s_acctbal").orderBy(F.col("s_acctbal").desc(), "s_suppkey").limit(20)


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_annotation(t):
    return t("events").select("event_id", F.get_json_object("props", "$.k").try_cast("long").alias("k"))


_HEADER = "'>' || CASE WHEN c_custkey % 2 = 0 THEN 'sp' ELSE 'tr' END || '|P' || c_custkey || '|' || upper(c_mktsegment) || '_X ' || c_name || ' OS=x OX=' || c_nationkey || ' GN=g.' || (c_custkey % 7) || ' PE=' || (1 + c_custkey % 5) || ' SV=1'"


@query(f"""
WITH h AS (SELECT {_HEADER} AS h FROM customer)
SELECT regexp_extract(h, '^>?(sp|tr)\\|', 1) AS db, regexp_extract(h, '\\|([^|]*)\\|', 1) AS protein_id, regexp_extract(h, '\\|[^|]*\\|(\\S+)', 1) AS entry,
 replace(regexp_extract(h, ' GN=(.+?) PE=', 1), '.', '_') AS gene, CAST(regexp_extract(h, ' PE=([0-9])', 1) AS INTEGER) AS level FROM h""")
def header_parse(t):
    sep = lambda *x: F.concat(*[F.lit(v) if isinstance(v, str) else v for v in x])
    k = F.col("c_custkey")
    header = sep(">", F.when(k % 2 == 0, "sp").otherwise("tr"), "|P", k.cast("string"), "|", F.upper("c_mktsegment"), "_X ", F.col("c_name"), " OS=x OX=", F.col("c_nationkey").cast("string"), " GN=g.", (k % 7).cast("string"), " PE=", (1 + k % 5).cast("string"), " SV=1")
    return t("customer").select(fasta_header(header).alias("f")).select("f.db", "f.protein_id", "f.entry", "f.gene", "f.level")


@query("""
WITH p AS (SELECT p_brand, list(DISTINCT p_type) a, list(DISTINCT p_name) b FROM part GROUP BY 1)
SELECT p_brand, array_to_string(list_sort(list_distinct(list_concat(a, b, [p_brand]))), ', ') AS synonyms FROM p""")
def synonym_assembly(t):
    p = t("part").groupBy("p_brand").agg(F.collect_set("p_type").alias("a"), F.collect_set("p_name").alias("b"))
    return p.select("p_brand", F.array_join(X.union_sorted(F.col("a"), F.col("b"), F.array("p_brand")), ", ").alias("synonyms"))


@query("""
SELECT c_custkey, CASE WHEN length(c_name) <> length(reverse(c_name)) THEN '' ELSE
 array_to_string(list_transform(range(1, length(c_name) + 1), lambda i: CASE WHEN c_name[i] = reverse(c_name)[i] THEN reverse(c_name)[i] ELSE lower(reverse(c_name)[i]) END), '') END AS modified FROM customer""")
def mismatch_lowercase(t):
    return t("customer").select("c_custkey", X.mark_mismatches(F.col("c_name"), F.reverse("c_name")).alias("modified"))


# -- trees ------------------------------------------------------------------------------------------------------------

_EDGES = """
SELECT 'n' || n_nationkey AS child, 'r' || n_regionkey AS parent FROM nation UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey FROM customer
UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey FROM supplier UNION ALL SELECT 'r' || r_regionkey, 'root' FROM region"""


def _edges(t):
    part = lambda df, a, x, b, y: df.select(F.concat(F.lit(a), F.col(x).cast("string")).alias("child"), F.concat(F.lit(b), F.col(y).cast("string")).alias("parent"))
    regions = t("region").select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("child"), F.lit("root").alias("parent"))
    return part(t("nation"), "n", "n_nationkey", "r", "n_regionkey").union(part(t("customer"), "c", "c_custkey", "n", "c_nationkey")).union(part(t("supplier"), "s", "s_suppkey", "n", "s_nationkey")).union(regions)


_CLOSURE = f"""
WITH RECURSIVE e AS ({_EDGES}), nodes AS (SELECT child AS node FROM e UNION SELECT parent FROM e),
c(ancestor, node, depth) AS (SELECT node, node, 0 FROM nodes UNION ALL SELECT c.ancestor, e.child, c.depth + 1 FROM c JOIN e ON e.parent = c.node)"""


@query(_CLOSURE + " SELECT ancestor, node, depth FROM c")
def closure_pairs(t):
    return graph.closure(_edges(t))


@query(_CLOSURE + " SELECT node FROM nodes WHERE node NOT IN (SELECT node FROM c WHERE ancestor = 'r1')")
def root_reachability(t):
    e = _edges(t)
    nodes = e.select(F.col("child").alias("node")).union(e.select("parent")).distinct()
    return nodes.join(tree.below(tree.labels(e), "r1"), "node", "left_anti")


@query(_CLOSURE + """
, m AS (SELECT c.node, c.ancestor, c.depth FROM c WHERE c.depth > 0 AND (c.ancestor LIKE 'r%' OR c.ancestor IN ('n1', 'n3', 'n5', 'n7')))
SELECT node, ancestor AS found FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY depth, ancestor) rn FROM m) WHERE rn = 1""")
def nearest_ancestor(t):
    e = _edges(t)
    wanted = e.select(F.col("parent").alias("node")).where("node like 'r%' or node in ('n1', 'n3', 'n5', 'n7')")
    return tree.nearest(graph.first_parents(e), wanted)


@query(_CLOSURE + """
, v AS (SELECT 'c' || o_custkey AS node, count(*) AS n FROM orders GROUP BY 1)
SELECT c.ancestor AS node, CAST(sum(v.n) AS BIGINT) AS total FROM c JOIN v ON c.node = v.node GROUP BY 1""")
def subtree_rollup(t):
    values = t("orders").groupBy(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("node")).agg(F.count(F.lit(1)).alias("n"))
    return tree.subtree_sums(_edges(t), values, "n")


@query(f"""
WITH RECURSIVE e AS ({_EDGES}), w(node, path, depth) AS (SELECT 'root', ['root'], 0 UNION ALL SELECT e.child, list_append(w.path, e.child), depth + 1 FROM w JOIN e ON e.parent = w.node),
n AS (SELECT *, row_number() OVER (ORDER BY path) - 1 AS pre FROM w)
SELECT a.node, CAST(a.depth AS BIGINT) AS depth, a.pre, (SELECT count(*) FROM n b WHERE b.path[a.depth + 1] = a.node) AS size FROM n a""")
def depth_first_labels(t):
    """Every node's place in depth-first order, and how many follow below it."""
    return tree.labels(_edges(t)).select("node", "depth", "pre", "size")


@query(_CLOSURE + """
, s AS (SELECT 's' || s_suppkey AS node, s_acctbal FROM supplier), v AS (SELECT 'n' || n_nationkey AS top FROM nation WHERE n_nationkey < 5 UNION ALL SELECT 'r' || r_regionkey FROM region)
SELECT top, count(*) AS suppliers FROM v JOIN c ON c.ancestor = v.top JOIN s ON s.node = c.node GROUP BY top""")
def suppliers_below(t):
    """Ancestor tests by numbers: the suppliers in the subtree of some nations and of all regions."""
    own = tree.labels(_edges(t))
    top = own.where("node like 'r_' or node in ('n0', 'n1', 'n2', 'n3', 'n4')").select(F.col("node").alias("top"), "pre", (F.col("pre") + F.col("size")).alias("end"))
    # a sorted union instead of a join by range: each supplier counts once, and a top takes the difference of two counts
    marks = own.where("node like 's%'").select("pre", F.lit(1).alias("n"), F.lit(None).cast("string").alias("top"), F.lit(0).alias("sign"))
    edge = lambda at, sign: top.select(F.col(at).alias("pre"), F.lit(0).alias("n"), "top", F.lit(sign).alias("sign"))
    counted = tree.running(marks.union(edge("pre", -1)).union(edge("end", 1)), "pre", "n", "so_far")
    return counted.where("top is not null").groupBy("top").agg(F.sum(F.col("sign") * F.col("so_far")).cast("long").alias("suppliers")).where("suppliers > 0")


@query(f"""
WITH RECURSIVE e AS ({_EDGES}), x AS (SELECT * FROM e UNION SELECT a.child, b.parent FROM e a JOIN e b ON a.parent = b.child WHERE a.child LIKE 'c%'),
up(node, above) AS (SELECT child, parent FROM x UNION SELECT up.node, x.parent FROM up JOIN x ON x.child = up.above)
SELECT child, parent FROM x WHERE NOT EXISTS (SELECT 1 FROM x y JOIN up ON up.node = y.parent WHERE y.child = x.child AND up.above = x.parent AND y.parent <> x.parent)""")
def transitive_reduction(t):
    e = _edges(t)
    shortcuts = e.where("child like 'c%'").join(e.select(F.col("child").alias("parent"), F.col("parent").alias("above")), "parent").select("child", F.col("above").alias("parent"))
    return graph.reduction(e.union(shortcuts))


_TREE = """
SELECT 'x:' || child AS subject, 'rdf:type' AS predicate, 'owl:Class' AS object, '_IRI' AS datatype FROM e UNION ALL
SELECT 'x:' || child, 'rdfs:label', 'Node ' || child, 'xsd:string' FROM e UNION ALL SELECT 'x:' || child, 'rdfs:subClassOf', 'x:' || parent, '_IRI' FROM e UNION ALL
SELECT 'x:' || child, 'x:level', CASE WHEN child LIKE 'r%' THEN 'upper' WHEN child LIKE 'n%' THEN 'species' ELSE 'lower' END, 'xsd:string' FROM e"""


def _tree(t):
    node, up = F.concat(F.lit("x:"), "child"), F.concat(F.lit("x:"), "parent")
    level = F.when(F.col("child").like("r%"), "upper").when(F.col("child").like("n%"), "species").otherwise("lower")
    return statements.emit(_edges(t), [*statements.owl_class(node, F.concat(F.lit("Node "), "child"), up), statements.triple(node, "x:level", level, statements.STRING)])


_SPO = ["subject", "predicate", "object", "datatype"]


@query(f"WITH e AS ({_EDGES}) {_TREE}")
def tree_statements(t):
    return statements.checked(_tree(t)).select(*_SPO)


@query(f"""
WITH e AS ({_EDGES}), s AS ({_TREE}), p AS (SELECT * FROM s WHERE subject NOT IN (SELECT subject FROM s WHERE object IN ('lower', '')))
SELECT subject, predicate, CASE WHEN predicate = 'rdfs:subClassOf' AND object IN ('x:r0', 'x:r2') THEN 'x:top' WHEN predicate = 'rdfs:label' THEN regexp_replace(object, '^Node', 'Group') ELSE object END AS object, datatype FROM p""")
def prune_subjects(t):
    kept = statements.reparent(statements.prune(_tree(t)), ["x:r0", "x:r2"], "x:top")
    return statements.relabel(kept, "^Node", "Group").select(*_SPO)


@query(f"""
WITH e AS ({_EDGES}), s AS ({_TREE}), d AS (SELECT 'x:c' || c_custkey AS subject FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1) UNION ALL
SELECT 'x:s' || s_suppkey FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1) UNION ALL SELECT 'x:n' || n_nationkey FROM nation WHERE n_regionkey = 1 UNION ALL SELECT 'x:r1')
SELECT * FROM s WHERE subject NOT IN (SELECT subject FROM d)""")
def remove_branch(t):
    return ontology.remove_with_descendants(_tree(t), ["x:r1"]).select(*_SPO)


@query(f"""
WITH e AS ({_EDGES}), s AS ({_TREE})
SELECT * FROM s WHERE subject IN ('x:n3', 'x:r' || (SELECT n_regionkey FROM nation WHERE n_nationkey = 3))""")
def extract_upward(t):
    return ontology.extract_upward(_tree(t), ["x:n3"]).select(*_SPO)


@query(f"""
WITH e AS ({_EDGES}), s AS ({_TREE}),
a AS (SELECT subject, predicate, CASE WHEN predicate = 'rdfs:subClassOf' AND subject IN ('x:n1', 'x:n2') THEN 'x:top' ELSE object END AS object, datatype FROM s),
b AS (SELECT * FROM a UNION SELECT subject, 'rdfs:subClassOf', 'x:even', '_IRI' FROM a WHERE predicate = 'rdfs:label' AND starts_with(object, 'Node n2')),
l AS (SELECT * FROM b WHERE predicate = 'x:level'), old AS (SELECT subject, object FROM b WHERE predicate = 'rdfs:label' AND subject IN (SELECT subject FROM l))
SELECT * FROM b WHERE NOT (predicate = 'rdfs:label' AND subject IN (SELECT subject FROM l))
UNION SELECT subject, 'rdfs:label', object, 'xsd:string' FROM l UNION SELECT subject, 'oio:hasExactSynonym', object, 'xsd:string' FROM old""")
def update_rules(t):
    s = _tree(t)
    s = ontology.move_all(s, ["x:n1", "x:n2"], "x:top")
    s = ontology.add_parent_by_label(s, "Node n2", "x:even")
    return ontology.promote_labels(s, "x:level", "oio:hasExactSynonym").select(*_SPO)


@query(f"""
WITH e AS ({_EDGES}), s AS ({_TREE}), a AS (SELECT subject, predicate, object FROM s WHERE subject LIKE 'x:n%'), b AS (SELECT subject, predicate, CASE WHEN predicate = 'rdfs:label' THEN upper(object) ELSE object END AS object FROM a)
SELECT coalesce(a.subject, b.subject) AS subject, coalesce(a.predicate, b.predicate) AS predicate, coalesce(a.object, b.object) AS object,
 CASE WHEN a.subject IS NOT NULL AND b.subject IS NOT NULL THEN 'both' WHEN a.subject IS NOT NULL THEN 'left' ELSE 'right' END AS side
FROM a FULL JOIN b ON a.subject = b.subject AND a.predicate = b.predicate AND a.object = b.object""")
def compare_trees(t):
    a = _tree(t).where("subject like 'x:n%'")
    b = a.withColumn("object", F.when(F.col("predicate") == "rdfs:label", F.upper("object")).otherwise(F.col("object")))
    return statements.compare(a, b)


#: (subject, predicate, object, for which parts): each part is equivalent to an intersection of its type, a restriction of its
#: size and, for even sizes, a nested intersection of its brand and x:stock. The expressions are the same in both dialects.
_AXIOMS = [
    ("concat('x:p', p_partkey)", "owl:equivalentClass", "concat('_:e', p_partkey)", "p_size % 3 <> 0"),
    ("concat('_:e', p_partkey)", "owl:equivalentClass", "concat('x:p', p_partkey)", "p_size % 3 = 0"),
    ("concat('_:e', p_partkey)", "owl:intersectionOf", "concat('_:l0.', p_partkey)", "true"),
    ("concat('_:l0.', p_partkey)", "rdf:first", "concat('x:type-', lower(p_type))", "true"),
    ("concat('_:l0.', p_partkey)", "rdf:rest", "concat('_:l1.', p_partkey)", "true"),
    ("concat('_:l1.', p_partkey)", "rdf:first", "concat('_:size', p_size)", "true"),
    ("concat('_:l1.', p_partkey)", "rdf:rest", "'rdf:nil'", "p_size % 2 = 1"),
    ("concat('_:l1.', p_partkey)", "rdf:rest", "concat('_:l2.', p_partkey)", "p_size % 2 = 0"),
    ("concat('_:l2.', p_partkey)", "rdf:first", "concat('_:n', p_brand)", "p_size % 2 = 0"),
    ("concat('_:l2.', p_partkey)", "rdf:rest", "'rdf:nil'", "p_size % 2 = 0"),
    ("concat('_:n', p_brand)", "owl:intersectionOf", "concat('_:k0.', p_brand)", "true"),
    ("concat('_:k0.', p_brand)", "rdf:first", "concat('x:', p_brand)", "true"),
    ("concat('_:k0.', p_brand)", "rdf:rest", "concat('_:k1.', p_brand)", "true"),
    ("concat('_:k1.', p_brand)", "rdf:first", "'x:stock'", "true"),
    ("concat('_:k1.', p_brand)", "rdf:rest", "'rdf:nil'", "true"),
    ("concat('x:p', p_partkey)", "rdfs:subClassOf", "'x:part'", "p_size % 5 = 0"),
    ("concat('x:p', p_partkey)", "owl:equivalentClass", "concat('x:same-', p_partkey)", "p_size % 7 = 0"),
]


def _axioms(t):
    rows = F.array(*[F.struct(F.expr(a).alias("subject"), F.lit(p).alias("predicate"), F.expr(b).alias("object"), F.expr(c).alias("there")) for a, p, b, c in _AXIOMS])
    kept = t("part").select(F.explode(F.filter(rows, lambda x: x["there"])).alias("x")).select("x.subject", "x.predicate", "x.object").distinct()
    return kept.withColumns({"assertion": F.lit(1), "retraction": F.lit(0), "graph": F.lit("parts"), "datatype": F.lit(statements.IRI), "annotation": F.lit(None).cast("string")})


@query(f"""
WITH RECURSIVE g AS ({" UNION ".join(f"SELECT {a} AS subject, '{p}' AS predicate, {b} AS object FROM part WHERE {c}" for a, p, b, c in _AXIOMS)}),
m(node, cell) AS (SELECT subject, object FROM g WHERE predicate = 'owl:intersectionOf' UNION ALL SELECT m.node, g.object FROM m JOIN g ON g.subject = m.cell AND g.predicate = 'rdf:rest' WHERE g.object <> 'rdf:nil'),
members AS (SELECT DISTINCT node, g.object AS member FROM m JOIN g ON g.subject = m.cell AND g.predicate = 'rdf:first'),
q AS (SELECT subject, object FROM g WHERE predicate = 'owl:equivalentClass' UNION SELECT object, subject FROM g WHERE predicate = 'owl:equivalentClass'),
x(subject, node) AS (SELECT subject, object FROM q WHERE NOT starts_with(subject, '_:') AND starts_with(object, '_:') UNION ALL SELECT x.subject, member FROM x JOIN members USING (node))
SELECT subject, node AS object FROM x WHERE node NOT IN (SELECT node FROM members) UNION SELECT subject, object FROM g WHERE predicate = 'rdfs:subClassOf'""")
def relaxed_axioms(t):
    """Equivalences with (nested) intersections as subclass axioms."""
    return ontology.relax(_axioms(t)).where("predicate = 'rdfs:subClassOf'").select("subject", "object")


@query(f"""
WITH RECURSIVE g AS ({" UNION ".join(f"SELECT {a} AS subject, '{p}' AS predicate, {b} AS object FROM part WHERE {c}" for a, p, b, c in _AXIOMS)}),
m(head, cell, place) AS (SELECT subject, subject, 0 FROM g WHERE predicate = 'rdf:first' AND subject NOT IN (SELECT object FROM g WHERE predicate = 'rdf:rest')
 UNION ALL SELECT m.head, g.object, place + 1 FROM m JOIN g ON g.subject = m.cell AND g.predicate = 'rdf:rest' WHERE g.object <> 'rdf:nil')
SELECT head, CAST(place AS BIGINT) AS place, g.object AS member FROM m JOIN g ON g.subject = m.cell AND g.predicate = 'rdf:first'""")
def collection_members(t):
    return ontology.list_members(_axioms(t)).select("head", F.col("place").cast("long").alias("place"), "member")


# -- releases, pages, typeahead ---------------------------------------------------------------------------------------


@query("SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus = 'O' THEN 'waiting' ELSE 'done' END AS half FROM orders")
def published_release(t):
    """The newest of two releases of two tables, read back whole through its manifest, counts and digests compared."""
    o = t("orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    at = f"{shared_folder(o.sparkSession)}/published-{uuid.uuid4().hex}"
    waiting = F.col("o_orderstatus") == "O"
    snapshots.publish({"waiting": o.where(waiting)}, at, "2026_01")
    snapshots.publish({"waiting": o.where(waiting), "done": o.where(~waiting)}, at, "2026_02")
    got = snapshots.read_release(o.sparkSession, at, verify=True)
    parts = [df.select("o_orderkey", "o_totalprice", F.lit(name).alias("half")) for name, df in got.items()]
    return parts[0].unionByName(parts[1])


@query("SELECT CAST(page_id // 20 AS BIGINT) AS page, page_id, url, CAST(length(html) AS BIGINT) AS n_chars FROM pages WHERE page_id // 20 >= 2")
def landed_pages(t):
    """Pages of 20 records each, landed as JSON and read from the third one on as a data source, in parallel ranges."""
    p = t("pages").select("page_id", "url", F.length("html").cast("long").alias("n_chars"))
    spark = p.sparkSession
    at = f"{shared_folder(spark)}/landed-{uuid.uuid4().hex}"
    rows = p.select(F.to_json(F.struct("page_id", "url", "n_chars")).alias("record"), F.floor(F.col("page_id") / 20).alias("page"))
    rows.repartition("page").write.partitionBy("page").text(at)
    paged.register(spark)
    last = rows.agg(F.max("page")).first()[0]
    read = spark.read.format("pages").options(url=at + "/page={page}", resume=2, last=last, per_task=4).load()
    return read.select("page", F.from_json("record", "page_id long, url string, n_chars long").alias("r")).select("page", "r.*")


_TYPED = "SELECT DISTINCT lower(substr(p_name, 1, CAST(1 + p_partkey % 5 AS INTEGER))) AS typed FROM part UNION SELECT DISTINCT lower(substr(c_name, 1, CAST(9 + c_custkey % 4 AS INTEGER))) FROM customer"


@query(f"""
WITH v AS (SELECT DISTINCT p_name AS value FROM part UNION SELECT DISTINCT c_name FROM customer), q AS ({_TYPED})
SELECT typed, value, place FROM (SELECT typed, value, row_number() OVER (PARTITION BY typed ORDER BY length(value), value) AS place FROM q JOIN v ON starts_with(lower(value), typed)) WHERE place <= 40""")
def typeahead_index(t):
    """The best 40 names for each beginning: an index of the names of parts, into which customers' names are merged."""
    part, customer = t("part"), t("customer")
    spark = part.sparkSession
    at = f"{shared_folder(spark)}/typeahead-{uuid.uuid4().hex}"
    prefixes.write_index(part, "p_name", f"{at}/1")
    prefixes.merge_index(spark, f"{at}/1", customer, "c_name", f"{at}/2")
    cut = lambda df, c, k, least, n: df.select(F.lower(F.expr(f"substring({c}, 1, cast({least} + {k} % {n} as int))")).alias("typed")).distinct()
    typed = cut(part, "p_name", "p_partkey", 1, 5).union(cut(customer, "c_name", "c_custkey", 9, 4)).distinct()
    return prefixes.lookup_all(spark.read.parquet(f"{at}/2"), typed, "typed").select("typed", "value", F.col("place").cast("long").alias("place"))


# -- sequences --------------------------------------------------------------------------------------------------------


def _hits(t):
    return sequences.peptide_join(t("benchmark").select("text"), "text", t("documents"), "doc_id", "text", k=12)


_HITS = """
WITH q AS (SELECT DISTINCT text AS query FROM benchmark WHERE length(text) >= 12), c AS (SELECT query, doc_id AS protein, text FROM q JOIN documents ON contains(text, query)),
h AS (SELECT query, protein, unnest(list_filter(range(1, length(text) - length(query) + 2), lambda i: substr(text, i, length(query)) = query)) AS start FROM c)"""


@query(_HITS + ' SELECT query, protein, start, start + length(query) - 1 AS "end" FROM h')
def kmer_exact_join(t):
    return _hits(t).withColumns({"start": F.col("start").cast("long"), "end": F.col("end").cast("long")})


@query(_HITS + ' SELECT query, protein, start, start + length(query) - 1 AS "end" FROM h')
def stored_index_join(t):
    """The same search twice over an index that is written once, and joined where it lies."""
    d, name = t("documents"), f"seeds_{uuid.uuid4().hex}"
    index = minimizers.write_index(d, "doc_id", "text", 12, 16, name, f"{shared_folder(d.sparkSession)}/{name}")
    q = t("benchmark").select(F.col("text").alias("query")).distinct()
    parts = [sequences.peptide_join(q.where(F.pmod(F.crc32("query"), F.lit(2)) == i), "query", d, "doc_id", "text", 12, 16, index=index) for i in (0, 1)]
    return parts[0].union(parts[1]).withColumns({"start": F.col("start").cast("long"), "end": F.col("end").cast("long")})


@query(_HITS + """
, b AS (SELECT h.*, d.n_chars, d.lang FROM h JOIN documents d ON d.doc_id = h.protein)
SELECT item_id, protein AS doc_id, start, start + length(query) - 1 AS "end" FROM benchmark JOIN (SELECT *, row_number() OVER (PARTITION BY query
  ORDER BY CASE WHEN lang = 'en' THEN 0 ELSE 1 END, n_chars, protein, start) rn FROM b) ON query = text WHERE rn = 1""")
def flagship_assignment(t):
    """Each benchmark passage's best document: by language, length, id and position."""
    best = _hits(t).join(t("documents").select(F.col("doc_id").alias("protein"), "n_chars", "lang"), "protein")
    best = rank.top1_combined(best, ["query"], [F.when(F.col("lang") == "en", 0).otherwise(1), F.col("n_chars"), F.col("protein"), F.col("start")], ["protein", "start", "end"])
    out = t("benchmark").join(best, F.col("text") == F.col("query"))
    return out.select("item_id", F.col("protein").alias("doc_id"), F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))


@query("""
SELECT item_id AS epitope, doc_id AS protein FROM benchmark b JOIN documents d ON length(b.text) > 4 AND
 upper(substr(d.text, 1, 1)) = upper(substr(b.text, 1, 1)) AND upper(substr(d.text, 2, 1)) = upper(substr(b.text, 2, 1)) AND upper(substr(d.text, 4, 1)) = upper(substr(b.text, 4, 1))""")
def residue_position_match(t):
    token = lambda p: F.struct(F.substring("text", p, 1).alias("aa"), F.lit(p).alias("pos"))
    e = t("benchmark").where(F.length("text") > 4).select(F.col("item_id").alias("epitope"), F.array(token(1), token(2), token(4)).alias("tokens"))
    return sequences.residue_match(e, "epitope", "tokens", t("documents"), "doc_id", "text", any_case=True)


def _pairs(t, local):
    p = t("part").select("p_partkey", X.clean_sequence(F.col("p_name")).alias("a"), X.clean_sequence(F.col("p_type")).alias("b"))
    return sequences.aligned(p, "a", "b", local)


@query()
def align_global(t):
    return _pairs(t, False)


@query()
def align_local(t):
    return _pairs(t, True)


def _wave_sql(local: bool, pairs: str) -> str:
    """CTEs from ``pairs`` (a, b) to scored (a, b, score): alignment scores, a row of the table at a time: ``up`` are the scores that end in a gap
    in b, ``pre`` those that end in no gap in a; a gap in a ends at j after starting behind any earlier k."""
    letters, m = sequences.LETTERS, ", ".join(sequences.BLOSUM62.split())
    o, e, unknown = sequences.OPEN, sequences.EXTEND, sequences.letter_scores()[0, 0]
    floor = "0" if local else "-1000000000"
    edge = "0" if local else f"-{o} - {e} * CAST(i AS INTEGER)"
    return f"""
 pair AS (SELECT DISTINCT a, b, '{letters}' AS letters, [{m}] AS m FROM {pairs} WHERE a IS NOT NULL AND b IS NOT NULL),
 wave AS (
  SELECT a, b, letters, m, 0 AS i, list_transform(range(length(b) + 1), lambda j: CASE WHEN j = 0 THEN 0 ELSE greatest({floor}, -{o} - {e} * (j - 1)) END) AS best, list_transform(range(length(b) + 1), lambda j: CAST(-1000000000 AS BIGINT)) AS up, CAST(0 AS BIGINT) AS top FROM pair
  UNION ALL
  SELECT a, b, letters, m, i + 1, now, ups, greatest(top, list_max(now)) FROM (
   SELECT *, list_transform(range(length(b) + 1), lambda j: greatest({floor}, pre[j + 1], list_max(list_concat([CAST(-1000000000 AS BIGINT)], list_transform(range(j), lambda k: pre[k + 1] - {o} - {e} * (j - k - 1)))))) AS now FROM (
    SELECT *, list_transform(range(length(b) + 1), lambda j: CASE WHEN j = 0 THEN {edge} ELSE greatest({floor}, ups[j + 1], best[j] + CASE WHEN strpos(letters, substr(a, i + 1, 1)) = 0 OR strpos(letters, substr(b, CAST(j AS INTEGER), 1)) = 0 THEN {unknown} ELSE m[(strpos(letters, substr(a, i + 1, 1)) - 1) * {len(letters)} + strpos(letters, substr(b, CAST(j AS INTEGER), 1))] END) END) AS pre FROM (
     SELECT *, list_transform(range(length(b) + 1), lambda j: CASE WHEN j = 0 THEN {edge} ELSE greatest(best[j + 1] - {o}, up[j + 1] - {e}) END) AS ups FROM wave WHERE i < length(a))))),
 scored AS (SELECT a, b, CAST({"top" if local else "best[length(b) + 1]"} AS INTEGER) AS score FROM wave WHERE i = length(a))"""


_CLEAN = "nullif(regexp_replace(upper({}), '[^A-Z]', '', 'g'), '')"


def _score_sql(local: bool) -> str:
    return f"""
WITH RECURSIVE clean AS (SELECT p_partkey, {_CLEAN.format("p_name")} AS a, {_CLEAN.format("p_type")} AS b FROM part), {_wave_sql(local, "clean")}
SELECT p_partkey, scored.score FROM clean LEFT JOIN scored USING (a, b)"""


@query(_score_sql(False))
def align_global_scores(t):
    return _pairs(t, False).select("p_partkey", "score")


@query(_score_sql(True))
def align_local_scores(t):
    return _pairs(t, True).select("p_partkey", "score")


@query(_score_sql(False))
def align_text_scores(t):
    """The scores of the aligned texts themselves, gap by gap and letter by letter."""
    return _pairs(t, False).select("p_partkey", sequences.text_score(F.col("aligned_a"), F.col("aligned_b")).alias("score"))


@query()
def similarity_search(t):
    p = t("part").select(F.col("p_partkey").cast("string").alias("id"), X.clean_sequence(F.concat("p_name", "p_type")).alias("seq"))
    q = t("supplier").join(p, p.id == F.col("s_suppkey").cast("string")).select("id", "seq")
    return sequences.similarity_join(q.withColumnRenamed("id", "qid").withColumnRenamed("seq", "qseq"), "qid", "qseq", p, "id", "seq", top=5)


_EXPECTED = 1.0


@query(f"""
WITH RECURSIVE p AS (SELECT CAST(p_partkey AS VARCHAR) AS id, {_CLEAN.format("p_name || p_type")} AS seq FROM part),
 q AS (SELECT id, seq FROM p JOIN supplier ON id = CAST(s_suppkey AS VARCHAR)),
 met AS (SELECT DISTINCT q.seq AS a, p.seq AS b FROM (SELECT DISTINCT seq FROM q) q, (SELECT DISTINCT seq FROM p) p), {_wave_sql(True, "met")}
SELECT q.id AS "Query", p.id AS "Subject", score, round((({sequences.LAMBDA} * score - ln({sequences.KAPPA})) / ln(2)), 6) AS bits FROM q JOIN scored ON q.seq = a JOIN p ON p.seq = b
WHERE length(a) * (SELECT sum(length(seq)) FROM p) * power(2.0, -(({sequences.LAMBDA} * score - ln({sequences.KAPPA})) / ln(2))) <= {_EXPECTED}""")
def similarity_hits(t):
    """All hits up to an E-value of 1, by word hits and extensions; the oracle aligns all pairs."""
    p = t("part").select(F.col("p_partkey").cast("string").alias("id"), X.clean_sequence(F.concat("p_name", "p_type")).alias("seq"))
    q = t("supplier").join(p, p.id == F.col("s_suppkey").cast("string")).select(F.col("id").alias("qid"), F.col("seq").alias("qseq"))
    hits = sequences.similarity_join(q, "qid", "qseq", p, "id", "seq", top=None, evalue=_EXPECTED)
    score = F.round((F.col("Bit Score") * math.log(2) + math.log(sequences.KAPPA)) / sequences.LAMBDA).cast("int")
    return hits.select("Query", "Subject", score.alias("score"), F.round("Bit Score", 6).alias("bits"))


# -- validation -------------------------------------------------------------------------------------------------------


@query("""
SELECT 'customer' AS "table", CAST(c_custkey AS VARCHAR) AS "row", 'c_mktsegment' AS "column", c_mktsegment AS value, 'datatype:segment' AS rule FROM customer WHERE NOT regexp_full_match(c_mktsegment, '[A-Z]+') OR c_mktsegment NOT IN ('BUILDING', 'MACHINERY')
UNION ALL SELECT 'customer', CAST(c_custkey AS VARCHAR), 'c_nationkey', CAST(c_nationkey AS VARCHAR), 'from:nation.n_nationkey' FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 4)
UNION ALL SELECT 'customer', CAST(c_custkey AS VARCHAR), 'c_name', c_name, 'unique' FROM customer WHERE c_name IN (SELECT c_name FROM customer GROUP BY 1 HAVING count(*) > 1)""")
def validation_messages(t):
    types = validate.datatypes([("text", None, None), ("upper", "text", "match(/[A-Z]+/)"), ("segment", "upper", "in('BUILDING', 'MACHINERY')")])
    c = t("customer")
    out = validate.check_datatype(c, "customer", "c_custkey", "c_mktsegment", "segment", types)
    out = out.union(validate.check_foreign(c, "customer", "c_custkey", "c_nationkey", t("nation").where("n_regionkey < 4"), "nation.n_nationkey", "n_nationkey"))
    return out.union(validate.check_unique(c, "customer", "c_custkey", "c_name")).select("table", "row", "column", "value", "rule")
