"""The domain operators over tables derived from the driver's: assignment, selection, mapping, links, identifiers.

A derived table is written once, as expressions that mean the same in Spark and in the oracle's dialect; the query and the
oracle are those of ``domain``, where they also run over small fixed tables with the rare cases.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rootline.operators.shared import shared_folder
from rootline.plans import domain

_SEQUENCE = "upper(replace(concat(p_name, p_type), ' ', ''))"
_KINDS = "CASE c_custkey % 8 WHEN 0 THEN 'Strange' WHEN 1 THEN 'Redundant proteome' WHEN 2 THEN 'Non Reference proteome' ELSE 'Other proteome' END"
_LOCAL = "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE concat('P', o_custkey + o_orderkey % 7) END"
_OWN = lambda text: f"CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE {text} END"
_NUMBER = "(o_custkey + o_orderkey % 7)"

#: name -> (from, columns as in the fixture of the same name: expressions in their order)
DERIVED: dict[str, tuple[str, list[str]]] = {
    "proteome": ("part", [
        "CASE WHEN p_size % 3 = 0 THEN 'sp' ELSE 'tr' END", "CASE WHEN p_size % 7 = 0 THEN '' ELSE concat('g', p_brand, p_size % 5) END", "concat('P', p_partkey)", "concat(upper(p_type), '_', p_size)", "p_name",
        "1 + p_partkey % 5", _SEQUENCE,
    ]),
    "sources": ("supplier", ["concat('S', s_suppkey)", "s_suppkey % 30"]),
    "alignments": ("lineitem", [
        "concat('S', l_suppkey)", "CASE WHEN l_linenumber % 5 = 0 THEN concat('X', l_partkey) WHEN l_linenumber % 2 = 0 THEN concat('sp|P', l_partkey, '|X') ELSE concat('P', l_partkey) END", "50 + l_orderkey % 51",
        "l_orderkey % 40",
    ]),
    "manual": ("supplier", ["concat('S', s_suppkey * 3)", "concat('P', s_suppkey)"]),
    "classified": ("events", [
        "concat('S', user_id * 2)", "CASE WHEN event_id % 5 = 0 THEN NULL ELSE upper(event_type) END", "CASE WHEN event_id % 3 = 0 THEN 'alpha' END", "CASE WHEN event_id % 7 = 0 THEN concat('A*0', event_id % 9) END",
    ]),
    "peptides": ("lineitem JOIN part ON p_partkey = l_partkey", ["l_orderkey * 10 + l_linenumber", f"substr({_SEQUENCE}, 1 + CAST(l_orderkey % 4 AS INT), 6)", "concat('S', l_suppkey)"]),
    "allergen_hits": ("lineitem", ["concat('P', l_partkey)", "concat('a', l_suppkey % 25)", "80 + l_orderkey % 21"]),
    "allergen_names": ("nation", ["concat('a', n_nationkey)", "n_name", "(n_nationkey * 7) % 25"]),
    "candidates": ("customer", ["c_nationkey", "concat('U', c_custkey)", _KINDS, "c_nationkey", "c_mktsegment", "c_custkey % 97", "CASE WHEN c_nationkey % 2 = 0 AND c_custkey % 3 = 0 THEN c_custkey % 13 END", "c_custkey"]),
    "coverages": ("supplier", ["concat('U', s_suppkey)", "s_suppkey % 5"]),
    "assigned": ("orders", [
        "concat('S', o_custkey)", "o_custkey % 9", _LOCAL, "CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE 80 + o_custkey % 20 END", _OWN(f"{_NUMBER} % 2 = 0"), _OWN(f"concat('E', {_NUMBER})"), _OWN(f"concat('name ', {_NUMBER})"),
        _OWN(f"concat('MK', {_NUMBER})"),
    ]),
    "links": ("(SELECT concat('n', n_nationkey) AS child, concat('r', n_regionkey) AS parent FROM nation UNION ALL SELECT concat('c', c_custkey), concat('n', c_nationkey) FROM customer UNION ALL "
              "SELECT concat('o', o_orderkey), concat('c', o_custkey) FROM orders UNION ALL SELECT concat('o', o_orderkey), concat('c', CAST(floor(o_custkey / 2) AS BIGINT)) FROM orders) l", ["child", "parent"]),
    "marks": ("nation WHERE n_regionkey = 1 AND n_nationkey % 2 = 0", ["concat('n', n_nationkey)"]),
    "curated": ("customer WHERE c_custkey % 3 = 0", ["concat('c', c_custkey)", "concat('s', c_mktsegment)"]),
    "labels": ("pages", ["page_id", "url"]),
    "taxa": ("customer", ["CASE c_custkey % 4 WHEN 0 THEN concat('', c_custkey) WHEN 1 THEN concat('', 10000000 + c_custkey) WHEN 2 THEN concat(c_custkey, '-other') ELSE concat('NCBITaxon:', c_custkey) END",
                          "CASE WHEN c_custkey % 5 = 0 THEN '' WHEN c_custkey % 5 < 3 THEN concat('UP', c_custkey) END"]),
    "epitopes": ("orders", ["o_orderkey", "CASE o_orderkey % 4 WHEN 0 THEN concat('H', o_custkey, ', G', o_orderkey) WHEN 1 THEN concat('h', o_custkey, ' ,K', o_orderkey, ',') WHEN 2 THEN o_orderpriority ELSE substr('SIINFEKLMA', 1, CAST(o_custkey % 10 AS INT)) END"]),
}


def _columns(name: str) -> list[tuple[str, str]]:
    """(column, kind) of the fixture."""
    return [(n.strip("`"), k) for n, k in (c.strip().rsplit(" ", 1) for c in domain.FIXTURES[name][0].split(","))]


def _spark_sql(name: str) -> str:
    source, told = DERIVED[name]
    return f"SELECT {', '.join(f'CAST({e} AS {k}) AS `{c}`' for e, (c, k) in zip(told, _columns(name), strict=True))} FROM {source}"


def _oracle(name: str) -> str:
    source, told = DERIVED[name]
    return f"""{name} AS (SELECT {', '.join(f'CAST({e} AS {domain._SQL[k]}) AS "{c}"' for e, (c, k) in zip(told, _columns(name), strict=True))} FROM {source})"""


class Derived:
    """Tables by the names that domain's queries ask for."""

    GIVEN = ("part", "lineitem", "customer", "orders", "supplier", "nation", "events", "pages")

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __call__(self, name: str) -> DataFrame:
        sql = _spark_sql(name)
        given = {t: self.spark.read.parquet(f"{self.sf_dir}/{t}.parquet") for t in self.GIVEN if _word(sql, t) != sql}
        if " JOIN " in sql:  # of growing tables: a compressed file looks far smaller than the rows that a broadcast would collect
            given = {t: df.hint("merge") for t, df in given.items()}
        for t in given:  # names in the text stand for the frames
            sql = _word(sql, t)
        return self.spark.sql(sql, **given)

    def folder(self) -> str:
        return f"{shared_folder(self.spark)}/files-{uuid.uuid4().hex}"


def _word(sql: str, table: str) -> str:
    return re.sub(rf"\b(FROM|JOIN) {table}\b", rf"\1 {{{table}}}", sql)


NAMES = [
    "top_source_proteins", "manual_parents", "receptor_labels", "only_new_are_classified", "peptide_assignment", "first_row_per_source", "allergen_names_win", "proteome_selection", "source_parent_rows",
    "parent_protein_rows", "descendants_of_several", "curated_parents_first", "text_expressions", "curies_and_links", "residue_lists",
]


def _query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: domain.RULES[name][2](Derived(spark, sf_dir))


QUERIES = {f"given_{name}": _query(name) for name in NAMES}
ORACLES = {f"given_{name}": domain.with_tables(domain.RULES[name][0], [_oracle(n) for n in domain.RULES[name][1]]) for name in NAMES}
