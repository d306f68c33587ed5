"""What the derived tables' joins send to the driver: nothing that grows with the tables."""

import pytest
from pyspark.sql import functions as F

from rootline.operators import minimizers
from rootline.plans import domain, given
from tests.conftest import SF


def broadcast(df):
    """The leaves and Python steps under each broadcast of a plan."""
    found = []

    def walk(node, inside):
        name = node.nodeName()
        inside = inside or name == "BroadcastExchange"
        if inside and (name.startswith("MapIn") or node.children().isEmpty()):
            found.append(node.toString().split("\n")[0])
        for k in range(node.children().size()):
            walk(node.children().apply(k), inside)

    plan = df._jdf.queryExecution().executedPlan()
    walk(plan.initialPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan, False)
    return found


def test_growing_tables_are_not_broadcast(spark):
    t = given.Derived(spark, SF)
    assert not broadcast(t("peptides")) and not broadcast(domain.top_source_proteins(t))
    assert not [x for x in broadcast(domain.peptide_assignment(t)) if "p_partkey" in x or "MapIn" in x or "l_suppkey" in x]


@pytest.mark.parametrize("most", [0, 10**6])
def test_what_the_scan_finds_is_not_broadcast(spark, monkeypatch, most):
    monkeypatch.setattr(minimizers, "MOST_BYTES", most)
    texts = spark.range(50).select(F.col("id").alias("protein"), F.concat(F.lit("MSIINFEKL"), F.col("id").cast("string"), F.lit("SIINFEKL")).alias("seq"))
    queries = spark.createDataFrame([("SIINFEKL",), ("INFEKL1",), ("WWWWW",)], "query string")
    found = minimizers.occurrences(queries, texts, 5, 1)
    assert not [x for x in broadcast(found) if "MapIn" in x]
    own = {i: f"MSIINFEKL{i}SIINFEKL" for i in range(50)}
    want = sorted((q, i, at + 1) for q in ("SIINFEKL", "INFEKL1", "WWWWW") for i, s in own.items() for at in range(len(s)) if s.startswith(q, at))
    assert sorted(map(tuple, found.collect())) == want
