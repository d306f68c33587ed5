"""Every registered query that has an oracle gives the oracle's rows; the others give rows."""

import duckdb
import pytest

from rootline.plans import catalogue, domain, given
from tests.conftest import SF

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    return f"{v:.9g}" if isinstance(v, float) else repr(v)


QUERIES, ORACLES = catalogue.QUERIES | domain.QUERIES | given.QUERIES, catalogue.ORACLES | domain.ORACLES | given.ORACLES


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    rows = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    if name not in ORACLES:
        assert rows
        return
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = db.sql(ORACLES[name])
    at = [got.columns.index(c) for c in cols]
    assert sorted(got.columns) == cols
    assert rows == sorted(tuple(plain(r[i]) for i in at) for r in got.fetchall())


def test_entry_names_are_the_same_without_the_optional_part():
    import __spark_entry__ as e

    assert set(catalogue.QUERIES) | set(domain.REGISTERED) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())
    assert not (set(domain.QUERIES) - set(domain.REGISTERED)) & set(e.queries())
