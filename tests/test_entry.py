import duckdb
import pytest

import __spark_entry__ as E
from urbanlens.plans.bindings import TABLES

SF = "/root/testdata/sf0.001"
NO_ORACLE = set()
OWN = E._queries.registry()  # the optional operators have tests of their own


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and df.columns == ["date", "topics"]


def test_every_query_has_oracle_unless_listed():
    assert set(OWN) - set(E._oracles.registry()) == NO_ORACLE
    assert set(E.oracle_sql()) <= set(E.queries()) and set(OWN) <= set(E.queries())


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E._oracles.registry()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = df.columns
    s = sorted((tuple(_norm(r[c]) for c in sorted(cols)) for r in df.collect()), key=repr)
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == sorted(cols)
    idx = [dcols.index(c) for c in sorted(cols)]
    d = sorted((tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()), key=repr)
    assert s == d
