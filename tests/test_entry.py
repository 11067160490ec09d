import os

import duckdb
import pytest

import __spark_entry__ as E
from rinkstat.plans.catalog import QUERIES
from rinkstat.plans.oracle_catalog import ORACLE_SQL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "gamesCNT" in df.columns


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())


def test_entry_without_the_corpus_operators(monkeypatch):
    import importlib
    import sys

    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)  # what an import finds when the file is gone
    try:
        assert set(importlib.reload(E).queries()) == set(QUERIES)
    finally:
        monkeypatch.undo()
        importlib.reload(E)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t + '.parquet')}')")
    return con


def _bag(rows):
    from collections import Counter

    def norm(v):
        if isinstance(v, float):
            return float(f"{v:.9g}")
        if hasattr(v, "isoformat"):
            return v.isoformat()
        return v

    return Counter(tuple(norm(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    expected = _bag(tuple(r[i] for i in idx) for r in rel.fetchall())
    assert _bag(tuple(r) for r in df.select(*cols).collect()) == expected
