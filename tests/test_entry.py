"""Driver contract: entry on sf0.001 and every oracle at sf0.001."""

import duckdb
import pytest

from conftest import SF0001

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def test_entry_flagship(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.columns == ["id", "date", "raw_text"]
    assert df.count() == 45


def test_oracles_are_registered_queries():
    from __spark_entry__ import oracle_sql, queries
    assert set(oracle_sql()) <= set(queries())
    from tidewrack import catalog
    assert set(catalog.QUERIES) == set(catalog.ORACLES)  # outside the llm folder every query has SQL


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return c


def _norm(rows):
    def v(x):
        if isinstance(x, float):
            return round(x, 6)
        return x
    return sorted((tuple(v(x) for x in r) for r in rows), key=repr)


def test_all_oracles_sf0001(spark, con):
    from __spark_entry__ import oracle_sql, queries
    bad = []
    for name, sql in oracle_sql().items():
        sdf = queries()[name](spark, SF0001)
        rel = con.execute(sql)
        cols = [d[0] for d in rel.description]
        drows = rel.fetchall()
        idx = [cols.index(c) for c in sdf.columns]
        if sorted(cols) != sorted(sdf.columns) or _norm(sdf.collect()) != _norm([tuple(r[i] for i in idx) for r in drows]):
            bad.append(name)
    assert bad == []
