"""The registered queries that have SQL, against DuckDB at sf0.001; all others must run and keep every row."""

import os

import pytest

from shelfwise.llm.oracle import SQL
from shelfwise.llm.queries import QUERIES

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SMOKE, t)}.parquet')")
    return con


def _same(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(float(f"{r[i]:.9g}") if isinstance(r[i], float) else r[i] for i in order)) for r in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SMOKE)
    rel = duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _same(df.columns, [tuple(r) for r in df.collect()]) == _same(rel.columns, rel.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_every_document(spark, duck, name):
    assert QUERIES[name](spark, SMOKE).count() == duck.sql("SELECT count(*) FROM documents").fetchall()[0][0]


def test_entry_lists_the_queries():
    import __spark_entry__ as entry
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql())
