"""Queries of this subpackage that SQL can express, against DuckDB."""

import duckdb
import pytest

from rankloom.llm import queries as q

from .conftest import SF


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.sql(q.oracle_sql()[name])
    got = q.queries()[name](spark, SF)
    cols = sorted(got.columns)
    assert sorted(want.columns) == cols
    have = sorted(tuple(r[c] for c in cols) for r in got.collect())
    expect = sorted(tuple(r) for r in want.select(*[duckdb.ColumnExpression(c) for c in cols]).fetchall())
    assert have == expect


def test_every_operator_is_registered():
    assert {n.split("_")[0] for n in q.queries()} == {f"op{i}" for i in range(1, 14)}
