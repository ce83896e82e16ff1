"""Queries with SQL against DuckDB on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from tracelode.llm import queries

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


def rows_of(table) -> list:
    names = sorted(table.column_names)
    return sorted(tuple(str(r[n]) for n in names) for r in table.select(names).to_pylist())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.execute(f"create view {table} as select * from read_parquet('{SF}/{table}.parquet')")
    got = queries.QUERIES[name](spark, SF).toArrow()
    want = con.sql(queries.ORACLES[name]).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    assert rows_of(got) == rows_of(want)


def test_one_query_for_each_operator():
    assert [n.split("_")[0] for n in queries.QUERIES if n.startswith("op")] == [f"op{i}" for i in range(1, 14)]
    assert "pipeline" in queries.QUERIES
