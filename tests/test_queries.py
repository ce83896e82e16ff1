"""Registered queries against DuckDB on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from tracelode.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"create view {name} as select * from read_parquet('{SF}/{name}.parquet')")
    return con


def rows_of(table) -> list:
    names = sorted(table.column_names)
    return sorted(tuple(str(r[n]) for n in names) for r in table.select(names).to_pylist())


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    got = registry.QUERIES[name](spark, SF).toArrow()
    want = duck.sql(registry.ORACLES[name]).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    assert rows_of(got) == rows_of(want)


def test_trailing_periods_of_whole_texts(spark, tmp_path):
    texts = ["a" * 39 + ".b", "a" * 60 + " . ", "a" * 45 + "..", ".", None]
    rows = [(2 * i + 1, t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = registry.QUERIES["strip_trailing_period_of_texts"](spark, str(tmp_path)).collect()
    whole = {r.source_file: r.whole for r in got}
    want = ["a" * 39 + ".b", "a" * 60, "a" * 45 + ".", None, None]
    assert whole == {f"/RUBI/{i}.txt": w for (i, _), w in zip(rows, want, strict=True)}
