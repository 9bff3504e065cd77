"""Queries of the training-data operators against their SQL."""

import os

import duckdb
import pytest

from deskline.llm.oracles import SQL
from deskline.llm.queries import QUERIES

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_oracle(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "labels", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    expected = con.sql(SQL[name])
    columns = sorted(expected.columns)
    result = QUERIES[name](spark, SF)
    assert sorted(result.columns) == columns
    rows = sorted((tuple(r[c] for c in columns) for r in result.collect()), key=repr)
    order = [expected.columns.index(c) for c in columns]
    wanted = sorted((tuple(r[i] for i in order) for r in expected.fetchall()), key=repr)
    assert len(rows) == len(wanted) > 0
    assert [pair for pair in zip(rows, wanted) if pair[0] != pair[1]][:3] == []
