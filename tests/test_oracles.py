"""Every query against its SQL oracle in DuckDB."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry
from catalog.oracles import SQL
from catalog.spark_queries import QUERIES

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_oracle(spark, duck, name):
    result = QUERIES[name](spark, SF)
    names, rows = table(result.columns, [tuple(r) for r in result.collect()])
    relation = duck.sql(SQL[name])
    expected_names, expected = table(list(relation.columns), relation.fetchall())
    assert names == expected_names
    assert len(rows) == len(expected)
    wrong = [(a, b) for a, b in zip(rows, expected) if a != b]
    assert not wrong, (len(wrong), wrong[:2])
    assert rows


def test_every_own_query_has_an_oracle():
    # DuckDB's patterns cannot look behind; the spans are compared in test_spans.py.
    assert set(QUERIES) - {"entity_spans", "entity_spans_documents"} == set(SQL)


def test_entry(spark):
    assert entry(spark).count() > 0
