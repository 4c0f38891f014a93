"""The registered queries against their SQL, and all of them on the smallest tables."""

import duckdb
import pytest

from curvelake.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = ("documents", "benchmark", "labels", "conversations", "embeddings", "pages")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def ordered(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(r[i] for i in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sql, name):
    cursor = sql.execute(ORACLES[name])
    want = ordered([c[0] for c in cursor.description], cursor.fetchall())
    found = QUERIES[name](spark, FOLDER)
    assert ordered(found.columns, found.collect()) == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_has_a_row_per_document(spark, name):
    found = QUERIES[name](spark, FOLDER)
    if "doc_id" in found.columns and name != "op6_decontamination":
        assert sorted(r.doc_id for r in found.select("doc_id").collect()) == list(range(200))
    else:
        assert found.count() > 0
