"""Every registered query against its SQL equivalent on the smallest tables."""

import os

import duckdb
import pytest

from curvelake.plans.oracles import ORACLES
from curvelake.plans.queries import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def ordered(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return [columns[i] for i in order], sorted(picked, key=lambda row: tuple((v is None, str(v)) for v in row))


def test_registry_is_consistent():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_query_matches_sql(spark, sql, name):
    cursor = sql.execute(ORACLES[name])
    expected = ordered([c[0] for c in cursor.description], cursor.fetchall())
    result = QUERIES[name](spark, FOLDER)
    assert ordered(result.columns, result.collect()) == expected


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0
