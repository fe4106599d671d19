"""Every registered query against the same question asked in SQL, over whole tables."""

import os

import duckdb
import pytest

import __spark_entry__ as driver
from bindings.oracle import ORACLE
from bindings.queries import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="benchmark tables not present")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def canonical(rows):
    def key(value):
        return (value is None, type(value).__name__, str(value))

    return sorted([tuple(key(v) for v in row) for row in rows])


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= driver.queries().keys()
    assert driver.oracle_sql().keys() <= driver.queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, sql, name):
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    ours = [tuple(row) for row in result.select(*[f"`{c}`" for c in columns]).collect()]
    relation = sql.sql(ORACLE[name])
    assert sorted(relation.columns) == columns
    theirs = relation.project(", ".join(f'"{c}"' for c in columns)).fetchall()
    assert len(ours) == len(theirs)
    assert len(ours) > 0
    assert canonical(ours) == canonical(theirs)
