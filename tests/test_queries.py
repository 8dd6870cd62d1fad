"""Every registered query against its SQL, run by DuckDB on the same small tables."""

import os

import pytest

import __spark_entry__ as registry

duckdb = pytest.importorskip("duckdb")

SF_DIR = os.environ.get("TABPROOF_TEST_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def by_column_name(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(row[i] for i in order) for row in rows], key=repr)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, database, name):
    found = registry.queries()[name](spark, SF_DIR)
    cursor = database.execute(registry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(found.columns) == sorted(columns)
    expected = by_column_name(cursor.fetchall(), columns)
    assert by_column_name([tuple(r) for r in found.collect()], found.columns) == expected


def test_every_sql_has_a_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_unchecked_queries_are_the_known_ones():
    """No SQL can state what bytes a file holds; the text operators have tests of their own."""
    unchecked = set(registry.queries()) - set(registry.oracle_sql())
    assert {n for n in unchecked if not n.startswith("op") and n != "pipeline"} == {"file_manifest"}


def test_manifest(spark):
    import hashlib

    row = registry.queries()["file_manifest"](spark, SF_DIR).first()
    with open(f"{SF_DIR}/lineitem.parquet", "rb") as file:
        content = file.read()
    assert (row["length"], row["sha256"]) == (len(content), hashlib.sha256(content).hexdigest())


def test_entry(spark):
    assert registry.entry(spark).count() == 12
