"""Every registered query against its SQL, on the small tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def comparable(rows):
    return sorted(repr(tuple(row)) for row in rows)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, database, name):
    frame = contract.queries()[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    got = frame.select(*(f"`{c}`" for c in columns)).collect()
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    cursor = database.execute(sql)
    names = [column[0] for column in cursor.description]
    rows = cursor.fetchall()
    order = [names.index(column) for column in columns]
    assert sorted(names) == columns
    assert got, "an empty result proves nothing"
    assert comparable(got) == comparable([tuple(row[i] for i in order) for row in rows])


def test_names():
    assert set(contract.oracle_sql()) <= set(contract.queries())
