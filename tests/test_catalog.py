"""Every registered query against its SQL, and what its plan may not contain."""

import duckdb
import pytest

import __spark_entry__ as registry
import check
from sensorflow.plans import catalog

NAMES = list(catalog.QUERIES)


@pytest.fixture(scope="module")
def db(small):
    connection = duckdb.connect()
    for table in ("events", "documents"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, db, small, name):
    good, note = check.compare(spark, db, name, small)
    assert good, note


def test_entry(spark):
    assert registry.entry(spark).columns[0] == "event_id"


def test_all_have_sql():
    assert set(NAMES) <= set(registry.oracle_sql())
