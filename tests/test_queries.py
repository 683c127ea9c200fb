import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_queries import normalised
from tidegauge.oracles import all_oracles
from tidegauge.queries import all_queries

FOLDER = "/root/testdata/sf0.001"
TABLES = ["events", "lineitem", "pages"]


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{name}.parquet')")
    return connection


def test_entry(spark):
    assert entry(spark).count() == 13


def test_every_query_has_its_sql():
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(queries())
    assert set(all_oracles()) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_sql(spark, db, name):
    got = queries()[name](spark, FOLDER).toPandas()
    want = db.execute(oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert normalised(got) == normalised(want)
