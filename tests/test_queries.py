import duckdb
import pytest

import __spark_entry__ as contract
from check import TABLES, rows_of
from conftest import TESTDATA

@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{TESTDATA}/{t}.parquet'")
    return con


def test_entry_has_a_stable_schema(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "variable" and df.count() == 4


def test_every_sql_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_its_sql(spark, database, name):
    df = contract.queries()[name](spark, TESTDATA)
    ours = rows_of(df.columns, df.collect())
    cursor = database.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert ours == rows_of(columns, cursor.fetchall())
