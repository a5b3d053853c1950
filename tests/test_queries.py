"""Driver contract: entry() and every registered query against its DuckDB oracle."""

import sys

import duckdb
import pytest

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

import __spark_entry__ as E  # noqa: E402
from tools.oracle_check import TABLES, compare  # noqa: E402


@pytest.fixture(scope="module")
def duck(data_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{data_dir}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["customer_name", "sales"]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


# Spark simple type -> DuckDB type name, for the schema half of the check.
DUCK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
              "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, duck, data_dir, name):
    df = E.queries()[name](spark, data_dir)
    got = df.toPandas()
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(got) > 0
        return
    rel = duck.sql(sql)
    types = dict(zip(rel.columns, (str(t) for t in rel.types)))
    for f in df.schema.fields:
        assert DUCK_TYPES[f.dataType.simpleString()] == types[f.name], (f.name, types[f.name])
    ok, msg = compare(got, duck.execute(sql).df())
    assert ok, msg
