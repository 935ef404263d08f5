"""Every registered query against its SQL, on the small tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as driver
from hazardlake.plans.catalog import QUERIES
from hazardlake.plans.oracle import ORACLE

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    yield con
    con.close()


def _text(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    return repr(value)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= driver.queries().items()
    assert ORACLE.items() <= driver.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = driver.queries()[name](spark, SF)
    columns = sorted(df.columns)
    result = duck.execute(driver.oracle_sql()[name])
    described = {d[0]: str(d[1]) for d in result.description}
    assert sorted(described) == columns
    assert {c: TYPES[t] for c, t in df.dtypes} == described
    order = [list(described).index(c) for c in columns]
    expect = sorted([_text(row[i]) for i in order] for row in result.fetchall())
    assert sorted([_text(row[c]) for c in columns] for row in df.collect()) == expect


def test_entry(spark):
    assert "distance_km" in driver.entry(spark).columns
