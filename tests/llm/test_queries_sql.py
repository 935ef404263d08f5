"""Registered queries of the subpackage against their SQL, on whole small tables."""
import duckdb
import pytest

import __spark_entry__ as driver
from hazardlake.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"

TABLES = "documents labels conversations embeddings".split()


def test_all_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(driver.queries())
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    result = con.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    got = sorted(map(repr, (tuple(r[c] for c in columns) for r in df.collect())))
    assert got == sorted(map(repr, result.fetchall()))
