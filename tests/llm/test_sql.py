"""The registered queries that SQL can express, against DuckDB on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from tallybook.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", queries.ORACLES)
def test_same_rows(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "labels"):
        duck.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    want = duck.execute(contract.oracle_sql()[name]).df()
    got = contract.queries()[name](spark, SF).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    columns = list(want.columns)
    assert sorted(map(str, got[columns].to_dict("records"))) == sorted(map(str, want.to_dict("records")))
