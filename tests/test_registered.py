"""Each registered query against the SQL that gives the same rows."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract
from tallybook.checks.views import TABLES

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return connection


def cell(value):
    if value is None or value is pd.NaT or value is pd.NA:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else f"{value:.9g}"
    return str(value)


def table(pdf):
    pdf = pdf[sorted(pdf.columns)].astype(object)
    found = [tuple(cell(v) for v in row) for row in pdf.itertuples(index=False, name=None)]
    return list(pdf.columns), sorted(found, key=repr)


@pytest.mark.parametrize("name", contract.queries())
def test_same_rows(spark, duck, name):
    got = contract.queries()[name](spark, SF_DIR).toPandas()
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert len(got) > 0
    else:
        assert table(got) == table(duck.execute(sql).df())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
