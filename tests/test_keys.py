import os
import re
import uuid

import pytest
from pyspark.sql import functions as F

from tallybook.functions import KEY
from tallybook.operators.rows import keys_not_in_buckets
from tallybook.plans.landing import append_new
from tallybook.sources.keys import KeyIndex, drop_keys, synced_keys
from tallybook.sources.tables import TableRef, create_table, read_table


@pytest.fixture
def goal(tmp_path):
    return TableRef.under(str(tmp_path), "land", "s", "t")


@pytest.fixture
def index(spark):
    schema = f"tallybook_keys_{uuid.uuid4().hex[:8]}"
    yield KeyIndex(schema, "t", buckets=4)
    spark.sql(f"DROP SCHEMA IF EXISTS {schema} CASCADE")


def outcome(status):
    return status["action"], status["row_count"]


def stored(spark, goal):
    return sorted(bytes(r[0]) for r in read_table(spark, goal, with_key=True).select(KEY).collect())


def synced(spark, goal, index):
    return sorted(bytes(r[0]) for r in synced_keys(spark, goal, index).collect())


def test_same_rows_as_without_an_index(spark, goal, index, tmp_path, rows):
    other = TableRef.under(str(tmp_path), "land", "s", "plain")
    sources = [spark.range(20), spark.range(15, 40).union(spark.range(35, 45)), spark.range(45), spark.range(0)]
    for source in sources:
        assert outcome(append_new(source, goal, index=index)) == outcome(append_new(source, other))
    assert rows(read_table(spark, goal)) == rows(read_table(spark, other))
    assert synced(spark, goal, index) == stored(spark, goal)


def test_the_target_is_not_shuffled(spark, goal, index):
    append_new(spark.range(1000), goal, index=index)
    append_new(spark.range(1500), goal, index=index)
    keys = read_table(spark, goal, with_key=True).groupBy(KEY).agg(F.count(F.lit(1)).alias("_rows"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = keys_not_in_buckets(keys, synced_keys(spark, goal, index), index.buckets)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "LeftAnti" in plan
    side = plan[plan.index("LeftAnti") :]
    scans = [m.start() for m in re.finditer("FileScan", side)]
    bucketed = next(s for s in scans if "Bucketed: true" in side[s : s + 600])
    last_exchange = max(m.start() for m in re.finditer("Exchange", side))
    assert bucketed > last_exchange, plan


def test_batches_that_the_index_lacks_are_added(spark, goal, index):
    """Runs without the index, and one that died before it marked its batch."""
    create_table(spark.range(5), goal)
    append_new(spark.range(9), goal)
    assert outcome(append_new(spark.range(9), goal, index=index)) == ("unchanged", 0)
    assert synced(spark, goal, index) == stored(spark, goal)
    place = spark.sql(f"DESCRIBE TABLE EXTENDED {index.name(0)}").filter("col_name = 'Location'").first()["data_type"]
    folder = place.removeprefix("file:")
    os.remove(f"{folder}/_whole/batch-00000002")
    torn = f"{folder}/batch=batch-00000002"
    os.remove(next(f"{torn}/{f}" for f in os.listdir(torn) if f.endswith(".parquet")))
    assert synced(spark, goal, index) == stored(spark, goal)
    assert outcome(append_new(spark.range(12), goal, index=index)) == ("appended", 3)


def test_widened_types_get_an_index_of_their_own(spark, goal, index):
    append_new(spark.range(6), goal, index=index)
    append_new(spark.range(6), goal, index=index)
    wider = spark.range(4, 9).selectExpr("cast(id as double) id")
    assert outcome(append_new(wider, goal, index=index)) == ("appended", 3)
    for source in (wider, spark.range(9)):
        assert outcome(append_new(source, goal, index=index)) == ("unchanged", 0)
    assert synced(spark, goal, index) == stored(spark, goal)
    drop_keys(spark, index)
    assert [t for t in spark.catalog.listTables(index.schema) if not t.isTemporary] == []
    assert outcome(append_new(spark.range(10), goal, index=index)) == ("appended", 1)


def test_only_ledgers_have_keys(spark, tmp_path, index):
    with pytest.raises(ValueError, match="ledger"):
        synced_keys(spark, TableRef("c", "s", "t", str(tmp_path)), index)
    with pytest.raises(FileNotFoundError):
        synced_keys(spark, TableRef.under(str(tmp_path), "c", "s", "none"), index)
