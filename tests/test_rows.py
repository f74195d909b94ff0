import random
import time

import pytest
from pyspark.sql import functions as F

from tallybook.functions import KEY
from tallybook.operators.rows import find_unseen, new_rows, union_sources


@pytest.fixture
def tables(spark):
    """A third of the source are copies of one unseen row, another hot row is known."""
    rng = random.Random(3)
    source = [(rng.randrange(40), rng.choice(["a", "", None])) for _ in range(300)]
    source += [(1000, "hot")] * 200 + [(2000, "known")] * 100
    target = [r for r in source if r[0] % 3 == 0] + [(2000, "known")] * 150 + [(9, "only here")]
    schema = "i int, t string"
    return (source, target), (
        spark.createDataFrame(source, schema),
        spark.createDataFrame(target, schema),
    )


def brute(source, target):
    known = set(target)
    return sorted((r for r in source if r not in known), key=repr)


def test_all_copies_of_unseen_rows(tables, rows):
    (source, target), (left, right) = tables
    found = find_unseen(left, right)
    want = brute(source, target)
    assert rows(found.rows, "i", "t") == want
    assert found.row_count == len(want)


def test_nothing_new(tables):
    _, (left, _) = tables
    found = find_unseen(left, left)
    assert found.row_count == 0 and found.rows.count() == 0


def test_names_and_types_of_the_target_hold(spark):
    target = spark.sql("select 1 as Id, cast(1.5 as decimal(10,4)) d")
    assert new_rows(spark.sql("select cast(1.5 as decimal(10,2)) d, 1 as id"), target).count() == 0
    assert new_rows(spark.sql("select cast(2.5 as decimal(10,2)) d, 1 as id"), target).count() == 1


def test_the_name_of_the_key_is_refused(spark):
    clash = spark.range(2).withColumn(KEY, F.lit("mine"))
    for source, target in ((clash, spark.range(1)), (spark.range(1), clash)):
        with pytest.raises(ValueError, match="reserved"):
            new_rows(source, target)


@pytest.mark.parametrize("zone", ["America/New_York", "UTC"])
def test_pruning_in_the_hour_that_a_clock_repeats(spark, zone, monkeypatch):
    monkeypatch.setenv("TZ", zone)
    time.tzset()
    try:
        instants = [1762063200 + 900 * k for k in range(12)]
        rows = spark.createDataFrame([(i,) for i in instants], "s long").select(F.timestamp_seconds("s").alias("ts"))
        one = rows.filter("ts = timestamp_seconds(1762065000)")
        assert new_rows(one, rows, prune_on="ts").count() == 0
        assert new_rows(rows, one, prune_on="ts").count() == 11
    finally:
        monkeypatch.undo()
        time.tzset()


def test_compat_takes_null_and_empty_as_equal(spark, rows):
    source = spark.createDataFrame([(None, "x"), ("", "y")], "p string, q string")
    target = spark.createDataFrame([("", "x"), (None, "y")], "p string, q string")
    assert new_rows(source, target, mode="compat").count() == 0
    assert new_rows(source, target).count() == 2


def test_pruning_by_range_loses_nothing(spark, rows):
    source = spark.createDataFrame([(i, i * 10) for i in range(20, 40)] + [(None, 1)], "t int, v int")
    target = spark.createDataFrame(
        [(i, i * 10) for i in range(0, 30)] + [(None, 1), (None, 2)], "t int, v int"
    )
    assert rows(new_rows(source, target, prune_on="t")) == rows(new_rows(source, target))
    only_null = source.filter("t is null")
    assert new_rows(only_null, target, prune_on="t").count() == 0


def test_map_columns_go_through(spark):
    source = spark.sql("select 1 i, map('a', 1) m union all select 1, map('a', 2)")
    target = spark.sql("select 1 i, map('a', 1) m")
    assert [r["m"] for r in new_rows(source, target).collect()] == [{"a": 2}]


def test_union_fills_missing_columns_and_skips_absent_sources(spark, rows):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([(2, 0.5)], "i int, d double")
    got = union_sources([None, a, b, a])
    assert got.columns == ["i", "s", "d"]
    assert rows(got) == sorted([(1, "x", None), (2, None, 0.5), (1, "x", None)], key=repr)
    assert union_sources([None]) is None


def test_no_rows_meet_in_one_task(spark):
    source = spark.range(2000).withColumn("wide", F.lit("w"))
    plan = find_unseen(source, source.filter("id < 1990")).rows
    plan.count()
    assert "SinglePartition" not in plan._jdf.queryExecution().executedPlan().toString()
