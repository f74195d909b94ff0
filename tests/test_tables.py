import os
import shutil

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tallybook.functions import KEY
from tallybook.sources.tables import (
    TableRef,
    append_table,
    create_table,
    ledger_batches,
    load_view,
    read_table,
    replace_table,
    table_exists,
)


@pytest.fixture
def goal(tmp_path):
    return TableRef.under(str(tmp_path), "land", "s", "t")


def test_create_fails_when_present(spark, goal):
    assert not table_exists(spark, goal)
    assert create_table(spark.range(3), goal) == 3
    assert table_exists(spark, goal)
    with pytest.raises(FileExistsError):
        create_table(spark.range(3), goal)


def test_append_widens_and_reads_back(spark, goal, rows):
    create_table(spark.createDataFrame([(1, "a")], "i int, s string"), goal)
    append_table(spark.createDataFrame([("b", 2, 0.5)], "s string, i int, d double"), goal)
    append_table(spark.createDataFrame([(3,)], "i int"), goal)
    got = read_table(spark, goal)
    assert got.columns == ["i", "s", "d"]
    assert rows(got) == [(1, "a", None), (2, "b", 0.5), (3, None, None)]
    assert KEY in read_table(spark, goal, with_key=True).columns


def test_append_without_evolving(spark, goal):
    create_table(spark.range(1), goal)
    with pytest.raises(ValueError, match="lacks"):
        append_table(spark.range(1).withColumn("x", F.lit(1)), goal, evolve=False)


def test_nested_fields_widen(spark, goal):
    create_table(spark.sql("select named_struct('a', 1) s, array(named_struct('p', 1)) l"), goal)
    append_table(
        spark.sql("select named_struct('a', 2, 'b', 'x') s, array(named_struct('p', 2, 'q', 3)) l"), goal
    )
    got = {tuple(r["s"]) + tuple(r["l"][0]) for r in read_table(spark, goal).collect()}
    assert got == {(1, None, 1, None), (2, "x", 2, 3)}


def test_type_conflict_is_rejected_before_writing(spark, goal):
    create_table(spark.createDataFrame([(1,)], "i int"), goal)
    with pytest.raises(AnalysisException):
        append_table(spark.createDataFrame([("x",)], "i string"), goal)
    assert len(ledger_batches(spark, goal.path)) == 1


def test_names_differing_in_case_are_one_column(spark, goal, rows):
    create_table(spark.createDataFrame([(1,)], "Id int"), goal)
    append_table(spark.createDataFrame([(2,)], "ID int"), goal)
    assert rows(read_table(spark, goal)) == [(1,), (2,)]


def test_uncommitted_batch_is_ignored(spark, goal):
    create_table(spark.range(3), goal)
    first = ledger_batches(spark, goal.path)[0]
    torn = shutil.copytree(first, first[:-1] + "2")
    os.remove(f"{torn}/_SUCCESS")
    assert read_table(spark, goal).count() == 3
    append_table(spark.range(3, 5), goal)
    assert read_table(spark, goal).count() == 5


def test_replace_overwrites(spark, tmp_path):
    ref = TableRef("c", "s", "t", str(tmp_path / "t"))
    replace_table(spark.range(5), ref)
    replace_table(spark.range(2), ref)
    assert read_table(spark, ref).count() == 2


def test_catalog_tables_by_name(spark, tmp_path):
    ref = TableRef("spark_catalog", "default", "tallybook_named")
    df = spark.range(4)
    df.createOrReplaceTempView("tallybook_view")
    assert not table_exists(spark, ref)
    spark.sql(f"create table {ref.name} using parquet location '{tmp_path}/n' as select * from tallybook_view")
    try:
        assert table_exists(spark, ref) and read_table(spark, ref).count() == 4
    finally:
        spark.sql(f"drop table {ref.name}")


def test_load_view(spark, tmp_path):
    gone = TableRef("c", "s", "gone", str(tmp_path / "gone"))
    assert load_view(spark, gone) is None
    with pytest.raises(AnalysisException):
        load_view(spark, gone, required=True)
    spark.range(1).write.parquet(str(tmp_path / "here"))
    here = TableRef("c", "s", "here", str(tmp_path / "here"))
    assert load_view(spark, here, prefix="p").columns == ["p_id"]
