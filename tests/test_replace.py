import os

import pytest
from pyspark.sql import functions as F

from tallybook.sources.paths import folder_for_writing, restore_folder, swap_folder
from tallybook.sources.tables import TableRef, read_table, replace_table, table_exists


@pytest.fixture
def ref(tmp_path):
    return TableRef("c", "s", "t", str(tmp_path / "tables" / "t"))


def ids(spark, ref):
    return sorted(r[0] for r in read_table(spark, ref).collect())


def test_a_table_may_be_replaced_from_itself(spark, ref):
    replace_table(spark.range(5), ref)
    assert replace_table(read_table(spark, ref).filter("id > 2"), ref) == 2
    assert ids(spark, ref) == [3, 4]
    assert os.listdir(os.path.dirname(ref.path)) == ["t"]


def test_a_job_that_fails_leaves_the_old_rows(spark, ref):
    replace_table(spark.range(5), ref)
    with pytest.raises(Exception):
        replace_table(spark.range(3).select(F.raise_error(F.lit("no")).alias("id")), ref)
    assert ids(spark, ref) == [0, 1, 2, 3, 4]


def test_a_run_that_dies_between_the_renames_is_undone(spark, ref):
    replace_table(spark.range(5), ref)
    parent = os.path.dirname(ref.path)
    os.rename(ref.path, f"{parent}/.replaced-t-{'0' * 32}")
    os.makedirs(f"{parent}/.replaced-t-more-{'0' * 32}")
    assert table_exists(spark, ref) and ids(spark, ref) == [0, 1, 2, 3, 4]
    replace_table(spark.range(2), ref)
    assert ids(spark, ref) == [0, 1]


def test_a_new_folder_that_is_not_there_leaves_the_old_one(spark, ref):
    replace_table(spark.range(5), ref)
    with pytest.raises(Exception):
        swap_folder(spark, ref.path, folder_for_writing(ref.path))
    assert ids(spark, ref) == [0, 1, 2, 3, 4]
    restore_folder(spark, ref.path)
    assert ids(spark, ref) == [0, 1, 2, 3, 4]


def test_catalog_tables(spark):
    spark.sql("DROP SCHEMA IF EXISTS tallybook_swapped CASCADE")
    ref = TableRef("spark_catalog", "tallybook_swapped", "t")
    try:
        assert replace_table(spark.range(5), ref) == 5
        assert replace_table(read_table(spark, ref).filter("id > 2"), ref) == 2
        assert ids(spark, ref) == [3, 4]
        with pytest.raises(Exception):
            replace_table(read_table(spark, ref).select(F.raise_error(F.lit("no")).alias("id")), ref)
        assert ids(spark, ref) == [3, 4]
        left = [t.name for t in spark.catalog.listTables("tallybook_swapped") if "__replaced_" in t.name]
        assert left == []
    finally:
        spark.sql("DROP SCHEMA IF EXISTS tallybook_swapped CASCADE")
