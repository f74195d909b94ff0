import datetime as dt
import decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import types as T

from tallybook.functions import KEY
from tallybook.operators.rows import new_rows, union_sources
from tallybook.operators.types import common_type, keeps_text
from tallybook.plans.consolidation import consolidate_table
from tallybook.plans.landing import append_new
from tallybook.sources.tables import TableRef, append_table, create_table, ledger_batches, read_table, replace_table


@pytest.fixture
def kind(spark):
    return T._parse_datatype_string


@pytest.mark.parametrize(
    "a, b, want",
    [
        ("int", "bigint", "bigint"),
        ("tinyint", "smallint", "smallint"),
        ("int", "decimal(5,2)", "decimal(12,2)"),
        ("bigint", "decimal(38,20)", None),
        ("decimal(10,4)", "decimal(12,2)", "decimal(14,4)"),
        ("float", "int", "double"),
        ("decimal(9,2)", "double", "double"),
        ("date", "timestamp", "timestamp"),
        ("timestamp_ntz", "date", "timestamp_ntz"),
        ("timestamp", "timestamp_ntz", None),
        ("boolean", "int", None),
        ("binary", "string", None),
        ("struct<a:int,b:date>", "struct<B:timestamp,c:string>", "struct<a:int,b:timestamp,c:string>"),
        ("array<int>", "array<double>", "array<double>"),
        ("map<string,int>", "map<string,bigint>", "map<string,bigint>"),
        ("array<int>", "int", None),
        ("struct<a:int>", "struct<a:boolean>", None),
    ],
)
def test_common_types(kind, a, b, want):
    for x, y in ((a, b), (b, a)):
        found = common_type(kind(x), kind(y))
        if want is None or not want.startswith("struct"):
            assert (found and found.simpleString()) == want
    if want is not None and want.startswith("struct"):
        assert common_type(kind(a), kind(b)).simpleString() == want


def test_text_only_when_asked_for(kind):
    assert common_type(kind("int"), kind("string")) is None
    assert common_type(kind("int"), kind("string"), as_text=True) == T.StringType()
    assert common_type(kind("array<int>"), kind("array<string>"), as_text=True) == T.ArrayType(T.StringType())
    assert common_type(kind("binary"), kind("string"), as_text=True) is None


def test_whole_numbers_look_the_same(kind):
    assert keeps_text(kind("int"), kind("bigint")) and keeps_text(kind("array<struct<a:int>>"), kind("array<struct<a:bigint,b:int>>"))
    assert not keeps_text(kind("int"), kind("double")) and not keeps_text(kind("bigint"), kind("int"))


@pytest.fixture
def goal(tmp_path):
    return TableRef.under(str(tmp_path), "land", "s", "t")


def outcome(status):
    return status["action"], status["row_count"]


def test_ledger_widens_step_by_step(spark, goal, rows):
    """int, long, decimal, double; every earlier source replayed adds nothing at any time."""
    sources = [
        spark.sql("select cast(id as int) i, date'2020-01-01' d from range(3)"),
        spark.sql("select id i, date'2020-01-01' d from range(5)"),
        spark.sql("select cast(id as decimal(22,1)) + 0.5BD i, timestamp'2020-01-01 00:00:00' d from range(2)"),
        spark.sql("select cast(id as double) + 0.25 i, timestamp'2020-01-02 10:00:00' d from range(2)"),
    ]
    added = [3, 2, 2, 2]
    for n, (source, count) in enumerate(zip(sources, added, strict=True)):
        assert outcome(append_new(source, goal)) == ("created" if n == 0 else "appended", count)
        for earlier in sources[: n + 1]:
            assert outcome(append_new(earlier, goal)) == ("unchanged", 0)
    got = read_table(spark, goal)
    assert [t for _, t in got.dtypes] == ["double", "timestamp"]
    first, second = dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 2, 10)
    assert rows(got) == sorted([(float(i), first) for i in range(5)] + [(0.5, first), (1.5, first), (0.25, second), (1.25, second)])
    names = [b.rpartition("/")[2] for b in ledger_batches(spark, goal.path)]
    assert names == ["batch-00000001", "batch-00000002", "batch-00000003-g0001", "batch-00000004-g0002"]
    keyed = read_table(spark, goal, with_key=True)
    assert keyed.select(KEY).distinct().count() == 9


def test_nested_types_widen(spark, goal):
    append_new(spark.sql("select named_struct('a', 1) s, array(1) l, map('k', 1) m"), goal)
    source = spark.sql("select named_struct('a', 2.5D, 'b', 'x') s, array(2.5D) l, map('k', 2.5D) m")
    assert outcome(append_new(source, goal)) == ("appended", 1)
    assert outcome(append_new(source, goal)) == ("unchanged", 0)
    got = {(r["s"]["a"], r["s"]["b"], r["l"][0], r["m"]["k"]) for r in read_table(spark, goal).collect()}
    assert got == {(1.0, None, 1.0, 1.0), (2.5, "x", 2.5, 2.5)}


def test_text_in_a_ledger(spark, goal, rows):
    append_new(spark.createDataFrame([(1,)], "i int"), goal)
    with pytest.raises(AnalysisException):
        append_new(spark.createDataFrame([("x",)], "i string"), goal)
    text = spark.createDataFrame([("x",), ("1",)], "i string")
    assert outcome(append_new(text, goal, as_text=True)) == ("appended", 1)
    assert outcome(append_new(spark.createDataFrame([(1,)], "i int"), goal)) == ("unchanged", 0)
    assert rows(read_table(spark, goal)) == [("1",), ("x",)]


def test_a_value_that_does_not_fit_ends_the_job(spark, goal):
    append_new(spark.createDataFrame([(2**53 + 1,)], "i long"), goal)
    append = spark.createDataFrame([(0.5,)], "i double")
    with pytest.raises(Exception, match="doesn't fit"):
        append_new(append, goal)
    assert len(ledger_batches(spark, goal.path)) == 1
    exact = spark.createDataFrame([(2**60,), (-(2**62),), (None,)], "i long")
    assert union_sources([append, exact]).count() == 4
    assert {r[0] for r in union_sources([append, exact]).collect()} == {0.5, 2.0**60, -(2.0**62), None}


def test_append_with_widening_alone(spark, goal, rows):
    create_table(spark.createDataFrame([(1,)], "i int"), goal)
    append_table(spark.createDataFrame([(2**40,)], "i long"), goal)
    append_table(spark.createDataFrame([(decimal.Decimal("2.50"),)], "i decimal(4,2)"), goal)
    assert rows(read_table(spark, goal)) == [(decimal.Decimal(x),) for x in ("1.00", "1099511627776.00", "2.50")]
    with pytest.raises(Exception):
        append_table(spark.createDataFrame([("2.5",)], "i string"), goal, evolve=False)


def test_union_of_mixed_types(spark, rows):
    a = spark.createDataFrame([(1, dt.date(2020, 1, 1))], "k int, at date")
    b = spark.createDataFrame([(2**40, dt.datetime(2021, 1, 1, 5), "x")], "K long, at timestamp, n string")
    c = spark.createDataFrame([(0.5,)], "k double")
    found = union_sources([a, b, None, c])
    assert found.dtypes == [("k", "double"), ("at", "timestamp"), ("n", "string")]
    assert found.count() == 3
    text = spark.createDataFrame([("k1",)], "k string")
    with pytest.raises(AnalysisException):
        union_sources([a, text])
    assert {r[0] for r in union_sources([a, text], as_text=True).collect()} == {"1", "k1"}


def test_union_of_mixed_types_that_the_first_lacks(spark):
    a, b, c = (spark.sql(q) for q in ("select 1 x", "select 1 y", "select 1.5D y"))
    assert dict(union_sources([a, b, c]).dtypes)["y"] == "double"


def test_consolidated_sources_of_mixed_types(spark, goal, tmp_path):
    def source(name, df):
        ref = TableRef(name, "s", "t", f"{tmp_path}/{name}/t")
        replace_table(df, ref)
        return ref

    a = source("a", spark.sql("select cast(id as int) k, 'x' v from range(4)"))
    b = source("b", spark.sql("select cast(id as decimal(12,2)) k, 'x' v from range(2, 8)"))
    assert outcome(consolidate_table(spark, [a], goal)) == ("created", 4)
    assert outcome(consolidate_table(spark, [a, b], goal)) == ("appended", 4)
    for refs in ([a, b], [b], [a], [b, a]):
        assert outcome(consolidate_table(spark, refs, goal)) == ("unchanged", 0)


def test_pruning_on_a_widened_column(spark, goal):
    append_new(spark.sql("select date_add(date'2020-01-01', cast(id as int)) d from range(9)"), goal, prune_on="d")
    later = spark.sql("select cast(date_add(date'2020-01-01', cast(id as int)) as timestamp) d from range(4, 12)")
    assert outcome(append_new(later, goal, prune_on="d")) == ("appended", 3)
    assert outcome(append_new(later, goal, prune_on="d")) == ("unchanged", 0)


def test_new_rows_between_types(spark, rows):
    source = spark.createDataFrame([(1.0,), (2.5,)], "i double")
    target = spark.createDataFrame([(1,)], "i int")
    assert rows(new_rows(source, target)) == [(2.5,)]
