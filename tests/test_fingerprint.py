from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallybook.functions import KEY, row_fingerprint, row_key


def prints(df, mode="strict"):
    return [r[0] for r in df.select(row_fingerprint(df.schema, mode)).collect()]


def test_null_empty_and_delimiter_do_not_collide(spark):
    df = spark.createDataFrame(
        [("a|b", "c"), ("a", "b|c"), (None, "x"), ("", "x")], "p string, q string"
    )
    assert len(set(prints(df))) == 4
    assert len(set(prints(df, "compat"))) == 2


def test_maps_count_in_strict_only_and_entry_order_never(spark):
    df = spark.sql(
        """select 1 i, map('a', 1) m union all select 1, map('a', 2)
           union all select 1, map('a', 1, 'b', 2) union all select 1, map('b', 2, 'a', 1)"""
    )
    one, two, ab, ba = prints(df)
    assert one != two and ab == ba
    assert len(set(prints(df, "compat"))) == 1


def test_nested_maps_are_ordered_too(spark):
    a = spark.sql("select named_struct('s', array(map('x', 1, 'y', 2))) v")
    b = spark.sql("select named_struct('s', array(map('y', 2, 'x', 1))) v")
    c = spark.sql("select named_struct('s', array(map('y', 3, 'x', 1))) v")
    assert prints(a) == prints(b) != prints(c)


def test_null_struct_differs_from_struct_of_nulls(spark):
    df = spark.sql(
        """select cast(null as struct<m:map<string,int>>) v
           union all select named_struct('m', cast(null as map<string,int>))"""
    )
    assert len(set(prints(df))) == 2


def test_column_order_and_added_null_column_change_nothing(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    wider = df.withColumn("c", F.lit(None).cast("string"))
    assert prints(df) == prints(df.select("b", "a")) == prints(wider)


def test_microseconds_are_kept_and_zone_does_not_matter(spark):
    times = [(datetime(2024, 1, 1, 0, 0, 0, 1),), (datetime(2024, 1, 1, 0, 0, 0, 2),)]
    df = spark.createDataFrame(times, "t timestamp")
    in_utc = prints(df)
    assert len(set(in_utc)) == 2
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert prints(df) == in_utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_names_with_dots_and_ticks(spark):
    df = spark.createDataFrame([(1, 2)], "`a.b` int, `c``d` int")
    assert len(prints(df)[0]) == len(prints(df, "compat")[0]) == 64


def test_key_is_the_fingerprint_in_bytes_and_ignores_itself(spark):
    df = spark.createDataFrame([(1,)], "a int")
    keyed = df.withColumn(KEY, row_key(df.schema))
    assert keyed.first()[KEY].hex().upper() == prints(df)[0].upper()
    assert prints(keyed) == prints(df)


def test_row_of_maps_only_and_unknown_mode(spark):
    df = spark.sql("select map('a', 1) m")
    assert prints(df, "compat")
    with pytest.raises(ValueError):
        row_fingerprint(df.schema, "loose")
