import os

from tallybook.plans.landing import append_new
from tallybook.plans.reconcile import reconcile
from tallybook.plans.stats import (
    asset_properties,
    asset_stats,
    live_properties,
    properties_map,
    table_properties,
    table_stats,
)
from tallybook.operators.aggregates import source_counts
from tallybook.sources.paths import full_address
from tallybook.sources.registry import registry_of
from tallybook.sources.tables import TableRef


def data_bytes(path):
    return sum(
        os.path.getsize(os.path.join(folder, f))
        for folder, _, files in os.walk(path)
        for f in files
        if not f.startswith(("_", "."))
    )


def test_sizes_and_counts_of_all_kinds_of_tables(spark, tmp_path):
    def ref(name, format):
        return TableRef("c", "s", name, str(tmp_path / f"a b+{name}"), format)

    spark.range(100).repartition(3).write.parquet(ref("p", "parquet").path)
    spark.range(10).selectExpr("id", "id % 2 as part").write.partitionBy("part").parquet(ref("parts", "parquet").path)
    spark.range(7).write.orc(ref("o", "orc").path)
    spark.range(5).write.json(ref("j", "json").path)
    spark.range(4).write.csv(ref("v", "csv").path)
    spark.range(0).write.parquet(ref("empty", "parquet").path)
    ledger = ref("ledger", "ledger")
    append_new(spark.range(5), ledger)
    append_new(spark.range(9), ledger)
    refs = [ref("p", "parquet"), ref("parts", "parquet"), ref("o", "orc"), ref("j", "json"),
            ref("v", "csv"), ref("empty", "parquet"), ledger, ref("gone", "parquet")]
    got = {r["table_name"]: r for r in table_stats(spark, registry_of(spark, refs)).collect()}
    counts = {n: r["row_count"] for n, r in got.items()}
    assert counts == {"p": 100, "parts": 10, "o": 7, "j": 5, "v": 4, "empty": 0, "ledger": 9}
    for r in refs[:-1]:
        row = got[r.table]
        assert row["size_in_bytes"] == data_bytes(r.path) > 0
        assert row["size_in_mb"] == round(row["size_in_bytes"] / 1024**2, 3)


def test_stats_of_catalog_tables_and_of_nothing(spark, tmp_path):
    spark.sql(f"create table tallybook_counted using parquet location '{tmp_path}/x' as select id from range(6)")
    try:
        ref = TableRef("spark_catalog", "default", "tallybook_counted")
        got = table_stats(spark, registry_of(spark, [ref])).first()
        assert got["row_count"] == 6 and got["size_in_bytes"] == data_bytes(f"{tmp_path}/x") > 0
        spark.sql("alter table tallybook_counted set tblproperties ('team' = 'a')")
        props = live_properties(spark, registry_of(spark, [ref])).first()["properties"]
        assert props["team"] == "a"
    finally:
        spark.sql("drop table tallybook_counted")
    assert table_stats(spark, registry_of(spark, [])).count() == 0


def test_addresses_keep_store_and_bucket():
    assert full_address("s3://eu/a/b/") == "s3://eu/a/b" != full_address("s3://us/a/b")
    assert full_address("file:///a/b") == full_address("file:/a/b") == "file:/a/b"


def test_a_view_has_rows_and_no_size(spark, tmp_path):
    spark.sql(f"create table tallybook_base using parquet location '{tmp_path}/b' as select id from range(4)")
    spark.sql("create view tallybook_seen as select * from tallybook_base")
    try:
        ref = TableRef("spark_catalog", "default", "tallybook_seen")
        got = table_stats(spark, registry_of(spark, [ref])).first()
        assert (got["row_count"], got["size_in_bytes"], got["size_in_mb"]) == (4, None, None)
    finally:
        spark.sql("drop view tallybook_seen")
        spark.sql("drop table tallybook_base")


NAMES = "catalog_name string, schema_name string, table_name string"


def test_properties_stay_aligned(spark, rows):
    tables = spark.sql(
        """select 'c' catalog_name, 's' schema_name, 't' table_name,
                  map('b', '2', 'a', cast(null as string)) properties
           union all select 'c', 's', 'u', map()"""
    )
    assert rows(table_properties(tables)) == [("c", "s", "t", ["a", "b"], [None, "2"])]


def test_property_rows_to_map(spark):
    data = [("c", "s", "t", "b", "2"), ("c", "s", "t", "a", None), ("c", "s", "t", "b", "2"), ("c", "s", "t", "b", "1")]
    got = properties_map(spark.createDataFrame(data, NAMES + ", key string, value string"))
    assert got.first()["properties"] == {"a": None, "b": "2"}


def test_unreachable_tables_have_null_stats(spark, rows):
    assets = spark.createDataFrame([("c", "s", "t"), ("c", "s", "gone")], NAMES)
    stats = spark.createDataFrame([("c", "s", "t", 5)], NAMES + ", row_count long")
    joined = asset_stats(assets, stats)
    assert rows(joined, "table_name", "row_count") == [("gone", None), ("t", 5)]
    props = spark.createDataFrame([("c", "s", "t", ["k"])], NAMES + ", property_keys array<string>")
    assert rows(asset_properties(joined, props), "table_name", "property_keys") == [("gone", None), ("t", ["k"])]


def test_reconcile_sees_a_lost_row(spark, rows):
    sources = {"t": {"a": spark.range(3), "b": spark.range(2)}, "u": {"a": spark.range(0)}}
    targets = {"t": spark.range(4), "u": spark.range(0)}
    assert rows(reconcile(sources, targets)) == [("t", 5, 4, False), ("u", 0, 0, True)]
    targets["t"] = spark.range(5)
    assert rows(reconcile(sources, targets), "table", "ok") == [("t", True), ("u", True)]
    assert rows(reconcile({"x": {"a": spark.range(1)}}, {})) == [("x", 1, 0, False)]


def test_counts_include_empty_sources(spark, rows):
    got = source_counts({"a": spark.range(3), "b": spark.range(0)})
    assert rows(got) == [("a", 3), ("b", 0)]
