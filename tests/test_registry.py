import pytest

from tallybook.operators.filters import apply_exclusions, user_assets
from tallybook.sources.registry import (
    discover_sources,
    existing_tables,
    list_schemas,
    list_tables,
    registry_from_catalogs,
    registry_from_root,
    registry_of,
    shared_catalogs,
    tables_by_schema,
    to_refs,
)
from tallybook.sources.tables import TableRef


@pytest.fixture
def registry(spark):
    names = [
        ("system", "a", "t"),
        ("system", "ai", "t"),
        ("system", "access", "logging"),
        ("system", "access", "__internal_logging"),
        ("x_system", "access", "logging"),
        ("coe_system", "access", "logging"),
        ("other", "access", "logging"),
    ]
    return registry_of(spark, [TableRef(*n) for n in names])


def test_exclusion_is_exact_not_by_substring(registry, rows):
    assert rows(list_schemas(registry, "system", ["ai"])) == [("a",), ("access",)]
    assert rows(list_tables(registry, "system", "access")) == [("logging",)]


def test_sources_by_name(registry, rows):
    assert rows(discover_sources(registry)) == [("system",), ("x_system",)]
    assert rows(discover_sources(registry, targets=["system"])) == [("x_system",)]


def test_tables_by_schema(registry, rows):
    got = {r[:2]: r[2] for r in rows(tables_by_schema(registry))}
    assert got["access", "logging"] == ["coe_system", "other", "system", "x_system"]


def test_registry_from_folders(spark, tmp_path):
    for name in ("c/s/t", "c/s/u", "d/s/t"):
        spark.range(1).write.parquet(str(tmp_path / name))
    found = to_refs(registry_from_root(spark, str(tmp_path), "parquet", "share"))
    assert [r.name for r in found] == ["c.s.t", "c.s.u", "d.s.t"]
    assert registry_from_root(spark, str(tmp_path / "none")).count() == 0


def test_registry_from_catalogs(spark, tmp_path):
    spark.sql(f"create table tallybook_listed using parquet location '{tmp_path}/x' as select 1 a")
    try:
        found = registry_from_catalogs(spark, ["spark_catalog"])
        assert "tallybook_listed" in [r["table"] for r in found.collect()]
    finally:
        spark.sql("drop table tallybook_listed")


def test_shared_and_existing(spark, registry, rows):
    shared = registry_of(spark, [TableRef("s", "a", "t")], "share")
    assert rows(shared_catalogs(registry.unionByName(shared))) == [("s",)]
    candidates = spark.createDataFrame(
        [("system", "a", "t"), ("system", "a", "gone")], "catalog string, schema string, table string"
    )
    assert rows(existing_tables(candidates, registry)) == [("system", "a", "t")]


def test_null_names(spark):
    df = spark.createDataFrame(
        [(None, "s", "t"), ("c", None, "t"), ("c", "s", "t")],
        "catalog_name string, schema_name string, table_name string",
    )
    assert apply_exclusions(df).count() == 3
    assert apply_exclusions(df, schemas=["ai"]).count() == 2
    assert apply_exclusions(df, schemas=["ai"], keep_nulls=True).count() == 3
    assert apply_exclusions(df, ["ai"], ["x"], ["y"]).count() == 1


def test_user_assets(spark, rows):
    df = spark.createDataFrame(
        [
            ("c", "s", "t"),
            ("c", "s", "t"),
            ("c", "information_schema", "t"),
            ("system", "s", "t"),
            ("__inner_x", "s", "t"),
        ],
        "catalog_name string, schema_name string, table_name string",
    )
    assert rows(user_assets(df, internal_prefix="__inner")) == [("c", "s", "t")]
    assert user_assets(df).count() == 2
