import pytest

from tallybook.operators.reshape import (
    keys_present,
    map_entries_long,
    map_key_set,
    map_to_columns,
    prefix_columns,
    select_available,
)
from tallybook.plans.compute import NARROW_COLUMNS, POLICY_CREATOR, WIDE_COLUMNS, compute_policy
from tallybook.plans.models import MODEL_VERSION_COLUMNS, model_versions
from tallybook.sources.payloads import DETAIL_SCHEMA, read_payload


def test_map_to_columns(spark, rows):
    df = spark.sql("select 1 id, map('a', 'x') m union all select 2, map('b', 'y') union all select 3, null")
    assert rows(map_key_set(df, "m")) == [("a",), ("b",)]
    got = map_to_columns(df, "m", ["a", "b", "z"])
    assert got.columns == ["id", "m", "a", "b", "z"]
    assert rows(got.drop("m")) == [(1, "x", None, None), (2, None, "y", None), (3, None, None, None)]
    assert map_to_columns(df, "m", ["id", "a"], keep=["id"]).first()["id"] in (1, 2, 3)
    assert rows(map_entries_long(df, "m")) == [(1, "a", "x"), (2, "b", "y"), (3, None, None)]
    assert keys_present(df, "m", ["z", "b", "a"]) == ["b", "a"]
    assert keys_present(df.filter("id > 3"), "m", ["a"]) == []


def test_select_available_and_prefix(spark):
    df = spark.sql("select 1 b, 2 a")
    assert select_available(df, ["a", "x", "b"]).columns == ["a", "b"]
    assert select_available(df, ["a", "x", "b"], fill_missing=True).first()["x"] is None
    assert prefix_columns(df, "p").columns == ["p_b", "p_a"]


@pytest.fixture
def compute(spark):
    clusters = spark.sql(
        """select * from values ('c1', 7), ('c1', 7), ('c2', 7), ('c3', 8), ('c9', 99)
           as t(cluster_id, workspace_id)"""
    )
    inventory = spark.sql("select 7 workspace_id, 'https://w7' deployment_url union all select 8, 'https://w8'")
    details = spark.sql(
        """select 'c1' cluster_id, map('cluster_id', 'c1', 'policy_id', 'p1', 'state', 'ON',
                  'creator_user_name', 'ann', 'unlisted', 'x') cluster_info
           union all select 'c3', map('cluster_id', 'c3', 'state', 'OFF')"""
    )
    policies = spark.sql(
        """select 'p1' policy_id, 'base' name, array(1, 2) libraries, 'bob' creator_user_name,
                  true is_default"""
    )
    return clusters, inventory, details, policies


def test_wide_policies(compute, rows):
    got = compute_policy(*compute)
    assert [c for c in got.columns if c not in WIDE_COLUMNS] == [POLICY_CREATOR]
    assert len(WIDE_COLUMNS) == 56 and "unlisted" not in got.columns
    names = ["cluster_id", "state", "creator_user_name", "policy_name", POLICY_CREATOR, "libraries"]
    assert rows(got, *names) == [
        ("c1", "ON", "ann", "base", "bob", "[1,2]"),
        ("c3", "OFF", None, None, None, None),
    ]
    fixed = compute_policy(*compute, cluster_keys=["state"])
    assert rows(fixed, "cluster_id", "state") == [("c1", "ON"), ("c3", "OFF")]


def test_narrow_policies_keep_every_cluster(compute, rows):
    got = compute_policy(*compute, form="narrow")
    assert got.columns == [*NARROW_COLUMNS, POLICY_CREATOR] and len(NARROW_COLUMNS) == 27
    types = dict(got.dtypes)
    assert types.pop("is_default") == "boolean" and set(types.values()) == {"string"}
    assert rows(got, "workspace_id", "cluster_id", "policy_id", "is_default") == [
        ("7", "c1", "p1", True),
        ("7", "c2", None, None),
        ("8", "c3", None, None),
    ]


def test_policy_column_is_there_without_any_policy(compute, spark):
    clusters, inventory, details, policies = compute
    bare = details.selectExpr("cluster_id", "map_filter(cluster_info, (k, v) -> k <> 'policy_id') cluster_info")
    got = compute_policy(clusters, inventory, bare, policies)
    assert got.filter("policy_id is not null").count() == 0
    with pytest.raises(ValueError, match="form"):
        compute_policy(*compute, form="tall")


def test_payload_keys_tell_workspaces_apart(compute, spark, rows):
    clusters, inventory, _, policies = compute
    same_id = spark.sql(
        """select 7 workspace_id, 'c1' cluster_id, 'here' state
           union all select 8, 'c1', 'elsewhere'"""
    )
    got = compute_policy(clusters, inventory, same_id, policies)
    assert rows(got, "workspace_id", "cluster_id", "state") == [(7, "c1", "here")]


def test_model_versions(spark, tmp_path, rows):
    path = tmp_path / "d.json"
    path.write_text(
        '{"full_name":"m","workspace_url":"u","version":1,"model_name":"m","catalog_name":"c",'
        '"schema_name":"s","model_version_dependencies":{"dependencies":['
        '{"table":{"table_full_name":"a.b.c"}},{"volume":{"x":1}},'
        '{"function":{"function_full_name":"f"}}]},"aliases":[{"alias_name":"best","version_num":1}]}\n'
        '{"full_name":"m","workspace_url":"u","version":2,"schema_name":"s","catalog_name":"c"}\n'
        '{"full_name":"m","workspace_url":"u","version":9,"schema_name":"s","catalog_name":"c"}\n'
        '{"full_name":"n","workspace_url":"u","version":1,"schema_name":"ai","catalog_name":"c"}\n'
        '{"full_name":"m","workspace_url":"other","version":1,"schema_name":"s","catalog_name":"c"}\n'
    )
    details = read_payload(spark, str(path), DETAIL_SCHEMA)
    models = spark.sql("select 'u' workspace_url, 'm' full_name union all select 'u', 'n'")
    versions = spark.sql(
        """select * from values ('u', 'm', 1), ('u', 'm', 2), ('u', 'm', 3), ('u', 'n', 1),
           ('u', 'unlisted', 1) as t(workspace_url, full_name, version)"""
    )
    got = model_versions(models, versions, details, exclude_schemas=["ai"])
    assert got.columns == MODEL_VERSION_COLUMNS and len(MODEL_VERSION_COLUMNS) == 19
    one, two = got.orderBy("version").collect()
    assert one["dependencies"] == [
        {"type": "table", "name": "a.b.c"}, {"type": "function", "name": "f"},
    ]
    assert one["aliases"] == [{"alias_name": "best", "version_num": "1"}]
    assert two["dependencies"] == [] and two["aliases"] == []
    assert two["source"] == "" and two["run_id"] is None and two["version"] == 2
