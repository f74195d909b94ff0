import pytest

from tallybook.operators.reshape import map_to_columns
from tallybook.operators.variants import payload_keys, variant_columns
from tallybook.sources.payloads import read_variant_payload

TEXTS = [
    (1, '{"a": 1, "b": {"c": [1, 2]}, "d e": "x", "t": true, "z": null}'),
    (2, '{"a": 1.5, "b": null, "k\'q": 1}'),
    (3, '{"a": 7, "b": {"c": []}, "m": "text"}'),
    (4, '{"m": 4}'),
    (5, "no json {"),
    (6, None),
    (7, ""),
    (8, "[1, 2]"),
    (9, "{}"),
]


@pytest.fixture
def payloads(spark):
    return spark.createDataFrame(TEXTS, "id int, p string")


def test_keys_and_types_come_from_the_values(payloads, rows):
    found = {r["key"]: (r["type"], r["n_rows"]) for r in payload_keys(payloads, "p").collect()}
    assert found.pop("b") == ("OBJECT<c: ARRAY<BIGINT>>", 3)
    assert found == {
        "a": ("DECIMAL(21,1)", 3), "d e": ("STRING", 1), "t": ("BOOLEAN", 1), "z": ("VOID", 1), "k'q": ("BIGINT", 1),
        "m": ("VARIANT", 2),
    }


def test_columns_of_varying_objects(payloads):
    got = variant_columns(payloads, "p", required=["policy", "a"])
    assert got.columns == ["id", "a", "b", "d e", "k'q", "m", "t", "z", "policy"]
    types = dict(got.dtypes)
    assert (types["b"], types["m"], types["t"], types["z"]) == ("variant", "variant", "boolean", "string")
    found = {r["id"]: r for r in got.selectExpr("*", "to_json(b) bj", "cast(m as string) ms").collect()}
    assert [float(found[i]["a"]) for i in (1, 2, 3)] == [1, 1.5, 7]
    assert found[1]["bj"] == '{"c":[1,2]}' and found[1]["d e"] == "x" and found[2]["k'q"] == 1
    assert (found[3]["ms"], found[4]["ms"]) == ("text", "4")
    assert all(v is None for i in (5, 6, 7, 8, 9) for v in found[i].asDict().values() if v != i)
    assert len(found) == len(TEXTS)


def test_named_keys_alone(payloads):
    assert variant_columns(payloads, "p", keys=["m", "never"]).columns == ["id", "m", "never"]


def test_too_many_or_clashing_keys_are_errors(spark, payloads):
    with pytest.raises(ValueError, match="more than 3"):
        variant_columns(payloads, "p", max_columns=3)
    with pytest.raises(ValueError, match="clashes"):
        variant_columns(payloads.withColumnRenamed("id", "A"), "p")
    cased = spark.createDataFrame([('{"x": 1, "X": 2}',)], "p string")
    with pytest.raises(ValueError, match="clashes"):
        variant_columns(cased, "p")
    maps = spark.sql("select map('a', '1', 'b', '2', 'c', '3') m")
    with pytest.raises(ValueError, match="more than 2"):
        map_to_columns(maps, "m", max_columns=2)


def test_strict_refuses_what_is_no_json(payloads):
    with pytest.raises(Exception, match="MALFORMED|JSON"):
        variant_columns(payloads, "p", strict=True).collect()


def test_no_rows_and_no_keys(spark, payloads):
    assert variant_columns(payloads.limit(0), "p").columns == ["id"]
    assert variant_columns(payloads.filter("id = 9"), "p", required=["a"]).collect()[0].asDict() == {"id": 9, "a": None}


def test_map_keys_are_found(spark, rows):
    maps = spark.sql("select 1 id, map('b', '2', 'a', '1') m union all select 2, map() union all select 3, null")
    got = map_to_columns(maps, "m", required=["policy_id"]).drop("m")
    assert got.columns == ["id", "a", "b", "policy_id"]
    assert rows(got) == [(1, "1", "2", None), (2, None, None, None), (3, None, None, None)]


def test_lines_of_a_file(spark, tmp_path):
    (tmp_path / "users.json").write_text('{"id": "1", "roles": [{"value": "x"}]}\nbroken\n{"id": "2"}\n')
    users = variant_columns(read_variant_payload(spark, str(tmp_path)), "payload")
    got = users.selectExpr("id", "variant_get(roles, '$[0].value', 'string') r").collect()
    assert sorted(map(tuple, got), key=repr) == [("1", "x"), ("2", None), (None, None)]


def test_keys_are_combined_before_the_shuffle(payloads):
    plan = payload_keys(payloads, "p")._jdf.queryExecution().executedPlan().toString()
    assert "partial_schema_of_variant_agg" in plan and plan.count("Exchange") == 1
