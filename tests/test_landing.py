import pytest
from pyspark.sql import functions as F

from tallybook.plans.consolidation import consolidate_all, consolidate_table
from tallybook.plans.landing import append_new, land_catalog, land_table
from tallybook.sources.registry import registry_from_root, registry_of
from tallybook.sources.tables import TableRef, ledger_batches, read_table, replace_table


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "root")


@pytest.fixture
def goal(root):
    return TableRef.under(root, "land", "s", "t")


@pytest.fixture
def plain(spark, tmp_path):
    def write(name, df, catalog="a_system", schema="s"):
        ref = TableRef(catalog, schema, name, f"{tmp_path}/{catalog}/{schema}/{name}")
        replace_table(df, ref)
        return ref

    return write


def outcome(status):
    return status["action"], status["row_count"]


def test_replay_appends_nothing(spark, goal, plain):
    source = plain("t", spark.range(10))
    assert outcome(land_table(spark, source, goal)) == ("created", 10)
    assert outcome(land_table(spark, source, goal)) == ("unchanged", 0)
    assert len(ledger_batches(spark, goal.path)) == 1


def test_two_batches_equal_one(spark, goal, rows):
    append_new(spark.range(0, 6), goal)
    assert outcome(append_new(spark.range(4, 9), goal)) == ("appended", 3)
    assert rows(read_table(spark, goal)) == [(i,) for i in range(9)]


def test_copies_are_kept_unless_dedupe(spark, root, rows):
    source = spark.createDataFrame([(1,), (1,), (2,)], "i int")
    target = spark.createDataFrame([(2,)], "i int")
    for dedupe, want in ((False, [(1,), (1,), (2,)]), (True, [(1,), (2,)])):
        goal = TableRef.under(root, "land", "s", f"t{dedupe}")
        append_new(target, goal, dedupe=dedupe)
        append_new(source, goal, dedupe=dedupe)
        assert rows(read_table(spark, goal)) == want


def test_changed_rows_are_added_and_old_ones_stay(spark, goal, rows):
    append_new(spark.createDataFrame([(1, "old")], "i int, s string"), goal)
    append_new(spark.createDataFrame([(1, "new")], "i int, s string"), goal)
    assert rows(read_table(spark, goal)) == [(1, "new"), (1, "old")]


def test_column_order_and_types_of_the_target_hold(spark, goal):
    append_new(spark.createDataFrame([(1, "x")], "i long, s string"), goal)
    swapped = spark.createDataFrame([("x", 1)], "s string, i int")
    assert outcome(append_new(swapped, goal)) == ("unchanged", 0)


def test_widening_brings_back_no_old_row(spark, goal):
    narrow = spark.createDataFrame([(1, "a")], "i int, s string")
    wide = spark.createDataFrame([(2, "b", 0.5)], "i int, s string, d double")
    append_new(narrow, goal)
    assert outcome(append_new(wide, goal)) == ("appended", 1)
    assert outcome(append_new(narrow, goal)) == ("unchanged", 0)
    assert outcome(append_new(wide, goal)) == ("unchanged", 0)


def test_compat_mode_lands_with_the_old_identity(spark, goal):
    append_new(spark.createDataFrame([("", "x")], "p string, q string"), goal, mode="compat")
    again = spark.createDataFrame([(None, "x"), ("y", "z")], "p string, q string")
    assert outcome(append_new(again, goal, mode="compat")) == ("appended", 1)
    assert outcome(append_new(again, goal, mode="compat")) == ("unchanged", 0)
    # A later strict run finds every row known, but for the one whose NULL compat took for "".
    assert outcome(append_new(again, goal)) == ("appended", 1)
    assert outcome(append_new(again, goal)) == ("unchanged", 0)


def test_catalog_landing(spark, root, plain):
    refs = [
        plain("a", spark.range(3)),
        plain("_sqldf", spark.range(3)),
        plain("logging", spark.range(2)),
        plain("v", spark.range(1), schema="information_schema"),
        plain("m", spark.range(1), schema="ai"),
        plain("n", spark.range(1), schema="a"),
        TableRef("a_system", "s", "broken", f"{root}/nowhere"),
    ]
    registry = registry_of(spark, refs)
    args = (spark, registry, "a_system", "land", root)
    rename = {"information_schema": "landed_information_schema"}
    done = {r["table"]: r for r in land_catalog(*args, rename=rename).collect()}
    assert set(done) == {
        "land.s.a", "land.s.logging", "land.landed_information_schema.v", "land.a.n", "land.s.broken",
    }
    assert done["land.s.broken"]["action"] == "failed" and done["land.s.broken"]["error"]
    assert done["land.s.a"]["action"] == "created" and done["land.s.a"]["error"] is None
    with pytest.raises(Exception):
        land_catalog(*args, rename=rename, fail_fast=True)
    assert land_catalog(spark, registry, "no such", "land", root).count() == 0


def test_consolidation_is_stable_under_widening(spark, goal, plain):
    a = plain("t", spark.createDataFrame([(1, "x")], "i int, a string"), "a_system")
    b = plain("t", spark.createDataFrame([(2, "y", 3)], "i int, a string, c int"), "b_system")
    gone = TableRef("c_system", "s", "t", f"{goal.path}-gone")
    assert outcome(consolidate_table(spark, [a, gone, b], goal)) == ("created", 2)
    assert outcome(consolidate_table(spark, [b, a], goal)) == ("unchanged", 0)
    assert outcome(consolidate_table(spark, [gone], goal)) == ("skipped", 0)


def test_consolidation_in_compat_mode(spark, goal, plain):
    a = plain("t", spark.range(5), "a_system")
    b = plain("t", spark.range(3, 8), "b_system")
    assert outcome(consolidate_table(spark, [a], goal, mode="compat")) == ("created", 5)
    assert outcome(consolidate_table(spark, [a, b], goal, mode="compat")) == ("appended", 3)
    assert outcome(consolidate_table(spark, [a, b], goal, mode="compat")) == ("unchanged", 0)


def test_target_is_never_a_source(spark, root, plain, rows):
    refs = [plain("t", spark.range(2), c) for c in ("system", "x_system", "coe_system", "other")]
    first = consolidate_all(spark, registry_of(spark, refs), "y_system", root)
    assert rows(first, "table", "action", "row_count") == [("y_system.s.t", "created", 4)]
    found = registry_from_root(spark, root)
    both = registry_of(spark, refs).unionByName(found)
    again = consolidate_all(spark, both, "y_system", root)
    assert rows(again, "table", "action", "row_count") == [("y_system.s.t", "unchanged", 0)]


def test_pruned_landing_finds_late_rows(spark, goal):
    events = spark.range(100).select("id", F.timestamp_seconds("id").alias("ts"))
    append_new(events.filter("id > 20"), goal, prune_on="ts")
    assert outcome(append_new(events, goal, prune_on="ts")) == ("appended", 21)
    assert outcome(append_new(events.filter("id < 5"), goal, prune_on="ts")) == ("unchanged", 0)


@pytest.mark.parametrize("empty", ["limit", "filter", "rows"])
def test_empty_sources_and_targets(spark, goal, empty):
    some = spark.range(4)
    none = {
        "limit": some.limit(0),
        "filter": some.filter("id > 9"),
        "rows": spark.createDataFrame([], some.schema),
    }[empty]
    assert outcome(append_new(none, goal)) == ("created", 0)
    assert outcome(append_new(some, goal)) == ("appended", 4)
    assert outcome(append_new(none, goal)) == ("unchanged", 0)


@pytest.fixture
def named(spark):
    spark.sql("DROP SCHEMA IF EXISTS tallybook_made CASCADE")
    yield TableRef("spark_catalog", "tallybook_made", "t")
    spark.sql("DROP SCHEMA IF EXISTS tallybook_made CASCADE")


def test_catalog_targets_land_again_and_widen(spark, named, rows):
    narrow = spark.createDataFrame([(1, "a"), (1, "a")], "i int, s string")
    assert outcome(append_new(narrow, named)) == ("created", 2)
    assert outcome(append_new(narrow, named)) == ("unchanged", 0)
    assert read_table(spark, named).columns == ["i", "s"]
    wide = spark.createDataFrame([("b", 2, 0.5), ("a", 1, None)], "S string, i int, d double")
    assert outcome(append_new(wide, named)) == ("appended", 1)
    assert outcome(append_new(wide, named)) == ("unchanged", 0)
    assert rows(read_table(spark, named)) == [(1, "a", None), (1, "a", None), (2, "b", 0.5)]


def test_folders_of_files_land_again(spark, root, rows):
    goal = TableRef("c", "s", "t", f"{root}/plain")
    assert outcome(append_new(spark.range(3), goal)) == ("created", 3)
    assert outcome(append_new(spark.range(5), goal)) == ("appended", 2)
    assert outcome(append_new(spark.range(5), goal)) == ("unchanged", 0)
    assert rows(read_table(spark, goal)) == [(i,) for i in range(5)]
    with pytest.raises(ValueError, match="lacks"):
        append_new(spark.range(9).withColumn("x", F.lit(1)), goal)


def test_whole_catalogs_land_in_a_catalog(spark, named, plain):
    events = spark.range(40).select("id", F.timestamp_seconds("id").alias("ts"))
    refs = [plain("t", events, schema="tallybook_made"), plain("u", spark.range(2), schema="tallybook_made")]
    args = (spark, registry_of(spark, refs), "a_system", "spark_catalog", None)
    for action in ("created", "unchanged"):
        done = land_catalog(*args, prune_on={"tallybook_made.t": "ts"}, fail_fast=True).collect()
        assert {(r["table"], r["action"]) for r in done} == {
            ("spark_catalog.tallybook_made.t", action), ("spark_catalog.tallybook_made.u", action),
        }


def test_a_source_column_named_like_the_key_is_refused(spark, goal):
    with pytest.raises(ValueError, match="reserved"):
        append_new(spark.range(2).withColumn("_Row_Key", F.lit(1)), goal)


def test_a_large_batch_is_not_shuffled_to_be_packed(spark, tmp_path, monkeypatch):
    from tallybook.sources import tables

    seen = []
    write = tables._write_batch
    monkeypatch.setattr(tables, "_write_batch", lambda df, *rest: seen.append("Rebalance" in df._jdf.queryExecution().analyzed().toString()) or write(df, *rest))
    monkeypatch.setattr(tables, "PACKED_ROWS", 100 / spark.sparkContext.defaultParallelism)
    goal = tables.TableRef.under(str(tmp_path / "hub"), "land", "s", "t")
    done = [append_new(spark.range(n).withColumn("x", F.col("id") * 2), goal) for n in (10, 20, 500, 500)]
    assert [(r["action"], r["row_count"]) for r in done] == [("created", 10), ("appended", 10), ("appended", 480), ("unchanged", 0)]
    assert seen == [False, True, False]
    assert tables.read_table(spark, goal).count() == 500
