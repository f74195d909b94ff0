import pytest

from tallybook.functions import KEY
from tallybook.plans import reconcile as module
from tallybook.plans.landing import append_new
from tallybook.plans.reconcile import differing_prefixes, reconcile, reconcile_content
from tallybook.sources.tables import TableRef, read_table


def found(sources, target):
    return sorted(tuple(r) for r in reconcile_content(sources, target).collect())


@pytest.fixture
def pairs(spark):
    return lambda *values: spark.createDataFrame([(v, str(v)) for v in values], "i int, s string")


def test_a_row_swapped_for_a_copy_is_found(pairs):
    """Counts agree, content doesn't."""
    sources = {"east": pairs(1, 2), "west": pairs(3, 4)}
    target = pairs(1, 2, 3, 3)
    assert [r["ok"] for r in reconcile({"t": sources}, {"t": target}).collect()] == [True]
    assert found(sources, target) == [(3, "3", 1, 2), (4, "4", 1, 0)]


def test_equal_multisets_differ_in_nothing(pairs, spark):
    assert found({"a": pairs(*range(50), 1, 1), "b": pairs(7)}, pairs(7, 1, 1, *range(50))) == []
    assert found({}, pairs()) == [] and found({"a": pairs()}, pairs()) == []
    assert found({}, pairs(5)) == [(5, "5", 0, 1)] and found({"a": pairs(5)}, pairs()) == [(5, "5", 1, 0)]


def test_ledgers_lend_their_keys(spark, pairs, tmp_path):
    goal = TableRef.under(str(tmp_path), "land", "s", "t")
    append_new(pairs(1, 2, 2, 9), goal)
    target = read_table(spark, goal, with_key=True)
    assert found({"a": pairs(1, 2, 3)}, target) == [(2, "2", 1, 2), (3, "3", 1, 0), (9, "9", 0, 1)]
    wider = spark.createDataFrame([(1.0, "1", None), (2.5, "x", "new")], "i double, s string, n string")
    got = sorted(map(tuple, reconcile_content({"a": wider}, target).collect()), key=str)
    assert got == [(2.0, "2", None, 0, 2), (2.5, "x", "new", 1, 0), (9.0, "9", None, 0, 1)]


def test_only_differing_prefixes_are_counted(spark, pairs, monkeypatch):
    """Of many rows the second step keeps those that share a prefix with a differing one."""
    seen = {}
    original = module.materialise

    def recording(df, label):
        result = original(df, label)
        seen[label] = result[1]
        return result

    monkeypatch.setattr(module, "materialise", recording)
    assert found({"a": pairs(*range(3000))}, pairs(*range(2999), 2998)) == [(2998, "2998", 1, 2), (2999, "2999", 1, 0)]
    assert seen == {"differing-prefixes": 2, "differing-keys": 2}
    seen.clear()
    assert found({"a": pairs(*range(100))}, pairs(*range(100))) == [] and seen == {"differing-prefixes": 0}


def test_even_numbers_of_copies_do_not_cancel(spark):
    keys = spark.createDataFrame([(bytearray(b"ab1"), 2, 0), (bytearray(b"cd1"), 1, 1)], f"{KEY} binary, s long, t long")
    assert [bytes(r["prefix"]) for r in differing_prefixes(keys).collect()] == [b"ab"]


def test_names_with_tabs(spark):
    got = reconcile({"a\tb": {"x\ty": spark.range(3)}}, {"a\tb": spark.range(3)}).collect()
    assert [tuple(r) for r in got] == [("a\tb", 3, 3, True)]
