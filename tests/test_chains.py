import pytest

from tallybook.operators import chains
from tallybook.operators.chains import in_page_order, page_faults, page_positions

SCHEMA = "c string, token string, next string, item int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], SCHEMA)


ARGS = (["c"], "token", "next")


def positions(df):
    return sorted((r["chain"]["c"], r["page"], r["position"]) for r in page_positions(df, *ARGS).collect())


def faults(df):
    return sorted(map(tuple, page_faults(df, *ARGS).collect()), key=str)


def test_whole_chains(spark):
    long = [("a", None if i == 0 else f"t{i}", f"t{i + 1}" if i < 36 else None) for i in range(37)]
    df = pages(spark, [*reversed(long), ("b", "", None), ("d", None, "")])
    assert positions(df) == sorted([("a", f"t{i}" if i else "", i) for i in range(37)] + [("b", "", 0), ("d", "", 0)])
    assert faults(df) == []


def test_lost_pages_and_what_is_behind_them(spark):
    df = pages(spark, [("a", None, "t1"), ("a", "t2", "t3"), ("a", "t3", None), ("b", "t1", None)])
    assert positions(df) == [("a", "", 0)]
    assert faults(df) == [
        ("a", "lost", "t1", 1), ("a", "unreached", "t2", 1), ("a", "unreached", "t3", 1), ("b", "unreached", "t1", 1),
    ]


def test_loops_end(spark):
    df = pages(spark, [("a", None, "t1"), ("a", "t1", "t2"), ("a", "t2", "t1"), ("b", None, "t1"), ("b", "t1", "t1")])
    assert positions(df) == [("a", "", 0), ("a", "t1", 1), ("a", "t2", 2), ("b", "", 0), ("b", "t1", 1)]
    assert faults(df) == [("a", "loop", "t1", 1), ("b", "loop", "t1", 1)]


def test_pages_served_twice(spark):
    rows = [("a", None, "t1", 0), ("a", "t1", None, 1), ("a", "t1", None, 1), ("a", "t1", "t2", 2), ("a", "t2", None, 3)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert faults(df) == [("a", "repeated", "t1", 3)]
    got = sorted((r["item"], r["page_position"]) for r in in_page_order(df, *ARGS).collect())
    assert got == [(0, 0), (1, 1), (2, 1), (3, 2)]


def test_nulls_in_chain_names_and_no_pages(spark):
    df = pages(spark, [(None, None, "t1"), (None, "t1", None), ("a", "t9", None)])
    got = sorted(((r["c"], r["token"], r["page_position"]) for r in in_page_order(df, *ARGS).collect()), key=str)
    assert got == sorted([("a", "t9", None), (None, None, 0), (None, "t1", 1)], key=str)
    none = df.filter("false")
    assert page_faults(none, *ARGS).count() == in_page_order(none, *ARGS).count() == 0


@pytest.mark.parametrize("length", [1, 2, 3, 8, 9])
def test_lengths_around_powers_of_two(spark, length):
    df = pages(spark, [("a", f"t{i}" if i else None, f"t{i + 1}" if i < length - 1 else None) for i in range(length)])
    assert positions(df) == sorted(("a", f"t{i}" if i else "", i) for i in range(length))


def test_rounds_move_numbers_alone(spark, monkeypatch):
    """However long names and tokens are; and a page that leads to two still gets its fewest steps."""
    seen = []
    write = chains.materialise
    monkeypatch.setattr(chains, "materialise", lambda df, label: seen.append((label, df.dtypes)) or write(df, label))
    long = "x" * 500
    rows = [("a" + long, None, long), ("a" + long, None, "t9"), ("a" + long, long, "t9"), ("a" + long, "t9", None)]
    assert sorted((page, n) for _, page, n in positions(pages(spark, rows))) == [("", 0), ("t9", 1), (long, 1)]
    rounds = [dtypes for label, dtypes in seen if label in ("chain-jumps", "chain-known")]
    assert len(rounds) >= 3 and all(kind == "bigint" for dtypes in rounds for _, kind in dtypes)
