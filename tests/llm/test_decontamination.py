import duckdb
import pytest

from tallybook.llm import decontamination, queries
from tallybook.llm.decontamination import hits, without_items
from tests.llm.conftest import prose


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, doc_id string, score string")


def ids(df):
    return sorted((r["doc_id"], r["item_id"]) for r in df.collect())


def test_items_in_long_texts_are_found_and_clean_texts_left(spark):
    queries.prepare(spark)
    bench = {i: prose(500 + i, 24 + 9 * i, 5_000) for i in range(6)}
    rows = [(i, prose(i, 700, 5_000)) for i in range(20)]
    rows += [(100 + i, prose(50 + i, 61 * i, 5_000) + " " + t.upper() + "\n" + prose(90 + i, 200, 5_000)) for i, t in bench.items()]
    rows += [(200 + i, " ".join(t.split()[: len(t.split()) // 2])) for i, t in bench.items()]
    rows += [(300, " ".join(sorted(bench[3].split())))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = items(spark, [(i, t, "x", "x") for i, t in bench.items()])
    assert ids(hits(docs, table)) == [(100 + i, i) for i in range(6)]
    left = without_items(docs, table)
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(i for i, _ in rows if not 100 <= i < 200)


@pytest.mark.parametrize("bound", [32 << 20, 200])
def test_index_in_one_part_or_many(spark, small, monkeypatch, bound):
    monkeypatch.setattr(decontamination, "INDEX_BYTES", bound)
    monkeypatch.setattr(decontamination, "SHARD_ITEMS", 7)
    duck = duckdb.connect()
    for name in ("documents", "benchmark"):
        duck.execute(f"create view {name} as select * from '/root/testdata/sf0.001/{name}.parquet'")
    want = sorted((r[0], r[1]) for r in duck.execute(decontamination.oracle()).fetchall())
    docs = small("documents")
    bench = small("benchmark") if bound > 200 else small("benchmark").limit(8)
    got = ids(hits(docs, bench))
    if bound > 200:
        assert got == want and got
    else:
        assert set(got) <= set(want)


def test_odd_inputs(odd, none, spark):
    odd_items = items(spark, [(1, None, "x", "x"), (2, "", "x", "x"), (3, "few words", "x", "x"), (3, "Few WORDS", "x", "x"),
                              (None, prose(1), "x", "x")])
    found = {(r["doc_id"], r["item_id"]) for r in hits(odd, odd_items).collect()}
    assert {(7, 3), (12, 3), (1, None), (3, None), (None, None)} <= found
    assert not any(d in (4, 5, 6, 11) for d, _ in found)
    left = without_items(odd, odd_items)
    assert left.columns == odd.columns and {4, 5, 6, 10, 11} <= {r["doc_id"] for r in left.collect()}
    empty = odd_items.filter("false")
    assert hits(odd, empty).count() == 0 and without_items(odd, empty).count() == odd.count()
    assert hits(none, odd_items).count() == 0 and without_items(none, odd_items).count() == 0
