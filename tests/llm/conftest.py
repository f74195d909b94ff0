import random

import pytest

from tallybook.llm import queries

LONG = " ".join(f"word{i % 997} tail{i}" for i in range(12_000))
CLASH = ("held_out", "score", "bucket", "kind", "size", "key", "set_id", "n", "t", "w", "goal", "sp_ids", "n_words")


def prose(seed, words=60, vocabulary=400):
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(words))


def odd_rows():
    """Doc id and text: nulls, empties, copies, near copies, one id with two texts, a very long text."""
    base = prose(1)
    return [
        (1, base),
        (2, base),
        (2, base),
        (3, base + " one more"),
        (4, None),
        (5, ""),
        (6, " \t\n "),
        (7, "few words"),
        (7, "few words only here"),
        (8, prose(2) + "\n" + prose(3) + "\n" + prose(3)),
        (9, "x " + prose(3)),
        (None, base),
        (10, LONG),
        (11, "Éa été — naïve Straße 日本語 テキスト, don't <|x|> ###! " * 3),
        (12, "FEW WORDS"),
        (13, "\x00odd space\x1c and▁mark"),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    queries.prepare(spark)
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
        f"{c} string" for c in CLASH
    )
    rows = [(i, t, None if i in (4, 8) else "en", None, len(t or ""), *("x" for _ in CLASH)) for i, t in odd_rows()]
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    """No rows, all columns."""
    return odd.filter("false").select("doc_id", "text", "lang", "source", "n_chars")


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, i % 2, (i + 1) % 2) for i in range(1, 13)] + [(3, None, None), (None, 1, 1), (999, 0, 1), (1, 0, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def small(spark):
    """The smallest supplied tables."""
    queries.prepare(spark)
    return lambda name: spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
