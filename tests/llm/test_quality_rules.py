import re
from collections import Counter

from tallybook.llm import queries
from tallybook.llm.quality_rules import COUNTS, Condition, judged, learn, statistics, verdict


def counted(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    covered = {k + j for k in range(len(words) - 2) if seen[tuple(words[k : k + 3])] > 1 for j in range(3)}
    base = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), base


def key(row):
    return str(row)


def test_base_counts_of_odd_texts(odd, labels):
    got = [tuple(r) for r in judged(odd, labels).select("doc_id", *COUNTS, "base_failed").collect()]
    want = [(r["doc_id"], *counted(r["text"])) for r in odd.select("doc_id", "text").collect()]
    assert sorted(got, key=key) == sorted(want, key=key)


def test_registered_query_against_brute_force(spark, small):
    got = {r["doc_id"]: r for r in queries.op1_quality_rules(spark, "/root/testdata/sf0.001").collect()}
    for r in small("documents").collect():
        row = got[r["doc_id"]]
        assert tuple(row[c] for c in (*COUNTS, "base_failed")) == counted(r["text"])
        assert not (row["base_failed"] and row["kept"])


def test_rules_are_found_and_kept_apart(spark):
    rows = [(i, ("bad### " if i % 3 == 0 else "good ") * 3 + " ".join(f"u{i}x{k}" for k in range(60))) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(150)], "doc_id long, quality int")
    stats = statistics(docs)
    rules = learn(stats, labels)
    assert rules and all(isinstance(c, Condition) for rule in rules for c in rule)
    assert "symbol_pct" in str(rules[0][0])
    kept = {r[0] for r in stats.filter(verdict(rules)).select("doc_id").collect()}
    assert kept == {i for i in range(150) if i % 3}


def test_nothing_to_learn_from(odd, none, labels):
    empty = labels.filter("false")
    assert learn(statistics(odd), empty) == []
    assert judged(odd, empty).filter("kept = base_failed").count() == 0
    assert judged(none, labels).count() == 0


def test_plan_has_no_python(odd, labels, capsys):
    judged(odd, labels).explain()
    assert "Python" not in capsys.readouterr().out
