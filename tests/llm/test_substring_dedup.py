import hashlib

from tallybook.llm import queries, substring_dedup
from tallybook.llm.substring_dedup import dedup, digest


def brute(rows, size=13):
    """Per row: words, removed, kept words."""
    big = 2**63 - 1
    first = {}
    split = [(big if d is None else d, (t or "").encode().split()) for d, t in rows]
    for d, ws in split:
        for k in range(len(ws) - size + 1):
            w = tuple(ws[k : k + size])
            first[w] = min(first.get(w, big), d)
    out = []
    for (doc, _), (d, ws) in zip(rows, split, strict=True):
        gone = {k + j for k in range(len(ws) - size + 1) if first[tuple(ws[k : k + size])] < d for j in range(size)}
        out.append((doc, len(ws), len(gone), b" ".join(w for i, w in enumerate(ws) if i not in gone)))
    return out


def check(df, rows):
    want = [(d, n, g, hashlib.sha256(kept).hexdigest()) for d, n, g, kept in brute(rows)]
    assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_odd_texts(odd, monkeypatch):
    check(digest(odd), pairs(odd))
    monkeypatch.setattr(substring_dedup, "HELD", 50)
    check(digest(odd), pairs(odd))


def test_registered_query(spark, small):
    check(queries.op7_substring_dedup(spark, "/root/testdata/sf0.001"), pairs(small("documents")))


def test_texts_are_cut(odd, none):
    cut = dedup(odd)
    assert cut.columns == [*odd.columns, "n_removed_words"]
    got = sorted(((r["doc_id"], r["n_removed_words"], r["text"], r["bucket"]) for r in cut.collect()), key=str)
    rows = pairs(odd)
    want = [
        (d, g, kept.decode() if g else t, "x") for (d, t), (_, _, g, kept) in zip(rows, brute(rows), strict=True)
    ]
    assert got == sorted(want, key=str)
    assert digest(none).count() == 0 and dedup(none).count() == 0


def test_saturated_sketch_changes_nothing(odd, monkeypatch):
    """With far too few cells everything counts as repeated; the exact pass still decides."""
    monkeypatch.setattr(substring_dedup.sketch, "width_for", lambda hashes: 8)
    check(digest(odd), pairs(odd))
