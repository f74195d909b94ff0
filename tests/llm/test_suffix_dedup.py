import collections
import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallybook.llm import suffix_dedup
from tallybook.llm.suffix_dedup import dedup, digest, equal_groups


def brute(texts, size):
    """Of each text the bytes that go, as flags."""
    bodies = [(t or "").encode() for t in texts]
    counts = collections.Counter(b[p : p + size] for b in bodies for p in range(len(b) - size + 1))
    found = []
    for b in bodies:
        gone = np.zeros(len(b), dtype=bool)
        for p in range(len(b) - size + 1):
            if counts[b[p : p + size]] > 1:
                gone[p : p + size] = True
        found.append((b, gone))
    return found


def want(rows, size):
    out = []
    for (doc, _), (b, gone) in zip(rows, brute([t for _, t in rows], size), strict=True):
        n_spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((doc, len(b), int(gone.sum()), n_spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def check(df, size=200):
    assert sorted(map(tuple, digest(df, size).collect()), key=str) == want(pairs(df), size)


def test_odd_texts(odd, monkeypatch):
    check(odd)
    check(odd, 67)
    monkeypatch.setattr(suffix_dedup, "HELD", 300)
    check(odd, 67)


@pytest.fixture(scope="module")
def repeats(spark):
    """Texts of one byte only, of short periods, of lines that return, copies of a third of all rows, and two long ones."""
    draw = random.Random(5)
    line = "".join(draw.choice("abcdé ") for _ in range(260))
    texts = ["a" * n for n in (199, 200, 201, 450)] + ["ab" * 150, "abc" * 90 + "x", "a" * 200 + "b" + "a" * 199]
    texts += [line + str(i) + line for i in range(3)] + [line[:199], line[:200], line[5:250]] + [line] * 12
    long = "".join(draw.choice("xyz") for _ in range(30_000))
    texts += [long, "begin " + long[10_000:] + long[:300]]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)


def test_periods_and_hot_strings(repeats, monkeypatch):
    check(repeats)
    monkeypatch.setattr(suffix_dedup, "HELD", 500)
    check(repeats)


def test_heavy_digits_meet_twice(repeats, monkeypatch):
    """Every first digit is dealt over tasks by salt and meets again."""
    monkeypatch.setattr(suffix_dedup, "HEAVY", 1)
    monkeypatch.setattr(suffix_dedup, "HELD", 500)
    check(repeats)


def test_saturated_sketch_changes_nothing(odd, monkeypatch):
    monkeypatch.setattr(suffix_dedup.sketch, "width_for", lambda hashes: 8)
    check(odd, 80)


def test_texts_are_cut(odd, none):
    cut = dedup(odd, 67)
    assert cut.columns == [*odd.columns, "kept", "removed"]
    rows = pairs(odd)
    texts = brute([t for _, t in rows], 67)
    expected = sorted((str(d), bytes(np.frombuffer(b, np.uint8)[~gone])) for (d, _), (b, gone) in zip(rows, texts, strict=True))
    got = cut.collect()
    assert sorted((str(r["doc_id"]), bytes(r["kept"])) for r in got) == expected
    for r in got:
        body, kept, at = (r["text"] or "").encode(), b"", 0
        for first, end in r["removed"]:
            kept, at = kept + body[at:first], end
        assert kept + body[at:] == bytes(r["kept"])
    assert digest(none).count() == 0 and dedup(none).count() == 0


def test_refuses_sizes_that_have_no_first_digit(odd):
    for size in (63, 1 << 16):
        with pytest.raises(ValueError):
            digest(odd, size)


def test_chunks_change_no_run(monkeypatch):
    """Chunks cut runs but neither their grams nor which suffixes they hold."""
    draw = random.Random(8)
    bodies = ["".join(draw.choice("ab ") for _ in range(n)) for n in (0, 70, 66, 5000, 300)]
    raw = np.frombuffer("".join(bodies).encode(), np.uint8)
    starts = np.cumsum([0, *map(len, bodies)])

    def suffixes():
        return [
            (base + f + k, h, p - f - k)
            for base, *rest in suffix_dedup._chunks(raw, starts, 67)
            for f, n, p, h in zip(*(x.tolist() for x in rest), strict=True)
            for k in range(n)
        ]

    whole = suffixes()
    assert [s[0] for s in whole] == [p for a, b in zip(starts[:-1], starts[1:]) for p in range(a, b - 66)]
    monkeypatch.setattr(suffix_dedup, "CHUNK", 100)
    assert suffixes() == whole


@given(st.binary(max_size=60), st.integers(1, 20))
@settings(max_examples=200, deadline=None)
def test_groups_are_those_of_equal_strings(body, size):
    raw = np.frombuffer(body, np.uint8) % 3
    at = np.arange(max(len(raw) - size + 1, 0))
    item, group = equal_groups(raw, at, np.zeros(len(at), np.int64), size)
    found = collections.defaultdict(list)
    for i, g in zip(item.tolist(), group.tolist(), strict=True):
        found[g].append(i)
    places = collections.defaultdict(list)
    for p in at.tolist():
        places[raw[p : p + size].tobytes()].append(p)
    assert [sorted(x) for _, x in sorted(found.items())] == [x for _, x in sorted(places.items()) if len(x) > 1]


@pytest.mark.parametrize("size", [64, 67, 200])
def test_passes_of_digits_give_the_groups_of_equal_strings(size):
    rng = np.random.default_rng(size)
    word = rng.integers(97, 99, 400).astype(np.uint8)
    raw = np.concatenate([np.concatenate([word, rng.integers(97, 99, k).astype(np.uint8)]) for k in range(5, 40)])
    raw[rng.integers(0, len(raw), 30)] = 120
    at = rng.permutation(len(raw) - size)
    group = np.sort(rng.integers(0, 3, len(at)))
    item, which = equal_groups(raw, at, group, size)
    strings = {}
    for i, (a, g) in enumerate(zip(at.tolist(), group.tolist(), strict=True)):
        strings.setdefault((g, raw[a : a + size].tobytes()), []).append(i)
    wanted = [own for _, own in sorted(strings.items()) if len(own) > 1]
    assert len(wanted) > 100
    assert [own.tolist() for own in np.split(item, np.flatnonzero(np.diff(which)) + 1)] == wanted
