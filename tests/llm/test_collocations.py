import collections
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallybook.llm import collocations
from tallybook.llm.collocations import Trie, best

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=10, most=2_000):
    """``rows`` are texts and languages."""
    f = collections.Counter()
    for text, lang in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOW)):
            words = re.findall("[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    f["und" if lang is None else lang, tuple(words[i : i + k])] += 1
    n = collections.Counter()
    for (lang, words), count in f.items():
        n[lang] += count if len(words) == 1 else 0
    chosen = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    found = collections.defaultdict(list)
    for (lang, words), a in chosen.items():
        longer = [b for (o, w), b in chosen.items() if o == lang and len(w) == 3 > len(words) and words in (w[:2], w[1:])]
        if any(100 * b >= 50 * a for b in longer):
            continue
        cuts = [(f[lang, words[:k]], f[lang, words[k:]]) for k in range(1, len(words))]
        score, _, (left, right) = min((1_000_000 * a * a // (x * y), k, (x, y)) for k, (x, y) in enumerate(cuts))
        found[lang].append((-score, -a, " ".join(words).encode(), left, right))
    return sorted(
        (lang, i + 1, phrase.decode(), -a, left, right, n[lang], -score)
        for lang, rows in found.items()
        for i, (score, a, phrase, left, right) in enumerate(sorted(rows)[:most])
    )


def pairs(df):
    return [(r["text"], r["lang"]) for r in df.select("text", "lang").collect()]


@pytest.fixture(scope="module")
def phrases(spark):
    """Overlapping runs of one word, pieces that end between words, ties, two names of one language."""
    texts = [
        ("New York City. New York!", "en"),
        ("new york city; NEW\tYORK  city", "en"),
        ("ha ha ha ha ha", "en"),
        ("a b c", None),
        ("a b c", "und"),
        ("ünder der — Brücke", "de"),
        ("x. y\nx, y\x0bx y", "de"),
        ("x y", "en"),
        (None, "en"),
        ("", None),
        ("one", "en"),
    ]
    rows = [(i, *texts[i % len(texts)]) for i in range(len(texts) * 11)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)


def check(df, **options):
    want = brute(pairs(df), options.get("least", 10), options.get("most", 2_000))
    assert want and sorted(map(tuple, best(df, **options).collect())) == want


def test_phrases(phrases):
    check(phrases)
    check(phrases, most=3)


def test_candidates_beyond_the_trie_are_added_up(phrases):
    check(phrases, most_in_trie=3)
    check(phrases, most_in_trie=0)


def test_odd_texts(odd, none):
    check(odd, least=2)
    assert best(none).count() == 0
    assert best(odd.withColumn("text", odd["text"].substr(1, 0))).count() == 0


def test_saturated_sketch_changes_nothing(phrases, monkeypatch):
    monkeypatch.setattr(collocations.sketch, "width_for", lambda hashes: 4)
    check(phrases)


def test_scores_pass_64_bits(spark):
    """Exact where a product has over 64 bits."""
    rows = [(3_000_000_000_001, 3_000_000_000_007, 3_000_000_000_011), (10**13, 10**13, 10**13)]
    df = spark.createDataFrame(rows, "a long, l long, r long")
    got = [r[0] for r in df.select(collocations._score("a", "l", "r")).collect()]
    assert got == [1_000_000 * a * a // (x * y) for a, x, y in rows]


@given(
    st.lists(st.tuples(st.integers(0, 40), st.integers(0, 40)), max_size=60),
    st.lists(st.tuples(st.integers(0, 40), st.integers(0, 40), st.integers(0, 40)), max_size=60),
    st.lists(st.integers(0, 45), min_size=3, max_size=80),
)
@settings(max_examples=200, deadline=None)
def test_trie_accepts_its_phrases_alone(pairs, triples, text):
    pairs, triples = sorted(set(pairs)), sorted(set(triples))
    if not pairs and not triples:
        return
    spread = np.uint64(0x9E3779B97F4A7C15)
    trie = Trie([np.array(x, np.uint64).reshape(-1, k) * spread for x, k in ((pairs, 2), (triples, 3))])
    known = pairs + triples
    assert len(set(trie.accepting.tolist())) == len(set(known)) == len(trie.accepting)
    numbers = trie.numbers(np.array(text, np.uint64) * spread)
    state = trie.first(numbers)
    for words in (2, 3):
        numbers_after = np.concatenate([numbers[words - 1 :], np.full(words, -1)])[: len(numbers)]
        state = trie.step(state, numbers_after)
        accepted = dict(zip(trie.accepting.tolist(), known, strict=True))
        for i, s in enumerate(state.tolist()):
            phrase = tuple(text[i : i + words])
            assert (accepted.get(s) == phrase) == (len(phrase) == words and phrase in set(known))
