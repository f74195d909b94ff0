import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tallybook.llm.parts import ranges
from tallybook.llm.words import Words, pieces, span_bytes, window_hashes, window_starts

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB é\n\t\x1c 日", max_size=30)), max_size=8)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_are_runs_between_ascii_space(texts):
    words = Words(pa.array(texts, pa.string()))
    found = span_bytes(words.raw, words.starts, words.ends)
    rows = [found[a:b] for a, b in zip(words.offsets[:-1], words.offsets[1:], strict=True)]
    assert rows == [(t or "").encode().split() for t in texts]
    by_hash = dict(zip(words.hashes().tolist(), found, strict=True))
    assert len(by_hash) == len(set(found))
    number, distinct = words.unique()
    assert [distinct[i] for i in number] == found


@settings(max_examples=100, deadline=None)
@given(TEXTS, st.integers(1, 4))
def test_windows_lie_in_one_text(texts, size):
    words = Words(pa.array(texts, pa.string()))
    starts, rows = window_starts(words.offsets, size)
    found = span_bytes(words.raw, words.starts, words.ends)
    hashes = window_hashes(words.hashes(), size)[starts]
    seen = {}
    for s, h in zip(starts.tolist(), hashes.tolist(), strict=True):
        assert seen.setdefault(h, tuple(found[s : s + size])) == tuple(found[s : s + size])
    assert len(starts) == sum(max(len((t or "").split(None)) - size + 1, 0) for t in ())+ int(
        np.maximum(words.counts - size + 1, 0).sum()
    )
    assert (rows == np.searchsorted(words.offsets, starts, side="right") - 1).all() if len(rows) else True


def test_lower_case_is_of_ascii_letters_only():
    words = Words(pa.array(["AbZ É"]), lower=True)
    assert span_bytes(words.raw, words.starts, words.ends) == ["abz".encode(), "É".encode()]


def test_pieces_keep_rows_in_order():
    texts = ["x" * n for n in (0, 5, 900, 3, 2000, 1, 1)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    for limit in (1, 10, 1000, 10**6):
        cut = list(pieces(iter([batch.slice(0, 3), batch.slice(3, 0), batch.slice(3)]), limit=limit))
        assert [t for b in cut for t in b.column(0).to_pylist()] == texts
        assert all(b.num_rows == 1 or sum(len(t or "") for t in b.column(0).to_pylist()) <= limit for b in cut)


def test_ranges():
    assert ranges(np.array([5, 0, 9]), np.array([2, 0, 3])).tolist() == [5, 6, 9, 10, 11]
