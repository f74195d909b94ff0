"""Words of a batch of texts as numpy arrays: the shared help of the operators.

A word is a maximal run of bytes other than ``\\x20`` and ``\\x09``-``\\x0D``. All functions work on
a whole Arrow batch at a time, without a Python object per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BATCH_BYTES = 4 << 20
"""Text that one step of a task works on at a time; a single longer text makes a step of its own."""

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_MIX_A = np.uint64(0xBF58476D1CE4E5B9)
_MIX_B = np.uint64(0x94D049BB133111EB)
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)


def pieces(
    batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = BATCH_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``limit`` bytes of text, small batches put together."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < len(sizes):
            before = int(total[start - 1]) if start else 0
            end = int(np.searchsorted(total, before + limit - size, side="right"))
            end = max(end, start + (not held))
            if end > start:
                held.append(batch.slice(start, end - start))
                size += int(total[end - 1]) - before
                start = end
            if start < len(sizes):
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts end to end, and where each text starts (one more at the end). Null is empty."""
    data = pc.fill_null(texts, "").cast(pa.large_string())
    if data.offset:
        data = pa.concat_arrays([data])
    offsets = np.frombuffer(data.buffers()[1], dtype=np.int64)[data.offset : data.offset + len(data) + 1]
    body = data.buffers()[2]
    raw = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """Where the words of some texts are, and what they hash to."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        raw, self.text_starts = text_bytes(texts)
        self.raw = LOWER[raw] if lower else raw
        space = _SPACE[raw]
        edge = np.ones(len(raw) + 1, dtype=bool)
        edge[1:] = space if len(raw) else True
        edge[self.text_starts] = True
        inside = ~space
        self.starts = np.flatnonzero(inside & edge[:-1])
        last = np.ones(len(raw), dtype=bool)
        if len(raw):
            last[:-1] = edge[1:-1] | space[1:]
            last[self.text_starts[1:][self.text_starts[1:] > 0] - 1] = True
        self.ends = np.flatnonzero(inside & last) + 1
        self.offsets = np.searchsorted(self.starts, self.text_starts)
        """Index of the first word of each text; one more at the end."""

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def owners(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word, the same in every task and run."""
        return span_hashes(self.raw, self.starts, self.ends, seed)

    def unique(self) -> tuple[np.ndarray, list[bytes]]:
        """For each word its number among the distinct ones, and those as bytes."""
        if not len(self):
            return np.zeros(0, np.int64), []
        _, first, number = np.unique(self.hashes(), return_index=True, return_inverse=True)
        return number, span_bytes(self.raw, self.starts[first], self.ends[first])


def span_bytes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
    body = raw.tobytes()
    return [body[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each span of bytes: eight bytes at a time, all spans at once."""
    lengths = ends - starts
    h = lengths.astype(np.uint64) * _GOLD + np.uint64(seed)
    if not len(raw):
        return h
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.as_strided(
        padded[:8].view(np.uint64), shape=(len(raw) + 1,), strides=(1,)
    )
    todo, at = np.flatnonzero(lengths > 0), 0
    while len(todo):
        left = lengths[todo] - at
        h[todo] = mixed(h[todo] ^ (eight[starts[todo] + at] & _MASKS[np.minimum(left, 8)]))
        at += 8
        todo = todo[left > 8]
    return h


def mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of the input reaches every bit of the result; different inputs stay different."""
    h = (h ^ (h >> np.uint64(30))) * _MIX_A
    h = (h ^ (h >> np.uint64(27))) * _MIX_B
    return h ^ (h >> np.uint64(31))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` hashes, over the ends of texts as well; callers mask those."""
    n = max(len(hashes) - size + 1, 0)
    h = np.full(n, size, dtype=np.uint64)
    for k in range(size):
        h = (h ^ hashes[k : k + n]) * _GOLD
        h ^= h >> np.uint64(32)
    return mixed(h)


def window_starts(offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First word of every window that lies in one text, and the row of that text."""
    counts = np.maximum(np.diff(offsets) - size + 1, 0)
    rows = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return offsets[:-1][rows] + within, rows
