"""Token ids of many short parts of texts, each distinct part encoded once per worker.

Tokenizers that treat the parts of a text apart from each other give the same ids for a part
wherever it stands. A cache of bounded size holds the ids of the parts met so far.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable

import numpy as np
import pyarrow as pa

from tallybook.llm.words import span_bytes, span_hashes

CACHED_PARTS = 1_000_000
"""Distinct parts a worker remembers (about 45 MB); beyond it the cache starts anew."""


class PartIds:
    """``encode`` turns a list of parts into their lists of ids, or into all ids end to end and the lengths."""

    def __init__(
        self,
        encode: Callable[[list[bytes]], list[list[int]] | tuple[np.ndarray, np.ndarray]],
        limit: int = CACHED_PARTS,
    ):
        self.encode, self.limit = encode, limit
        self._clear()

    def _clear(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _learn(self, hashes: np.ndarray, parts: list[bytes]) -> None:
        if len(self.hashes) + len(hashes) > self.limit:
            self._clear()
        found = self.encode(parts)
        if isinstance(found, tuple):
            flat, lengths = found
        else:
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.fromiter(itertools.chain.from_iterable(found), np.uint32, int(lengths.sum()))
        starts = len(self.flat) + np.cumsum(lengths) - lengths
        self.flat = np.concatenate([self.flat, flat])
        at = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, at, hashes)
        self.starts = np.insert(self.starts, at, starts)
        self.lengths = np.insert(self.lengths, at, lengths)

    def ids(
        self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all the given spans of ``raw`` in order, and how many each has."""
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        coded = pa.array(span_hashes(raw, starts, ends)).dictionary_encode()  # numbered as they are met
        met, place = coded.dictionary.to_numpy(), coded.indices.to_numpy()
        seen = np.empty(len(met), np.int64)
        seen[place[::-1]] = np.arange(len(place) - 1, -1, -1)
        order = np.argsort(met)
        distinct, first = met[order], seen[order]
        at = np.searchsorted(self.hashes, distinct)
        new = np.ones(len(distinct), dtype=bool)
        known = at < len(self.hashes)
        new[known] = self.hashes[at[known]] != distinct[known]
        if len(self.hashes) + int(new.sum()) > self.limit:
            self._clear()
            new[:] = True
        if new.any():
            self._learn(distinct[new], span_bytes(raw, starts[first[new]], ends[first[new]]))
        at = np.empty(len(met), np.int64)
        at[order] = np.searchsorted(self.hashes, distinct)
        at = at[place]
        lengths = self.lengths[at]
        return self.flat[ranges(self.starts[at], lengths)], lengths


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers ``starts[i] .. starts[i] + lengths[i] - 1`` for all i, end to end."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))
