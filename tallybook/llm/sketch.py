"""A count-min sketch of 64-bit hashes over a whole table, built and merged in blocks.

Every task counts its hashes and sends, per row of the sketch and block of its cells, the cells it
has met (sorted, as gaps) and how often. A block is merged in one task of fixed size, whatever the
table; what comes back is one bit per cell, "met at least twice", and the cells met very often.
An estimate is never too low, so a hash met twice is always found; one met once is taken for
repeated where its cell is shared in every row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.words import mixed

DEPTH = 2
BLOCK_BITS = 23
MOST_WIDTH_BITS = 29
"""At most 2^29 cells a row: 64 MB of bits for each row in a task, the bound of what is broadcast.
Beyond about 10^9 hashes more and more are taken for repeated; callers check those exactly, so
results stay the same and only the second pass has more to do."""
FLUSH = 2_000_000
"""Hashes that a task counts before it sends them."""
HEAVY_CELLS = 1 << 20
_SEEDS = (np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9FB21C651E98DF25), np.uint64(0x6C8E944D1F2A3B57))


def width_for(hashes: int) -> int:
    """Bits of the number of cells a row: four cells for each hash expected, within the bounds."""
    return int(min(max(np.ceil(np.log2(max(hashes, 1) * 4)), 16), MOST_WIDTH_BITS))


def expected_words(docs: DataFrame) -> int:
    """About how many words the texts have, from their bytes."""
    return int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 6


def _cells(hashes: np.ndarray, row: int, width: int) -> np.ndarray:
    return (mixed(hashes + _SEEDS[row]) >> np.uint64(64 - width)).astype(np.uint32)


def _gaps(cells: np.ndarray) -> tuple[int, bytes]:
    """Sorted cells as 16-bit gaps, and how many; a gap of 65,535 only moves on."""
    gap = np.diff(cells.astype(np.int64), prepend=0)
    far = gap // 65535
    wide = np.full(len(gap) + int(far.sum()), 65535, np.uint16)
    wide[np.arange(len(gap)) + np.cumsum(far)] = gap - far * 65535
    return len(wide), pa.compress(wide, codec="zstd", asbytes=True)


def _from_gaps(data: bytes | pa.Buffer, size: int) -> np.ndarray:
    gap = np.frombuffer(pa.decompress(data, 2 * size, codec="zstd"), np.uint16).astype(np.int64)
    at = np.cumsum(gap)
    return at[gap != 65535]


SENT = "key int, size int, cells binary, repeats binary"


class Counter:
    """Counts hashes in one task; gives rows of ``SENT``."""

    def __init__(self, width: int, depth: int):
        self.width, self.depth, self.held, self.size = width, depth, [], 0

    def add(self, hashes: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append(hashes)
        self.size += len(hashes)
        if self.size >= FLUSH:
            yield self.flush()

    def flush(self) -> pa.RecordBatch:
        hashes = np.concatenate(self.held) if self.held else np.zeros(0, np.uint64)
        self.held, self.size = [], 0
        out: list[tuple[int, int, bytes, bytes]] = []
        blocks = 1 << max(self.width - BLOCK_BITS, 0)
        for row in range(self.depth):
            cells = np.sort(_cells(hashes, row, self.width))
            first = np.flatnonzero(np.concatenate([[len(cells) > 0], cells[1:] != cells[:-1]]))
            counts = np.diff(np.concatenate([first, [len(cells)]]))
            cells = cells[first]
            edges = np.searchsorted(cells >> np.uint32(BLOCK_BITS), np.arange(blocks + 1))
            for block in np.flatnonzero(np.diff(edges)).tolist():
                own = slice(edges[block], edges[block + 1])
                size, gaps = _gaps(cells[own] & np.uint32((1 << BLOCK_BITS) - 1))
                more = np.flatnonzero(counts[own] > 1)
                repeats = np.stack([more, counts[own][more] - 1]).astype("<u4").tobytes()
                out.append((row * blocks + block, size, gaps, repeats))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([x[0] for x in out], pa.int32()),
                pa.array([x[1] for x in out], pa.int32()),
                pa.array([x[2] for x in out], pa.binary()),
                pa.array([x[3] for x in out], pa.binary()),
            ],
            ["key", "size", "cells", "repeats"],
        )


class Sketch:
    """The merged sketch, as broadcast: packed bits by row, and the heavy cells of the first row."""

    def __init__(
        self, width: int, depth: int, bits: dict[int, bytes], heavy: np.ndarray, counts: np.ndarray
    ):
        self.width, self.depth, self.bits = width, depth, bits
        self.heavy, self.counts = heavy, counts
        self._rows: list[np.ndarray] | None = None

    def __getstate__(self):
        return {**self.__dict__, "_rows": None if self.bits else self._rows}

    def rows(self) -> list[np.ndarray]:
        """The bits of each row, unpacked once; the packed ones, which would double them in every worker, go."""
        if self._rows is None:
            blocks = 1 << max(self.width - BLOCK_BITS, 0)
            size = 1 << (min(self.width, BLOCK_BITS) - 3)
            self._rows = []
            for row in range(self.depth):
                whole = np.zeros(blocks * size, np.uint8)
                for block in range(blocks):
                    if (data := self.bits.pop(row * blocks + block, None)) is not None:
                        part = np.frombuffer(pa.decompress(data, size, codec="zstd"), np.uint8)
                        whole[block * size : (block + 1) * size] = part
                self._rows.append(whole)
        return self._rows

    def repeated(self, hashes: np.ndarray) -> np.ndarray:
        """Whether each hash may have been met twice or more."""
        found = np.ones(len(hashes), dtype=bool)
        at = np.arange(len(hashes))
        for row, bits in enumerate(self.rows()):
            cells = _cells(hashes[at], row, self.width)
            hit = (bits[cells >> np.uint32(3)] >> (cells & np.uint32(7)).astype(np.uint8)) & 1 > 0
            found[at[~hit]] = False
            at = at[hit]
        return found

    def level(self, hashes: np.ndarray) -> np.ndarray:
        """log2 of how often a hash was met, by the first row, where that is often; else 0."""
        if not len(self.heavy):
            return np.zeros(len(hashes), np.uint64)
        cells = _cells(hashes, 0, self.width)
        at = np.minimum(np.searchsorted(self.heavy, cells), len(self.heavy) - 1)
        found = np.log2(self.counts[at].astype(np.float64) + 1).astype(np.uint64)
        return np.where(self.heavy[at] == cells, np.minimum(found, np.uint64(15)), np.uint64(0))


def build(
    docs: DataFrame,
    hashes: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]],
    expected: int,
    depth: int = DEPTH,
    heavy_from: int | None = None,
    least: int = 2,
    most_heavy: int | None = None,
) -> Sketch:
    """The sketch of all hashes that ``hashes`` gives for the batches of ``docs``.

    ``heavy_from`` is the count from which a cell of the first row counts as heavy; by default so
    high that there are at most about ``HEAVY_CELLS`` of them; ``most_heavy`` bounds them by block
    instead, the most frequent staying, for callers who only order by them. With ``least`` 1 the bits say which
    hashes were met at all.
    """
    width = width_for(expected)
    blocks = 1 << max(width - BLOCK_BITS, 0)
    heavy_from = heavy_from or max(64, expected // HEAVY_CELLS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(width, depth)
        for found in hashes(batches):
            yield from counter.add(found)
        yield counter.flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << min(width, BLOCK_BITS), np.uint32)
        current = -1

        def done() -> pa.RecordBatch:
            bits = np.packbits(cells >= least, bitorder="little")
            heavy = np.flatnonzero(cells >= heavy_from) if current < blocks else np.zeros(0, np.int64)
            if most_heavy is not None and len(heavy) > most_heavy:
                heavy = np.sort(heavy[np.argsort(-cells[heavy].astype(np.int64), kind="stable")[:most_heavy]])
            whole = heavy + ((current % blocks) << BLOCK_BITS)
            row = [
                pa.array([current], pa.int32()),
                pa.array([pa.compress(bits, codec="zstd", asbytes=True)], pa.binary()),
                pa.array([whole.astype("<u4").tobytes()], pa.binary()),
                pa.array([cells[heavy].astype("<u4").tobytes()], pa.binary()),
            ]
            cells[:] = 0
            return pa.RecordBatch.from_arrays(row, ["key", "bits", "heavy", "counts"])

        for batch in batches:
            keys, sizes, gaps, repeats = batch.columns
            for i, (key, size) in enumerate(zip(keys.to_pylist(), sizes.to_pylist(), strict=True)):
                if key != current:
                    if current >= 0:
                        yield done()
                    current = key
                at = _from_gaps(gaps[i].as_buffer(), size)
                cells[at] += 1
                where, more = np.frombuffer(repeats[i].as_buffer(), "<u4").reshape(2, -1)
                cells[at[where]] += more
        if current >= 0:
            yield done()

    merged = (
        docs.mapInArrow(count, SENT)
        .repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(merge, "key int, bits binary, heavy binary, counts binary")
        .collect()
    )
    merged.sort(key=lambda r: r["key"])
    join = lambda name: np.frombuffer(b"".join(r[name] for r in merged), "<u4")
    return Sketch(width, depth, {r["key"]: bytes(r["bits"]) for r in merged}, join("heavy"), join("counts"))
