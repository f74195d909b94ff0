"""Removal of word runs that an earlier document holds as well.

A window is ``size`` words in a row of one document. Every word covered by a window whose words
also stand in a document with a smaller ``doc_id`` is removed; windows are judged on the input.

1. A count-min sketch of all windows is merged from the tasks' sketches (see ``sketch``).
2. A second pass takes only windows whose estimate is two or more, which no repeated window can
   miss. A task first settles them among its own documents, keeping of each window those places
   that belong to its least ``doc_id``; the rest meet in blocks by hash, where each window is
   grouped exactly. So a window of a third of all documents comes to its block once per task.
3. The places found go in packed buckets by ``doc_id`` to where the documents of that bucket go too,
   and the documents are cut and returned.

Defined results: a null text has no words; texts shorter than a window lose nothing; a null
``doc_id`` counts as larger than any other; rows that share a ``doc_id`` never remove each other's
words, and each is cut by its own words; an empty table gives an empty result. Windows are compared
by a 64-bit hash of their words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.llm import sketch
from tallybook.llm.parts import ranges
from tallybook.llm.words import Words, pieces, text_bytes, window_hashes, window_starts

WINDOW = 13
HELD = 1_000_000
"""Candidate windows that a task settles at a time."""
_LAST = 2**63 - 1
_PLACE = np.uint64(40)


def _windows(texts: pa.Array, size: int) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """The words; hash, row and first word (in the row) of every window."""
    words = Words(texts)
    starts, rows = window_starts(words.offsets, size)
    return words, window_hashes(words.hashes(), size)[starts], rows, starts - words.offsets[rows]


def _tags(texts: pa.Array) -> np.ndarray:
    """24 bits of each text, to tell rows that share a ``doc_id``."""
    raw, at = text_bytes(texts)
    body = raw.tobytes()
    pairs = zip(at[:-1].tolist(), at[1:].tolist(), strict=True)
    found = (int.from_bytes(hashlib.blake2b(body[a:b], digest_size=3).digest()) for a, b in pairs)
    return np.fromiter(found, np.uint64, len(at) - 1)


_MARKS = "block int, kind int, size int, hashes binary, docs binary, places binary"


def _packed(values: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(values), codec="zstd", asbytes=True)


def _marks(rows: list[tuple[int, np.ndarray | None, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Rows of block, hashes, documents and places; without hashes the places are settled (kind 1)."""
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r[0] for r in rows], pa.int32()),
            pa.array([int(r[1] is None) for r in rows], pa.int32()),
            pa.array([len(r[2]) for r in rows], pa.int32()),
            pa.array([None if r[1] is None else _packed(r[1]) for r in rows], pa.binary()),
            pa.array([_packed(r[2]) for r in rows], pa.binary()),
            pa.array([_packed(r[3]) for r in rows], pa.binary()),
        ],
        ["block", "kind", "size", "hashes", "docs", "places"],
    )


def _unpacked(data: bytes, n: int, kind: str) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, 8 * n, codec="zstd"), kind)


def _settled(hashes: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by hash and document; which of the ordered are in a later document than the first."""
    order = np.lexsort((docs, hashes))
    h, d = hashes[order], docs[order]
    first = np.flatnonzero(np.concatenate([[len(h) > 0], h[1:] != h[:-1]]))
    least = np.repeat(d[first], np.diff(np.concatenate([first, [len(h)]])))
    return order, d > least


def _key() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))


def repeated_places(docs: DataFrame, size: int, expected: int, buckets: int) -> DataFrame:
    """First words of the windows to remove, packed: rows of ``bucket, size, docs, places``."""
    spark = docs.sparkSession
    rows = docs.select(_key().alias("doc_id"), "text")
    blocks = max(8, expected >> 20)

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in pieces(batches):
            yield _windows(batch.column("text"), size)[1]

    counts = spark.sparkContext.broadcast(sketch.build(rows.select("text"), hashes, expected))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        n = 0

        def settle() -> pa.RecordBatch:
            h, d, p = (np.concatenate(x) for x in zip(*held, strict=True))
            order, later = _settled(h, d)
            h, d, p = h[order], d[order], p[order]
            out = [(int(h[0] % np.uint64(blocks)), None, d[later], p[later])]
            h, d, p = h[~later], d[~later], p[~later]
            block = (h >> np.uint64(20)) % np.uint64(blocks)
            order = np.argsort(block, kind="stable")
            edges = np.searchsorted(block[order], np.arange(blocks + 1))
            for b in np.flatnonzero(np.diff(edges)).tolist():
                own = order[edges[b] : edges[b + 1]]
                out.append((b, h[own], d[own], p[own]))
            return _marks(out)

        for batch in pieces(batches):
            _, found, rows_of, first = _windows(batch.column("text"), size)
            hit = counts.value.repeated(found)
            tags = _tags(batch.column("text"))
            ids = batch.column("doc_id").to_numpy()
            place = (tags[rows_of[hit]] << _PLACE) | first[hit].astype(np.uint64)
            held.append((found[hit], ids[rows_of[hit]], place))
            n += int(hit.sum())
            if n >= HELD:
                yield settle()
                held, n = [], 0
        if n:
            yield settle()

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple[np.ndarray, np.ndarray]] = []
        n_done = 0

        def by_bucket() -> pa.RecordBatch:
            d, p = (np.concatenate(x) for x in zip(*done, strict=True))
            bucket = d % buckets
            order = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
            filled = np.flatnonzero(np.diff(edges))
            parts = [order[edges[b] : edges[b + 1]] for b in filled.tolist()]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(filled, pa.int32()),
                    pa.array([len(x) for x in parts], pa.int32()),
                    pa.array([_packed(d[x]) for x in parts], pa.binary()),
                    pa.array([_packed(p[x]) for x in parts], pa.binary()),
                ],
                ["bucket", "size", "docs", "places"],
            )

        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        current = -1

        def exact() -> None:
            nonlocal n_done
            if held:
                h, d, p = (np.concatenate(x) for x in zip(*held, strict=True))
                order, later = _settled(h, d)
                done.append((d[order][later], p[order][later]))
                n_done += int(later.sum())
            held.clear()

        for batch in batches:
            for block, kind, n, h, d, p in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if block != current:
                    exact()
                    current = block
                if kind:
                    done.append((_unpacked(d, n, "<i8"), _unpacked(p, n, "<u8")))
                    n_done += n
                else:
                    held.append((_unpacked(h, n, "<u8"), _unpacked(d, n, "<i8"), _unpacked(p, n, "<u8")))
                if n_done >= HELD:
                    yield by_bucket()
                    done.clear()
                    n_done = 0
        exact()
        if done:
            yield by_bucket()

    return (
        rows.mapInArrow(candidates, _MARKS)
        .repartition("block")
        .sortWithinPartitions("block")
        .mapInArrow(group, "bucket int, size int, docs binary, places binary")
    )


def _cut(words: Words, docs: np.ndarray, tags: np.ndarray, marks: tuple[np.ndarray, np.ndarray], size: int) -> np.ndarray:
    """Which words go. ``marks`` are documents and places of one bucket, ordered by document."""
    change = np.zeros(len(words) + 1, np.int64)
    marked, places = marks
    first, last = (np.searchsorted(marked, docs, side=side) for side in ("left", "right"))
    for row in np.flatnonzero(last > first).tolist():
        at = places[first[row] : last[row]]
        at = np.unique(at[(at >> _PLACE) == tags[row]] & np.uint64((1 << 40) - 1))
        start = at.astype(np.int64) + words.offsets[row]
        change[start] += 1
        change[start + size] -= 1
    return np.cumsum(change[:-1]) > 0


def _kept(words: Words, gone: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The kept words of all texts with one space after each, and where each text starts."""
    keep = ~gone
    lengths = words.ends[keep] - words.starts[keep] + 1
    upto = np.concatenate([[0], np.cumsum(lengths)])
    padded = np.concatenate([words.raw, [np.uint8(0x20)]])
    body = padded[ranges(words.starts[keep], lengths)]
    body[upto[1:] - 1] = 0x20
    kept_before = np.concatenate([[0], np.cumsum(keep)])[words.offsets]
    return body.tobytes(), upto[kept_before]


Finish = Callable[[pa.RecordBatch, Words, np.ndarray], pa.RecordBatch]


def _cut_all(docs: DataFrame, size: int, finish: Finish, schema: T.StructType) -> DataFrame:
    """Every row of ``docs`` through ``finish`` with its words and which of them go."""
    names = docs.columns
    expected = sketch.expected_words(docs)
    buckets = max(8, expected >> 20) | 1
    marks = repeated_places(docs, size, expected, buckets)
    other = [docs[c].alias(f"c{i}") for i, c in enumerate(names) if c != "text"]
    rows = docs.select(
        F.pmod(_key(), F.lit(buckets)).cast("int").alias("bucket"),
        F.lit(1).alias("kind"),
        F.lit(0).alias("size"),
        F.lit(None).cast("binary").alias("docs"),
        F.lit(None).cast("binary").alias("places"),
        _key().alias("key"),
        F.col("text"),
        F.struct(*other).alias("other"),
    )
    both = rows.unionByName(marks.withColumn("kind", F.lit(0)), allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = -1, []
        ready: tuple[np.ndarray, np.ndarray] = (np.zeros(0, np.int64), np.zeros(0, np.uint64))
        for batch in pieces(batches):
            buckets_of = batch.column("bucket").to_numpy()
            kinds = batch.column("kind").to_numpy()
            change = np.flatnonzero(np.diff(buckets_of) | np.diff(kinds)) + 1
            edges = [0, *change.tolist(), batch.num_rows]
            for first, last in zip(edges[:-1], edges[1:], strict=True):
                part = batch.slice(first, last - first)
                if buckets_of[first] != current:
                    current, held = buckets_of[first], []
                    ready = (ready[0][:0], ready[1][:0])
                if kinds[first] == 0:
                    for n, d, p in zip(*(part.column(c).to_pylist() for c in ("size", "docs", "places")), strict=True):
                        held.append((_unpacked(d, n, "<i8"), _unpacked(p, n, "<u8")))
                    continue
                if held:
                    d, p = (np.concatenate(x) for x in zip(*held, strict=True))
                    order = np.argsort(d, kind="stable")
                    ready, held = (d[order], p[order]), []
                texts = part.column("text")
                words = Words(texts)
                gone = _cut(words, part.column("key").to_numpy(), _tags(texts), ready, size)
                flat = iter(part.column("other").flatten())
                columns = [texts if c == "text" else next(flat) for c in names]
                yield finish(pa.RecordBatch.from_arrays(columns, names), words, gone)

    dealt = both.repartition("bucket").sortWithinPartitions("bucket", "kind")
    return dealt.mapInArrow(run, schema)


def _per_text(words: Words, gone: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(gone)])[words.offsets])


def digest(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept_sha256`` (kept words joined by one space)."""

    def finish(batch: pa.RecordBatch, words: Words, gone: np.ndarray) -> pa.RecordBatch:
        body, at = _kept(words, gone)
        sha = [
            hashlib.sha256(body[a : max(b - 1, a)]).hexdigest()
            for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)
        ]
        ids = batch.column("doc_id").cast(pa.int64())
        columns = [ids, pa.array(words.counts), pa.array(_per_text(words, gone)), pa.array(sha)]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept_sha256"])

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return _cut_all(docs.select("doc_id", "text"), size, finish, schema)


def dedup(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` with repeated runs taken out of ``text``, and ``n_removed_words`` (long) beside it.

    A text that loses words becomes its kept words joined by one space; others stay as they are.
    All columns are kept; ``n_removed_words`` replaces a column of that name.
    """
    docs = docs.drop("n_removed_words")
    schema = T.StructType([*docs.schema.fields, T.StructField("n_removed_words", T.LongType())])
    at_text = docs.columns.index("text")

    def finish(batch: pa.RecordBatch, words: Words, gone: np.ndarray) -> pa.RecordBatch:
        body, at = _kept(words, gone)
        removed = _per_text(words, gone)
        texts = batch.column("text").to_pylist()
        for row in np.flatnonzero(removed).tolist():
            texts[row] = body[at[row] : max(at[row + 1] - 1, at[row])].decode("utf-8")
        columns = batch.columns
        columns[at_text] = pa.array(texts, pa.string())
        return pa.RecordBatch.from_arrays([*columns, pa.array(removed)], schema.names)

    return _cut_all(docs, size, finish, schema)
