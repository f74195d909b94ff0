"""Removal of byte strings of ``size`` bytes that also start anywhere else.

The suffixes of all texts are put in order through their first ``size`` bytes only, by passes of most
significant digits; suffixes that are still in one group then are the repeated strings.

1. The first digit deals the suffixes over the cluster: the least (by hash) of the ``GRAM``-byte
   strings in the first ``size`` bytes, and how far in it stands. Suffixes with equal beginnings have
   it in common, and neighbours mostly share one, so it is kept once for a run of suffixes, with the
   run's bytes. A merged count-min sketch says which first digits may stand twice; the others' suffixes
   are alone in their group and go no further. The sketch never counts too little, so none is lost.
2. The next digits are eight bytes each. A pass looks at a digit of every suffix that is not alone
   yet, and orders anew only the groups whose members differ in it.
3. Every task orders the suffixes of some megabytes of its own first; of each group one stays. These
   meet by first digit. Digits met often are dealt over several tasks and meet once more after that, so
   a passage of a third of all documents comes to no task more often than about the square root of the
   number of batches.
4. The places found go in packed buckets of rows to where the documents of that bucket go too, and the
   documents are cut.

Defined results: a null text has no bytes; texts shorter than ``size`` lose nothing; strings never
reach over the end of a text; repeated rows are elsewhere for each other, whatever their ``doc_id``; a
null ``doc_id`` stays null; an empty table gives an empty result. Groups are compared by their bytes,
not by hashes.
"""

from __future__ import annotations

import dataclasses
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.llm import sketch
from tallybook.llm.parts import ranges
from tallybook.llm.words import mixed, pieces, text_bytes

SIZE = 200
GRAM = 32
CHUNK = 1 << 18
"""Suffixes whose first digits are found at a time, so that the arrays stay in the processor's cache."""
HELD = 2_000_000
"""Suffixes that a task orders at a time (of one first digit all, however many)."""
HEAVY = 64
"""From this many runs on a first digit is dealt over several tasks."""
BLOCK_BYTES = 8 << 20
"""Text for each block of first digits, about."""
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_PLACE_BITS = np.uint64(20)


def _digits(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as they stand in memory; zeros after the end."""
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    return np.lib.stride_tricks.as_strided(padded[:8].view(np.uint64), (len(raw) + 1,), (1,))


def _gram_hashes(raw: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``GRAM`` bytes from each place on."""
    n = len(raw) - GRAM + 1
    eight = np.ascontiguousarray(_digits(raw))
    h = eight[:n] * _GOLD
    for at in range(8, GRAM, 8):
        h ^= h >> np.uint64(32)
        h ^= eight[at : at + n]
        h *= _GOLD
    return mixed(h)


def _least_gram(hashes: np.ndarray, span: int) -> np.ndarray:
    """For each place the first of the least hashes among the ``span`` from there on."""
    low = (np.uint64(1) << _PLACE_BITS) - np.uint64(1)
    least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    n, done = len(hashes) - span + 1, 1
    while 2 * done <= span:
        least = np.minimum(least[:-done], least[done:])
        done *= 2
    if done < span:
        least = np.minimum(least[:n], least[span - done :][:n])
    return (least & low).astype(np.int64)


@dataclasses.dataclass(frozen=True)
class Runs:
    """Runs of neighbouring suffixes that share their least gram, and the bytes that they need.

    ``ahead`` says how far the gram stands from the run's first suffix, ``places`` where that one is
    in its text, ``starts`` where it is in ``raw``; ``tags`` and ``docs`` name the row.
    """

    grams: np.ndarray
    tags: np.ndarray
    docs: np.ndarray
    places: np.ndarray
    counts: np.ndarray
    ahead: np.ndarray
    starts: np.ndarray
    raw: np.ndarray

    def __len__(self) -> int:
        return len(self.grams)

    def rows(self, at: np.ndarray) -> Runs:
        """Some of the runs, with the same bytes."""
        return Runs(*(getattr(self, f.name)[at] for f in dataclasses.fields(self)[:-1]), self.raw)

    def part(self, run: np.ndarray, skip: np.ndarray, counts: np.ndarray, size: int) -> Runs:
        """Of each run named, ``counts`` suffixes after the first ``skip``, with bytes of their own."""
        lengths = counts + size - 1
        body = self.raw[ranges(self.starts[run] + skip, lengths)]
        return Runs(
            self.grams[run],
            self.tags[run],
            self.docs[run],
            self.places[run] + skip,
            counts,
            self.ahead[run] - skip,
            np.cumsum(lengths) - lengths,
            body,
        )


def joined(found: list[Runs]) -> Runs:
    shift = np.cumsum([0, *(len(r.raw) for r in found[:-1])])
    moved = [dataclasses.replace(r, starts=r.starts + s) for r, s in zip(found, shift, strict=True)]
    return Runs(*(np.concatenate([getattr(r, f.name) for r in moved]) for f in dataclasses.fields(Runs)))


def _chunks(raw: np.ndarray, starts: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """By chunk of all texts: its offset, then of each run the first suffix, their number, gram place and hash."""
    ends_short = np.diff(starts) < size
    if ends_short.all():
        return
    for base in range(0, max(len(raw) - size + 1, 0), CHUNK):
        part = raw[base : base + CHUNK + size - 1]
        n = len(part) - size + 1
        inside = np.searchsorted(starts, base + n, side="left")
        own = starts[1 : inside + 1]
        bad = np.zeros(n + 1, np.int32)
        first = np.maximum(np.maximum(own - size + 1, starts[: len(own)]) - base, 0)
        last = np.clip(own - base, 0, n)
        full = first < last
        np.add.at(bad, first[full], 1)
        np.add.at(bad, last[full], -1)
        valid = np.flatnonzero(np.cumsum(bad[:-1]) == 0)
        if not len(valid):
            continue
        hashes = _gram_hashes(part)
        place = _least_gram(hashes, size - GRAM + 1)[valid]
        edge = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        counts = np.diff(np.concatenate([edge, [len(valid)]]))
        yield base, valid[edge], counts, place[edge], hashes[place[edge]]


def _candidates(batch: pa.RecordBatch, size: int, met: sketch.Sketch) -> Iterator[Runs]:
    """The runs whose gram may stand twice; neighbours share their bytes."""
    raw, starts = text_bytes(batch.column("text"))
    tags, docs = batch.column("tag").to_numpy(), batch.column("doc_id").to_numpy()
    for base, first, counts, place, hashes in _chunks(raw, starts, size):
        hit = np.flatnonzero(met.repeated(hashes))
        if not len(hit):
            continue
        first, counts, place, hashes = first[hit], counts[hit], place[hit], hashes[hit]
        upto = np.maximum.accumulate(first + counts + size - 1)
        fresh = np.concatenate([[True], first[1:] > upto[:-1]])
        segment = np.cumsum(fresh) - 1
        begin = first[fresh]
        end = upto[np.concatenate([np.flatnonzero(fresh)[1:] - 1, [len(first) - 1]])]
        before = np.cumsum(end - begin) - (end - begin)
        row = np.searchsorted(starts, first + base, side="right") - 1
        yield Runs(
            hashes,
            tags[row],
            docs[row],
            first + base - starts[row],
            counts,
            place - first,
            before[segment] + first - begin[segment],
            raw[ranges(begin + base, end - begin)],
        )


def equal_groups(raw: np.ndarray, at: np.ndarray, group: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of the suffixes share their first ``size`` bytes with another of their group, and a number for each such set.

    ``at`` are places in ``raw``, ``group`` ascending numbers of the groups made so far. The result is
    ordered by the new groups, and by place within them where ``at`` was.
    """
    eight = _digits(raw)
    item, place = np.arange(len(at)), at.copy()
    edge = np.concatenate([[True], group[1:] != group[:-1]])[: len(at)]

    def alone() -> np.ndarray:
        return edge & np.concatenate([edge[1:], [True]])[: len(edge)]

    for depth in range(0, size, 8):
        single = alone()
        if 8 * np.count_nonzero(single) > len(item):  # few of them may stay: they differ from none of their group
            item, place, edge = item[~single], place[~single], edge[~single]
        if not len(item):
            break
        digit = eight[depth:][place]
        if size - depth < 8:
            digit <<= np.uint64(8 * (8 - size + depth))
        differs = np.flatnonzero((digit[1:] != digit[:-1]) & ~edge[1:])
        if not len(differs):
            continue
        head = np.append(np.flatnonzero(edge), len(item))
        mixed_up = (np.cumsum(edge, dtype=np.int32) - 1)[differs]
        mixed_up = mixed_up[np.concatenate([[True], mixed_up[1:] != mixed_up[:-1]])]
        counts = head[mixed_up + 1] - head[mixed_up]
        todo = ranges(head[mixed_up], counts)
        number = np.repeat(np.arange(len(counts)), counts)
        order = np.lexsort((digit[todo].byteswap(), number))
        moved = todo[order]
        item[todo], place[todo], digit = item[moved], place[moved], digit[moved]
        edge[todo[1:][digit[1:] != digit[:-1]]] = True
    several = ~alone()
    return item[several], np.cumsum(edge[several]) - 1


def settle(runs: Runs, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Orders all suffixes of the runs: the run of each, whether it is repeated, and whether it stands for its group."""
    owner = np.repeat(np.arange(len(runs)), runs.counts)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(runs.counts) - runs.counts, runs.counts)
    _, number = np.unique(runs.grams, return_inverse=True)
    group = (number[owner] << 16) | (runs.ahead[owner] - within)
    order = np.argsort(group, kind="stable")
    at = (runs.starts[owner] + within)[order]
    item, which = equal_groups(runs.raw, at, group[order], size)
    repeated = np.zeros(len(owner), dtype=bool)
    repeated[order[item]] = True
    stays = np.ones(len(owner), dtype=bool)
    later = np.concatenate([[False], which[1:] == which[:-1]])[: len(which)]
    stays[order[item[later]]] = False
    return owner, repeated, stays


def _stretches(flags: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where stretches of marked neighbours of one run start, and how many there are."""
    goes_on = flags[1:] & flags[:-1] & (owner[1:] == owner[:-1])
    start = np.flatnonzero(flags & ~np.concatenate([[False], goes_on])[: len(flags)])
    ends = np.flatnonzero(flags & ~np.concatenate([goes_on, [False]])[: len(flags)])
    return start, ends - start + 1


SENT = "block int, salt int, kind int, n int, raw_size long, body binary"
_RUN = (("grams", "<u8"), ("tags", "<i8"), ("docs", "<i8"), ("places", "<i8"), ("counts", "<u4"), ("ahead", "<u2"))
_MARK = (("tags", "<i8"), ("docs", "<i8"), ("places", "<i8"), ("counts", "<u4"))


def _packed(columns: list[np.ndarray], kinds: tuple, raw: np.ndarray | None = None) -> tuple[int, bytes]:
    body = b"".join(x.astype(kind).tobytes() for x, (_, kind) in zip(columns, kinds, strict=True))
    body += b"" if raw is None else raw.tobytes()
    return len(body), pa.compress(body, codec="zstd", asbytes=True)


def _unpacked(n: int, raw_size: int, body: bytes, kinds: tuple) -> tuple[list[np.ndarray], np.ndarray]:
    data, at, found = pa.decompress(body, raw_size, codec="zstd", asbytes=True), 0, []
    for _, kind in kinds:
        x = np.frombuffer(data, kind, n, at)
        at += x.nbytes
        found.append(x.astype("<i8") if kind in ("<u4", "<u2") else x)
    return found, np.frombuffer(data, np.uint8, offset=at)


def _row(block: int, salt: int, kind: int, n: int, raw_size: int, body: bytes) -> pa.RecordBatch:
    values = ([block], [salt], [kind], [n], [raw_size], [body])
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
    names = ["block", "salt", "kind", "n", "raw_size", "body"]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names)


def _marks(runs: Runs, owner: np.ndarray, repeated: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows of kind 1: the repeated suffixes as stretches, by bucket of their rows."""
    start, counts = _stretches(repeated, owner)
    if not len(start):
        return
    run = owner[start]
    first = np.searchsorted(owner, run)
    columns = [runs.tags[run], runs.docs[run], runs.places[run] + start - first, counts]
    bucket = columns[0] % buckets
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.concatenate([[True], np.diff(bucket[order]) > 0, [True]]))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        own = order[a:b]
        yield _row(int(bucket[own[0]]), 0, 1, len(own), *_packed([x[own] for x in columns], _MARK))


def _sent(runs: Runs, owner: np.ndarray, stays: np.ndarray, size: int, blocks: int, salt: Callable[[np.ndarray], np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Rows of kind 0: one suffix of each group, by block of first digits and salt."""
    start, counts = _stretches(stays, owner)
    run = owner[start]
    skip = start - np.searchsorted(owner, run)
    block = (runs.grams[run] >> np.uint64(24)) % np.uint64(blocks)
    salts = salt(runs.grams[run]).astype(np.uint64)
    where = (block << np.uint64(16)) | salts
    order = np.argsort(where, kind="stable")
    edges = np.flatnonzero(np.concatenate([[len(order) > 0], np.diff(where[order]) > 0, [True]]))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        own = order[a:b]
        part = runs.part(run[own], skip[own], counts[own], size)
        body = _packed([getattr(part, name) for name, _ in _RUN], _RUN, part.raw)
        yield _row(int(block[own[0]]), int(salts[own[0]]), 0, len(own), *body)


def repeated_places(rows: DataFrame, size: int, total: int, buckets: int) -> DataFrame:
    """Rows of kind 1 with the places of ``rows`` (``tag, doc_id, text``) whose ``size`` bytes also start elsewhere."""
    spark = rows.sparkSession
    blocks = max(64, total // BLOCK_BYTES)
    expected = 2 * total // (size - GRAM + 2) + 1
    salts = min(max(8, int((total // (4 * HELD)) ** 0.5)), 60_000)

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in pieces(batches):
            for chunk in _chunks(*text_bytes(batch.column("text")), size):
                yield chunk[-1]

    heavy = max(HEAVY, expected // sketch.HEAVY_CELLS)
    met = spark.sparkContext.broadcast(sketch.build(rows.select("text"), grams, expected, heavy_from=heavy))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, task = met.value, TaskContext.get().partitionId()
        held: list[Runs] = []
        n = 0

        def salted(grams: np.ndarray) -> np.ndarray:
            return np.where(counts.level(grams) > 0, 1 + task % salts, 0)

        def flush() -> Iterator[pa.RecordBatch]:
            runs = joined(held)
            owner, repeated, stays = settle(runs, size)
            yield from _marks(runs, owner, repeated, buckets)
            yield from _sent(runs, owner, stays, size, blocks, salted)

        for batch in pieces(batches):
            for runs in _candidates(batch, size, counts):
                held.append(runs)
                n += int(runs.counts.sum())
                if n >= HELD:
                    yield from flush()
                    held, n = [], 0
        if held:
            yield from flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = (-1, -1), []

        def done() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            runs = joined(held)
            order = np.argsort(runs.grams, kind="stable")
            upto = np.cumsum(runs.counts[order])
            fresh = np.concatenate([[True], np.diff(runs.grams[order]) != 0])
            first = np.flatnonzero(fresh)
            step = (upto[first] - runs.counts[order][first]) // HELD
            cuts = [0, *first[np.flatnonzero(np.diff(step)) + 1].tolist(), len(order)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                part = runs.rows(order[a:b])
                owner, repeated, stays = settle(part, size)
                yield from _marks(part, owner, repeated, buckets)
                if current[1]:
                    yield from _sent(part, owner, stays, size, blocks, lambda g: np.zeros(len(g)))

        for batch in batches:
            for i, row in enumerate(zip(*(c.to_pylist() for c in batch.columns), strict=True)):
                block, salt, kind, n, raw_size, body = row
                if kind:
                    yield batch.slice(i, 1)
                    continue
                if (block, salt) != current:
                    yield from done()
                    current, held = (block, salt), []
                columns, raw = _unpacked(n, raw_size, body, _RUN)
                lengths = columns[4] + size - 1
                held.append(Runs(*columns, np.cumsum(lengths) - lengths, raw))
        yield from done()

    found = rows.mapInArrow(find, SENT)
    for keys in (["block", "salt"], ["block"]):
        found = found.repartition(*keys, "kind").sortWithinPartitions("kind", "block", "salt").mapInArrow(meet, SENT)
    return found


def _removed(batch_starts: np.ndarray, rows: np.ndarray, places: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """Which bytes go: ``counts`` strings in a row from ``places`` on, by row."""
    change = np.zeros(int(batch_starts[-1]) + 1, np.int32)
    first = batch_starts[rows] + places
    np.add.at(change, first, 1)
    np.add.at(change, first + counts - 1 + size, -1)
    return np.cumsum(change[:-1], dtype=np.int32) > 0


Finish = Callable[[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray], pa.RecordBatch]


def _key() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1))


def _cut_all(docs: DataFrame, size: int, finish: Finish, schema: T.StructType | str) -> DataFrame:
    """Every row of ``docs`` through ``finish``, with all its batch's bytes, where texts start, and which bytes go."""
    if not 2 * GRAM <= size < 1 << 16:
        raise ValueError(f"size must be from {2 * GRAM} to 65,535 bytes")
    names = docs.columns
    tag = F.xxhash64(_key(), F.col("text"))
    total = int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    buckets = max(8, total // BLOCK_BYTES) | 1
    marks = repeated_places(docs.select(tag.alias("tag"), _key().alias("doc_id"), "text"), size, total, buckets)
    other = [docs[c].alias(f"c{i}") for i, c in enumerate(names) if c != "text"]
    rows = docs.select(
        F.pmod(tag, F.lit(buckets)).cast("int").alias("block"),
        F.lit(2).alias("kind"),
        tag.alias("tag"),
        _key().alias("key"),
        F.col("text"),
        F.struct(*other).alias("other"),
    )
    both = marks.drop("salt").unionByName(rows, allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = -1, []
        ready = [np.zeros(0, np.int64)] * 4
        for batch in pieces(batches):
            blocks, kinds = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(blocks) | np.diff(kinds)) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                part = batch.slice(a, b - a)
                if blocks[a] != current:
                    current, held, ready = blocks[a], [], [np.zeros(0, np.int64)] * 4
                if kinds[a] == 1:
                    columns = (part.column(c).to_pylist() for c in ("n", "raw_size", "body"))
                    held += [_unpacked(*x, _MARK)[0] for x in zip(*columns, strict=True)]
                    continue
                if held:
                    columns = [np.concatenate(x) for x in zip(*held, strict=True)]
                    order = np.argsort(columns[0], kind="stable")
                    ready, held = [x[order] for x in columns], []
                raw, starts = text_bytes(part.column("text"))
                tags, keys = part.column("tag").to_numpy(), part.column("key").to_numpy()
                low, high = (np.searchsorted(ready[0], tags, side=s) for s in ("left", "right"))
                row = np.repeat(np.arange(len(tags)), high - low)
                mark = ranges(low, high - low)
                same = ready[1][mark] == keys[row]
                row, mark = row[same], mark[same]
                gone = _removed(starts, row, ready[2][mark], ready[3][mark], size)
                flat = iter(part.column("other").flatten())
                columns = [part.column("text") if c == "text" else next(flat) for c in names]
                yield finish(pa.RecordBatch.from_arrays(columns, names), raw, starts, gone)

    dealt = both.repartition("block").sortWithinPartitions("block", "kind")
    return dealt.mapInArrow(run, schema)


def _spans(starts: np.ndarray, gone: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first byte and end of each maximal stretch of bytes that go, within the row."""
    inner = starts[:-1][np.diff(starts) > 0]
    before = np.concatenate([[False], gone[:-1]])[: len(gone)]
    before[inner] = False
    first = np.flatnonzero(gone & ~before)
    after = np.concatenate([gone[1:], [False]])[: len(gone)]
    after[starts[1:][np.diff(starts) > 0] - 1] = False
    end = np.flatnonzero(gone & ~after) + 1
    row = np.searchsorted(starts, first, side="right") - 1
    return row, first - starts[row], end - starts[row]


def _left(raw: np.ndarray, starts: np.ndarray, gone: np.ndarray) -> list[bytes]:
    """The bytes that stay of each text."""
    kept = raw[~gone].tobytes()
    at = np.concatenate([[0], np.cumsum(~gone)])[starts].tolist()
    return [kept[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


def digest(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` (of the bytes that stay)."""

    def finish(batch: pa.RecordBatch, raw: np.ndarray, starts: np.ndarray, gone: np.ndarray) -> pa.RecordBatch:
        n = batch.num_rows
        removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[starts])
        spans = np.bincount(_spans(starts, gone)[0], minlength=n)
        sha = [hashlib.sha256(x).hexdigest() for x in _left(raw, starts, gone)]
        columns = [pa.array(x) for x in (np.diff(starts), removed, spans, sha)]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        return pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *columns], names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return _cut_all(docs.select("doc_id", "text"), size, finish, schema)


def dedup(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """``docs`` with ``kept`` (binary: the bytes that stay, which may begin or end inside a character) and
    ``removed`` (array of ``first, end``: the byte spans that go).

    All columns are kept; these two replace columns of their names.
    """
    docs = docs.drop("kept", "removed")
    span = T.StructType([T.StructField("first", T.LongType()), T.StructField("end", T.LongType())])
    more = [T.StructField("kept", T.BinaryType()), T.StructField("removed", T.ArrayType(span))]
    schema = T.StructType([*docs.schema.fields, *more])

    def finish(batch: pa.RecordBatch, raw: np.ndarray, starts: np.ndarray, gone: np.ndarray) -> pa.RecordBatch:
        row, first, end = _spans(starts, gone)
        at = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
        spans = pa.StructArray.from_arrays([pa.array(first), pa.array(end)], ["first", "end"])
        kept = pa.array(_left(raw, starts, gone), pa.binary())
        columns = [*batch.columns, kept, pa.ListArray.from_arrays(pa.array(at), spans)]
        return pa.RecordBatch.from_arrays(columns, schema.names)

    return _cut_all(docs, size, finish, schema)


def oracle() -> str:
    """DuckDB SQL for ``digest`` over ``documents``: strings of 200 bytes as 400 hexadecimal digits."""
    return f"""
WITH texts AS (SELECT doc_id, row_number() OVER () AS r, hex(encode(coalesce(text, ''))) AS h FROM documents),
places AS (SELECT r, unnest(range(len(h) // 2 - {SIZE - 1})) AS p FROM texts WHERE len(h) >= {2 * SIZE}),
strings AS (SELECT r, p, md5_number(substr(h, 2 * p + 1, {2 * SIZE})) AS k FROM places JOIN texts USING (r)),
again AS (SELECT k FROM strings GROUP BY k HAVING count(*) > 1),
hits AS (
  SELECT r, p, coalesce(p - lag(p) OVER (PARTITION BY r ORDER BY p) > {SIZE}, true) AS fresh
  FROM strings SEMI JOIN again USING (k)),
numbered AS (SELECT r, p, sum(fresh::INT) OVER (PARTITION BY r ORDER BY p) AS s FROM hits),
spans AS (SELECT r, s, min(p) AS a, max(p) + {SIZE} AS b FROM numbered GROUP BY r, s),
cuts AS (
  SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS upto FROM spans
  UNION ALL
  SELECT r, len(h) // 2, len(h) // 2, coalesce(e, 0)
  FROM texts LEFT JOIN (SELECT r, max(b) AS e FROM spans GROUP BY r) USING (r)),
kept AS (
  SELECT r, string_agg(substr(h, 2 * upto + 1, 2 * (a - upto)), '' ORDER BY a, upto) AS k
  FROM cuts JOIN texts USING (r) GROUP BY r)
SELECT doc_id, len(h) // 2 AS n_bytes, (len(h) - len(k)) // 2 AS n_removed,
  (SELECT count(*) FROM spans WHERE spans.r = texts.r) AS n_spans, sha256(unhex(k)) AS kept_sha256
FROM texts JOIN kept USING (r)
"""
