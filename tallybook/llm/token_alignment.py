"""Alignment of two tokenizers' ids over the same texts.

Both tokenizers give the ids of the whole text (with the space in front that B adds by itself). Neither has
tokens that go on over a space after a visible ASCII character, nor looks back there, so texts are cut there
and each distinct part is encoded once. The bytes of either's tokens must join to the text, else the
document counts as without tokens.

1. Anchors: where tokens of A and of B both end, and both next tokens begin with a space, a document is
   cut. What lies between is a window: a few ids of A and of B, mostly a word.
2. Windows are aligned once per task and tuple of ids: groups end where tokens of both end, links are
   pairs of tokens whose bytes overlap. Documents only name their windows.
3. Links of all windows are added up by pair of ids, in the task, then by block of pairs. The table of
   counts is broadcast up to ``MOST_PAIRS`` pairs, the most frequent ones; links of other pairs, few each,
   meet their counts in a join. The highest count of each B id has a bound of its own, B's vocabulary.

Defined results: a text that is null, empty, or not joined again from either's tokens (such as one with
U+2581, which B takes for a space) has zeros and an empty ``groups_sha256``; repeated rows count as often
as they stand, whatever their ``doc_id``; a null ``doc_id`` stays null; equal counts are all the best; an
empty table gives an empty result. Other columns aren't read.
"""

from __future__ import annotations

import functools
import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.parts import PartIds, ranges
from tallybook.llm.words import mixed, pieces, text_bytes
from tallybook.session import materialise

MOST_PAIRS = 2_000_000
"""Pairs of ids in the broadcast table of counts, 12 bytes each."""
MOST_WINDOWS = 250_000
"""Different windows that a task remembers; beyond it sends what it has counted and starts anew."""
CACHED = 300_000
"""Distinct parts of texts whose ids a worker remembers, about 15 MB for each tokenizer."""
BATCH_BYTES = 2 << 20
AT_ONCE = 5_000
MARK = "▁"
BLOCKS = 256


def _byte_marks() -> dict[str, int]:
    """Byte-level BPE writes bytes as characters: visible ones as themselves, the others from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """The bytes of every id, end to end."""

    def __init__(self, entries: list[bytes]):
        self.lengths = np.fromiter(map(len, entries), np.int64, len(entries))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.body = np.frombuffer(b"".join(entries), np.uint8)
        self.spaced = np.fromiter((x[:1] == b" " for x in entries), bool, len(entries))

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.body[ranges(self.starts[ids], self.lengths[ids])]


class Tokenizers:
    """Tokenizer A (a tokenizers file, byte-level) and B (a SentencePiece model)."""

    def __init__(self, path_a: str, model_b: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        marks = _byte_marks()
        entries = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        # an added token's own text is not in byte-level marks; it can't come from plain text
        self.bytes_a = Vocabulary([bytes(marks.get(c, 0) for c in x) for x in entries])
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model_b)
        pieces_b = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(MARK in x.lstrip(MARK) for x in pieces_b):
            raise ValueError("the model has pieces that reach over spaces")
        self.bytes_b = Vocabulary([self._piece(i, x) for i, x in enumerate(pieces_b)])
        self.space_b = self.b.piece_to_id(MARK)
        self.parts_a, self.parts_b = PartIds(self._encode_a, CACHED), PartIds(self._encode_b, CACHED)

    def _piece(self, i: int, piece: str) -> bytes:
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(MARK, " ").encode()

    def _encode_a(self, parts: list[bytes]) -> list[list[int]]:
        found: list[list[int]] = []
        for at in range(0, len(parts), AT_ONCE):
            texts = [p.decode("utf-8") for p in parts[at : at + AT_ONCE]]
            found += [x.ids for x in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        return found

    def _encode_b(self, parts: list[bytes]) -> list[list[int]]:
        """B puts the space in front of a part itself, but for an empty one."""
        found = self.b.encode([p[1:].decode("utf-8") for p in parts], num_threads=1)
        return [ids if len(p) > 1 else [self.space_b] for ids, p in zip(found, parts, strict=True)]

    def encode(self, body: np.ndarray, starts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of all texts end to end and where each text's begin, for A and for B. Each text begins with a space."""
        cut = np.zeros(len(body) + 1, dtype=bool)
        cut[1:-1] = (body[1:] == 0x20) & (body[:-1] > 0x20) & (body[:-1] < 0x7F)
        cut[starts] = True
        cuts = np.flatnonzero(cut)
        found = []
        for parts in (self.parts_a, self.parts_b):
            ids, lengths = parts.ids(body, cuts[:-1], cuts[1:])
            upto = np.concatenate([[0], np.cumsum(lengths)])
            found.append((ids.astype(np.int64), upto[np.searchsorted(cuts, starts)]))
        return found


def spaced(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, those that aren't empty with a space in front, and where each begins."""
    raw, at = text_bytes(texts)
    filled = np.diff(at) > 0
    return np.insert(raw, at[:-1][filled], 0x20), at + np.concatenate([[0], np.cumsum(filled)])


@functools.cache
def _tokenizers(path_a: str, model_b: bytes) -> Tokenizers:
    return Tokenizers(path_a, model_b)


def _whole(vocabulary: Vocabulary, ids: np.ndarray, at: np.ndarray, body: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Which texts are what the bytes of their ids join to."""
    ends = np.concatenate([[0], np.cumsum(vocabulary.lengths[ids])])[at]
    same = np.diff(ends) == np.diff(starts)
    joined = vocabulary.joined(ids)
    if same.all():
        row, differs = np.arange(len(same)), joined != body
    else:
        row = np.flatnonzero(same)
        differs = joined[_within(ends, row)] != body[_within(starts, row)]
    if differs.any():
        same[row[np.repeat(np.arange(len(row)), np.diff(starts)[row])[differs]]] = False
    return same


def _within(edges: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return ranges(edges[rows], edges[rows + 1] - edges[rows])


class Aligned:
    """The windows of one batch of texts that both tokenizers give back."""

    def __init__(self, tools: Tokenizers, texts: pa.Array):
        body, starts = spaced(texts)
        (self.a, at_a), (self.b, at_b) = tools.encode(body, starts)
        ok = _whole(tools.bytes_a, self.a, at_a, body, starts) & _whole(tools.bytes_b, self.b, at_b, body, starts)
        if not ok.all():
            self.a, at_a = _only(self.a, at_a, ok)
            self.b, at_b = _only(self.b, at_b, ok)
        self.n_a, self.n_b = np.diff(at_a), np.diff(at_b)
        self.lengths_a, self.lengths_b = tools.bytes_a.lengths[self.a], tools.bytes_b.lengths[self.b]
        self.ends_a, self.ends_b = np.cumsum(self.lengths_a), np.cumsum(self.lengths_b)
        # all texts end to end: a text's end is an end of both, and each text begins with a space
        ends = np.zeros((2, len(body) + 1), dtype=bool)
        ends[0, self.ends_a] = ends[1, self.ends_b] = True
        in_a, in_b = np.flatnonzero(ends[1, self.ends_a]), np.flatnonzero(ends[0, self.ends_b])
        next_a = np.concatenate([tools.bytes_a.spaced[self.a], [True]])[in_a + 1]
        next_b = np.concatenate([tools.bytes_b.spaced[self.b], [True]])[in_b + 1]
        anchor = next_a & next_b
        self.last_a, self.last_b = in_a[anchor], in_b[anchor]
        text_ends = self.ends_a[at_a[1:][self.n_a > 0] - 1] if len(self.a) else np.zeros(0, np.int64)
        upto = np.searchsorted(self.ends_a[self.last_a], text_ends) + 1
        self.windows = np.zeros(len(texts), np.int64)
        self.windows[self.n_a > 0] = np.diff(np.concatenate([[0], upto]))
        """How many windows each text has."""

    def window_hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits of each window's ids, in two halves."""
        halves = []
        for salt in (1, 2):
            sums = []
            for side, ids, last in ((0, self.a, self.last_a), (4, self.b, self.last_b)):
                first = _after(last)
                place = np.arange(len(ids)) - np.repeat(first, last - first + 1)
                h = mixed((ids | (place << 20)).astype(np.uint64) + np.uint64((salt + side) << 60))
                sums.append(np.add.reduceat(h, first) if len(first) else h)
            halves.append(mixed(sums[0] ^ mixed(sums[1])))
        return halves[0], halves[1]

    def spans(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First and last token (not included) of A and of B of some windows."""
        first_a, first_b = _after(self.last_a), _after(self.last_b)
        return first_a[which], self.last_a[which] + 1, first_b[which], self.last_b[which] + 1

    def links(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of all links of some windows in order: number of the window among them, A's token, B's, and whether
        a group ends with it."""
        first_a, end_a, _, _ = self.spans(which)
        token = ranges(first_a, end_a - first_a)
        window = np.repeat(np.arange(len(which)), end_a - first_a)
        end = self.ends_a[token]
        low = np.searchsorted(self.ends_b, end - self.lengths_a[token], side="right")
        high = np.searchsorted(self.ends_b, end, side="left")
        other = ranges(low, high - low + 1)
        again = np.repeat(np.arange(len(token)), high - low + 1)
        closes = self.ends_a[token][again] == self.ends_b[other]
        return window[again], token[again], other, closes


def _after(last: np.ndarray) -> np.ndarray:
    """Where windows begin that end with the given tokens."""
    return np.concatenate([[0], last + 1])[:-1]


def _only(ids: np.ndarray, at: np.ndarray, ok: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.diff(at) * ok
    return ids[ranges(at[:-1], lengths)], np.concatenate([[0], np.cumsum(lengths)])


_DIGITS = [str(i) + "," for i in range(1 << 16)]
_DIGIT_LENGTHS = np.fromiter(map(len, _DIGITS), np.int64, len(_DIGITS))
_DIGIT_STARTS = np.cumsum(_DIGIT_LENGTHS) - _DIGIT_LENGTHS
_DIGIT_BYTES = np.frombuffer("".join(_DIGITS).encode(), np.uint8)


def _written(ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids in decimal, each followed by its byte of ``ends``, and the length of each."""
    if len(ids) and int(ids.max()) >= len(_DIGITS):
        raise ValueError("ids must be under 65,536")
    lengths = _DIGIT_LENGTHS[ids]
    body = _DIGIT_BYTES[ranges(_DIGIT_STARTS[ids], lengths)]
    body[np.cumsum(lengths) - 1] = ends
    return body, lengths


class Memo:
    """Alignments of the windows met so far, by (128 bits of) their ids, and how often each was met."""

    def __init__(self):
        self.hashes, self.checks = np.zeros((2, 0), np.uint64)
        self.numbers = np.zeros(0, np.int64)
        self.body, self.pairs = np.zeros(0, np.uint8), np.zeros(0, np.uint64)
        self.lengths, self.groups, self.n_links, self.counts = np.zeros((4, 0), np.int64)

    def __len__(self) -> int:
        return len(self.counts)

    def find(self, hashes: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """The number of each window; -1 for new ones."""
        at = np.searchsorted(self.hashes, hashes)
        found = np.full(len(hashes), -1, np.int64)
        inside = np.flatnonzero(at < len(self.hashes))
        same = (self.hashes[at[inside]] == hashes[inside]) & (self.checks[at[inside]] == checks[inside])
        found[inside[same]] = self.numbers[at[inside[same]]]
        return found

    def learn(self, batch: Aligned, which: np.ndarray, hashes: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """Aligns the windows ``which``, all new, whose hashes ascend; their numbers."""
        window, a, b, closes = batch.links(which)
        pairs = (batch.a[a].astype(np.uint64) << np.uint64(32)) | batch.b[b].astype(np.uint64)
        last = np.flatnonzero(closes)
        first = np.concatenate([[0], last + 1])[:-1]
        n_a, n_b = a[last] + 1 - a[first], b[last] + 1 - b[first]
        end = np.cumsum(n_a + n_b)
        place_a, place_b = ranges(end - n_a - n_b, n_a), ranges(end - n_b, n_b)
        ids = np.zeros(len(place_a) + len(place_b), np.int64)
        ends = np.full(len(ids), ord(","), np.uint8)
        ids[place_a], ids[place_b] = batch.a[ranges(a[first], n_a)], batch.b[ranges(b[first], n_b)]
        ends[end - n_b - 1], ends[end - 1] = ord("|"), ord(";")
        body, lengths = _written(ids, ends)
        numbers = len(self) + np.arange(len(which))
        n_groups = np.bincount(window[last], minlength=len(which))
        tokens = np.concatenate([[0], end])[np.concatenate([[0], np.cumsum(n_groups)])]
        self.lengths = np.concatenate([self.lengths, np.diff(np.concatenate([[0], np.cumsum(lengths)])[tokens])])
        self.body, self.pairs = np.concatenate([self.body, body]), np.concatenate([self.pairs, pairs])
        self.groups = np.concatenate([self.groups, n_groups])
        self.n_links = np.concatenate([self.n_links, np.bincount(window, minlength=len(which))])
        self.counts = np.concatenate([self.counts, np.zeros(len(which), np.int64)])
        at = np.searchsorted(self.hashes, hashes)
        self.hashes, self.checks = np.insert(self.hashes, at, hashes), np.insert(self.checks, at, checks)
        self.numbers = np.insert(self.numbers, at, numbers)
        return numbers

    def links(self, windows: np.ndarray) -> np.ndarray:
        """Pairs of ids of all links of some windows, end to end."""
        return self.pairs[ranges((np.cumsum(self.n_links) - self.n_links)[windows], self.n_links[windows])]

    def written(self, windows: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The groups of some windows end to end, each closed by ``;``, and the length of each window's."""
        lengths = self.lengths[windows]
        return self.body[ranges((np.cumsum(self.lengths) - self.lengths)[windows], lengths)].tobytes(), lengths


FOUND = "kind int, block int, task int, batch int, n int, sizes binary, body binary"


def _squeezed(*arrays: np.ndarray) -> tuple[bytes, bytes]:
    """Lengths of the packed arrays and of their bytes, and all of them end to end."""
    bodies = [pa.compress(np.ascontiguousarray(x), codec="zstd", asbytes=True) for x in arrays]
    sizes = np.array([[x.nbytes, len(b)] for x, b in zip(arrays, bodies, strict=True)], "<i8")
    return sizes.tobytes(), b"".join(bodies)


def _spread(sizes: bytes, body: bytes, kinds: tuple[str, ...]) -> list[np.ndarray]:
    found, at = [], 0
    for (n, length), kind in zip(np.frombuffer(sizes, "<i8").reshape(-1, 2).tolist(), kinds, strict=True):
        part = pa.decompress(body[at : at + length], n, codec="zstd", asbytes=True) if n else b""
        found.append(np.frombuffer(part, kind))
        at += length
    return found


def _row(kind: int, block: int, task: int, batch: int, n: int, *arrays: np.ndarray) -> pa.RecordBatch:
    values = ([kind], [block], [task], [batch], [n], *([x] for x in _squeezed(*arrays)))
    kinds = (*[pa.int32()] * 5, pa.binary(), pa.binary())
    names = ["kind", "block", "task", "batch", "n", "sizes", "body"]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names)


_COUNTED = ("<u8", "<i8")
_ALIGNED = ("<i8", "u1", "<i4", "<i4", "<i4", "<i4", "u1", "<u4", "<u8", "<u4")
"""doc ids, whether null, tokens of A and B, groups, windows, digests, window of each place, pairs, links of each window."""


def aligned(docs: DataFrame, path_a: str, model_b: bytes) -> DataFrame:
    """Rows of kind 0, a batch of documents with their windows, and of kind 1, counts of pairs by block; packed."""
    model = docs.sparkSession.sparkContext.broadcast((path_a, model_b))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools, memo = _tokenizers(*model.value), Memo()
        task = TaskContext.get().partitionId()

        def counted() -> Iterator[pa.RecordBatch]:
            distinct, which = np.unique(memo.pairs, return_inverse=True)
            n = np.zeros(len(distinct), np.int64)
            np.add.at(n, which, np.repeat(memo.counts, memo.n_links))
            block = (mixed(distinct) % np.uint64(BLOCKS)).astype(np.int64)
            order = np.argsort(block, kind="stable")
            edges = np.searchsorted(block[order], np.arange(BLOCKS + 1))
            for b in np.flatnonzero(np.diff(edges)).tolist():
                own = order[edges[b] : edges[b + 1]]
                yield _row(1, b, task, 0, len(own), distinct[own], n[own])

        for number, batch in enumerate(pieces(batches, limit=BATCH_BYTES)):
            found = Aligned(tools, batch.column("text"))
            hashes, checks = found.window_hashes()
            distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
            if len(memo) and len(memo) + len(distinct) > MOST_WINDOWS:
                yield from counted()
                memo = Memo()
            known = memo.find(distinct, checks[first])
            new = np.flatnonzero(known < 0)
            known[new] = memo.learn(found, first[new], distinct[new], checks[first[new]])
            memo.counts[known] += np.bincount(which, minlength=len(known))
            body, lengths = memo.written(known[which])
            edges = np.concatenate([[0], np.cumsum(found.windows)])
            ends = np.concatenate([[0], np.cumsum(lengths)])[edges].tolist()
            sha = b"".join(
                hashlib.sha256(body[a : max(b - 1, a)]).digest() for a, b in zip(ends[:-1], ends[1:], strict=True)
            )
            sums = np.diff(np.concatenate([[0], np.cumsum(memo.groups[known[which]])])[edges])
            n_links = memo.n_links[known]
            ids = batch.column("doc_id")
            yield _row(
                0, 0, task, number, batch.num_rows,
                ids.fill_null(0).to_numpy().astype("<i8"),
                ids.is_null().to_numpy(zero_copy_only=False).astype("u1"),
                found.n_a.astype("<i4"),
                found.n_b.astype("<i4"),
                sums.astype("<i4"),
                found.windows.astype("<i4"),
                np.frombuffer(sha, "u1"),
                which.astype("<u4"),
                memo.links(known),
                n_links.astype("<u4"),
            )
        if len(memo):
            yield from counted()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, FOUND)


def pair_counts(found: DataFrame) -> DataFrame:
    """``a, b, count``: how many links of all documents hold each pair of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: int | None = None
        held: list[list[np.ndarray]] = []

        def out() -> pa.RecordBatch:
            pairs, counts = (np.concatenate(x) for x in zip(*held, strict=True))
            distinct, which = np.unique(pairs, return_inverse=True)
            sums = np.zeros(len(distinct), np.int64)
            np.add.at(sums, which, counts)
            a, b = (distinct >> np.uint64(32)).astype(np.int32), (distinct & np.uint64(0xFFFFFFFF)).astype(np.int32)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(sums)], ["a", "b", "count"])

        for batch in batches:
            for block, sizes, body in zip(*(batch.column(c).to_pylist() for c in ("block", "sizes", "body")), strict=True):
                if block != current:
                    if held:
                        yield out()
                    current, held = block, []
                held.append(_spread(sizes, body, _COUNTED))
                if len(held) >= 64:
                    done = out()
                    pair = (done.column("a").to_numpy().astype(np.uint64) << np.uint64(32)) | done.column("b").to_numpy().astype(np.uint64)
                    held = [[pair, done.column("count").to_numpy()]]
        if held:
            yield out()

    rows = found.filter("kind = 1").select("block", "sizes", "body")
    dealt = rows.repartition("block").sortWithinPartitions("block")
    return dealt.mapInArrow(run, "a int, b int, count long")


def _frequent(counts: DataFrame, n: int, most: int) -> DataFrame:
    """The pairs that go in the broadcast table: all, or those over the count that leaves at most ``most``."""
    if n <= most:
        return counts
    sizes = counts.groupBy((F.length(F.bin("count")) - 1).alias("size")).agg(F.count(F.lit(1)).alias("n"))
    room, least = most, 62
    for size, n in sorted(map(tuple, sizes.collect()), reverse=True):
        if n > room:
            break
        room, least = room - n, size
    return counts.filter(F.col("count") >= (1 << least))


_DIGEST = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


def digest(docs: DataFrame, path_a: str, model_b: bytes, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """One row per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``."""
    spark = docs.sparkSession
    found, _ = materialise(aligned(docs, path_a, model_b), "alignments")
    counts, n = materialise(pair_counts(found), "pair-counts")
    highest = counts.groupBy("b").agg(F.max("count").alias("highest")).toArrow()
    table = _frequent(counts, n, most_pairs).toArrow()
    pairs = (table.column("a").to_numpy().astype(np.uint64) << np.uint64(32)) | table.column("b").to_numpy().astype(np.uint64)
    order = np.argsort(pairs)
    top = np.zeros(int(highest.column("b").to_numpy().max()) + 1 if len(highest) else 1, np.int64)
    top[highest.column("b").to_numpy()] = highest.column("highest").to_numpy()
    sent = spark.sparkContext.broadcast((pairs[order], table.column("count").to_numpy()[order], top))
    whole = table.num_rows == n
    del table, pairs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts, top = sent.value
        for batch in batches:
            for kind in zip(*(batch.column(c).to_pylist() for c in ("task", "batch", "n", "sizes", "body")), strict=True):
                task, number, n, sizes, body = kind
                ids, null, n_a, n_b, groups, windows, sha, which, links, n_links = _spread(sizes, body, _ALIGNED)
                at = np.searchsorted(known, links)
                there = np.zeros(len(links), dtype=bool)
                inside = at < len(known)
                there[inside] = known[at[inside]] == links[inside]
                count = np.zeros(len(links), np.int64)
                count[there] = counts[at[there]]
                best = there & (count == top[(links & np.uint64(0xFFFFFFFF)).astype(np.int64)])
                edges = np.concatenate([[0], np.cumsum(n_links.astype(np.int64))])
                places = np.concatenate([[0], np.cumsum(windows.astype(np.int64))])

                def by_document(values: np.ndarray) -> np.ndarray:
                    by_window = np.diff(np.concatenate([[0], np.cumsum(values, dtype=np.int64)])[edges])
                    return np.diff(np.concatenate([[0], np.cumsum(by_window[which])])[places])

                hexed = sha.tobytes().hex()
                empty = (n_a == 0).tolist()
                names = ["" if none else hexed[64 * i : 64 * i + 64] for i, none in enumerate(empty)]
                columns = [
                    pa.array(ids, mask=null.astype(bool)),
                    *(pa.array(x.astype(np.int64)) for x in (n_a, n_b, groups)),
                    *(pa.array(by_document(x)) for x in (np.ones(len(links)), best, count)),
                    pa.array(names),
                ]
                if not whole:
                    row = np.arange(n) + ((np.int64(task) << 40) | (np.int64(number) << 20))
                    columns += [pa.array(row), _missing(links, there, edges, which, places)]
                yield pa.RecordBatch.from_arrays(columns, names_out)

    names_out = [x.split()[0] for x in _DIGEST.split(", ")] + ([] if whole else ["row", "missing"])
    packed = found.filter("kind = 0").select("task", "batch", "n", "sizes", "body")
    if whole:
        return packed.mapInArrow(run, _DIGEST)
    more = f"{_DIGEST}, row long, missing array<struct<a:int,b:int,n:long>>"
    rows, _ = materialise(packed.mapInArrow(run, more), "alignment-sums")
    rest = rows.select("row", F.inline("missing"))
    tops = spark.createDataFrame(highest.rename_columns(["b", "highest"]))
    rest = rest.join(counts, ["a", "b"]).join(F.broadcast(tops), "b")
    is_best = F.when(F.col("count") == F.col("highest"), F.col("n")).otherwise(0)
    sums = rest.groupBy("row").agg(F.sum(F.col("n") * F.col("count")).alias("s"), F.sum(is_best).alias("k"))
    added = {
        "n_best": F.col("n_best") + F.coalesce("k", F.lit(0)),
        "count_sum": F.col("count_sum") + F.coalesce("s", F.lit(0)),
    }
    return rows.join(sums, "row", "left").withColumns(added).select(*(x.split()[0] for x in _DIGEST.split(", ")))


def _missing(links: np.ndarray, there: np.ndarray, edges: np.ndarray, which: np.ndarray, places: np.ndarray) -> pa.Array:
    """For each document the pairs that the table doesn't have, and how many links hold them."""
    window = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    absent = np.flatnonzero(~there)
    first = np.searchsorted(window[absent], np.arange(len(edges)))
    own = np.diff(first)[which]
    link = links[absent[ranges(first[:-1][which], own)]]
    document = np.repeat(np.repeat(np.arange(len(places) - 1), np.diff(places)), own)
    order = np.lexsort((link, document))
    link, document = link[order], document[order]
    edge = np.flatnonzero(np.concatenate([[True], (link[1:] != link[:-1]) | (document[1:] != document[:-1])])[: len(link)])
    counts = np.diff(np.concatenate([edge, [len(link)]]))
    values = pa.StructArray.from_arrays(
        [
            pa.array((link[edge] >> np.uint64(32)).astype(np.int32)),
            pa.array((link[edge] & np.uint64(0xFFFFFFFF)).astype(np.int32)),
            pa.array(counts),
        ],
        ["a", "b", "n"],
    )
    at = np.searchsorted(document[edge], np.arange(len(places))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), values)
