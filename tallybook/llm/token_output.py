"""Token ids of all documents in binary shards, packed by a grammar.

Every shard (a run of documents in ascending ``doc_id`` order, at most ``SHARD_TOKENS`` ids unless
one document has more) is packed by Re-Pair: the most frequent pairs of neighbours become new
symbols, round after round, until no pair saves more than its rule costs, however many rounds and
rules that takes. A round takes all pairs at least half as frequent as the most frequent one; a
rule that others leave too few places waits for a later round. A pair never reaches over the end of a
document, so each document is a run of symbols of its own. A shard holds the rules, the length
that each rule expands to, the place of every document among symbols and among ids, and the
symbols; so one document, or a range of its ids, is decoded without the rest.

Shards are rows of a Parquet table (``part, shard, n_docs, n_tokens, before, payload``): Spark's
committer makes repeated tasks safe, and any store that Spark writes to will do.
"""

from __future__ import annotations

import codecs
import functools
import itertools
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybook.llm.parts import PartIds, ranges
from tallybook.llm.words import LOWER, Words, mixed, pieces

SHARD_TOKENS = 4_000_000
LEAST_SAVED = 4
"""A pair must be replaced this often to save more than its rule: two symbols and a length."""
MAGIC = b"RPG3"
END_ID = 2

_HEAD = struct.Struct("<4sIIIIII")


def compress(
    ids: np.ndarray,
    starts: np.ndarray,
    rounds: int | None = None,
    per_round: int | None = None,
    least: int = LEAST_SAVED,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Symbols, where each document starts among them, rules (n x 2), and the first rule's symbol.

    Each round makes rules of the most frequent pairs (ties by their hash) and replaces them, the more
    frequent where two overlap; it ends when no pair can be replaced ``least`` times.

    Pairs are counted once. A round's new pairs all hold one of its own new symbols, so no older pair ever
    becomes more frequent: each round counts the pairs that it makes, takes off those that it
    breaks, and a pair that falls short of ``least`` when it is made is never looked at again.
    """
    symbols = ids.astype(np.uint32)
    base = int(symbols.max()) + 1 if len(symbols) else 0
    known = _Pairs(symbols, starts.astype(np.int64), least)
    rules: list[np.ndarray] = []
    made = 0
    for _ in itertools.count() if rounds is None else range(rounds):
        best = known.best(per_round)
        if not len(best):
            break
        at, rule, chosen = known.places(best)
        known.replace(at, rule, base + made)
        pairs = known.keys[chosen]
        rules.append(np.stack([pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)], axis=1).astype(np.uint32))
        made += len(chosen)
    table = np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)
    return *known.left(), table, base


class _Pairs:
    """The pairs that stand ``least`` times, how often, and where.

    Symbols stay where they are and know the places before and after them, so a round touches only what it
    replaces. All places of a pair are listed when it is made; ``at`` says which pair still starts at a
    place (-1: none).
    """

    def __init__(self, symbols: np.ndarray, starts: np.ndarray, least: int):
        n = len(symbols)
        self.least, self.symbols, self.starts = least, symbols, starts
        self.next, self.before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        self.first = np.zeros(n + 1, dtype=bool)
        self.first[starts] = self.first[n] = True
        self.live = np.ones(n, dtype=bool)
        self.at = np.full(n, -1, np.int32)
        self.keys, self.twin = np.zeros(0, np.uint64), np.zeros(0, dtype=bool)
        self.counts, self.begin, self.size = (np.zeros(0, np.int64) for _ in range(3))
        self.listed, self.n_listed = np.zeros(n, np.int32), 0
        self._count(np.arange(n))

    def _count(self, places: np.ndarray) -> None:
        """Number, count and list the pairs that start at these places, none of which is known."""
        places = places[~self.first[self.next[places]]]
        if not len(places):
            return
        a, b = self.symbols[places].astype(np.uint64), self.symbols[self.next[places]].astype(np.uint64)
        width, wide = (int(max(a.max(), b.max())).bit_length() or 1), len(self.symbols).bit_length()
        keys = (a << np.uint64(width)) | b
        if 2 * width + wide <= 64:  # one sort of plain numbers is much faster than one of their order
            both = np.sort((keys << np.uint64(wide)) | places.astype(np.uint64))
            keys, places = both >> np.uint64(wide), (both & np.uint64((1 << wide) - 1)).astype(np.int64)
        else:
            order = np.lexsort((places, keys))
            keys, places = keys[order], places[order]
        fresh = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        counts = np.diff(np.concatenate([fresh, [len(keys)]]))
        often = counts >= self.least
        listed, counts, keys = places[np.repeat(often, counts)], counts[often], keys[fresh[often]]
        a, b = keys >> np.uint64(width), keys & np.uint64((1 << width) - 1)
        self.at[listed] = np.repeat(np.arange(len(self.keys), len(self.keys) + len(keys)), counts)
        if self.n_listed + len(listed) > len(self.listed):
            more = np.zeros(max(len(self.listed), len(listed)), np.int32)
            self.listed = np.concatenate([self.listed, more])
        self.listed[self.n_listed : self.n_listed + len(listed)] = listed
        self.begin = np.concatenate([self.begin, self.n_listed + np.cumsum(counts) - counts])
        self.n_listed += len(listed)
        self.size = np.concatenate([self.size, counts])
        self.counts = np.concatenate([self.counts, counts])
        self.keys = np.concatenate([self.keys, (a << np.uint64(32)) | b])
        self.twin = np.concatenate([self.twin, a == b])

    def _where(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places where these pairs start now, ascending, and which of them does."""
        size = self.size[pairs]
        places = self.listed[ranges(self.begin[pairs], size)]
        which = np.repeat(np.arange(len(pairs)), size)
        still = self.at[places] == pairs[which]
        both = np.sort((places[still].astype(np.int64) << 32) | which[still])
        return both >> 32, both & 0xFFFFFFFF

    def _every_other(self, at: np.ndarray) -> np.ndarray:
        """Of ascending places, the first, third, ... of each run of neighbours."""
        fresh = np.concatenate([[True], self.next[at[:-1]] != at[1:]])[: len(at)]
        run_start = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
        return (np.arange(len(at)) - run_start) % 2 == 0

    def best(self, most: int | None) -> np.ndarray:
        """Pairs that can be replaced at least half as often as the one that can be most, that one first."""
        counts = self.counts.copy()
        twins = np.flatnonzero(self.twin & (counts >= self.least))
        at, which = self._where(twins)
        counts[twins] = np.bincount(which[self._every_other(at)], minlength=len(twins))
        top = int(counts.max(initial=0))
        worth = np.flatnonzero(counts >= max(top // 2, self.least))
        return worth[np.lexsort((mixed(self.keys[worth]), -counts[worth]))][:most]

    def places(self, best: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where pairs are replaced, by which of those that are replaced ``least`` times, and these.

        Where pairs overlap the one that stands first in ``best`` goes, so copies of a passage are
        replaced alike, and the first of all is replaced wherever it can be.
        """
        order = np.argsort(self.keys[best])
        chosen = best[order]
        at, rule = self._where(chosen)
        twin = np.flatnonzero(self.twin[chosen][rule])
        stays = np.ones(len(at), dtype=bool)
        stays[twin[~self._every_other(at[twin])]] = False
        at, rule = at[stays], rule[stays]
        rank = order[rule]
        near = np.flatnonzero(self.next[at[:-1]] == at[1:])
        first = rank[near] < rank[near + 1]
        take = np.ones(len(at), dtype=bool)
        take[near[~first]] = False
        take[near[first] + 1] = False
        at, rule = at[take], rule[take]
        enough = np.bincount(rule, minlength=len(chosen)) >= self.least
        number = np.cumsum(enough) - 1
        take = enough[rule]
        return at[take], number[rule[take]], chosen[enough]

    def replace(self, at: np.ndarray, rule: np.ndarray, fresh: int) -> None:
        """Replace the pairs at these places by the symbols from ``fresh`` on."""
        gone = self.next[at]
        self.live[gone] = False
        back = self.before[at[self.before[at] >= 0]]
        touched = np.concatenate([at, gone, back[self.live[back]]])
        broken = self.at[touched]
        self.counts -= np.bincount(broken[broken >= 0], minlength=len(self.counts))
        self.at[touched] = -1
        self.symbols[at] = rule + fresh
        self.next[at] = after = self.next[gone]
        inside = after < len(self.symbols)
        self.before[after[inside]] = at[inside]
        back = self.before[at]
        back = back[back >= 0]
        self._count(np.concatenate([at, back[self.symbols[back] < fresh]]))

    def left(self) -> tuple[np.ndarray, np.ndarray]:
        """The symbols that are left, and where each document starts among them."""
        return self.symbols[self.live], np.concatenate([[0], np.cumsum(self.live)])[self.starts]


def expansion_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    """How many ids each rule stands for; a rule only names ids and rules before it."""
    lengths = np.ones(len(rules), np.int64)
    done = 0
    while done < len(rules):
        ready = (rules[done:] < base + done).all(axis=1)
        stop = done + (int(np.argmin(ready)) if not ready.all() else len(ready))
        part = rules[done:stop].astype(np.int64)
        known = lambda s: np.where(s < base, 1, lengths[np.maximum(s - base, 0)])
        lengths[done:stop] = known(part[:, 0]) + known(part[:, 1])
        done = stop
    return lengths


def expand(symbols: np.ndarray, rules: np.ndarray, base: int, lengths: np.ndarray | None = None) -> np.ndarray:
    """The ids that the symbols stand for; ``lengths`` are those of the rules."""
    lengths = expansion_lengths(rules, base) if lengths is None else lengths

    def sizes(of: np.ndarray) -> np.ndarray:
        found = np.ones(len(of), np.int64)
        is_rule = of >= base
        found[is_rule] = lengths[of[is_rule] - base]
        return found

    ends = np.cumsum(sizes(symbols))
    ids = np.empty(int(ends[-1]) if len(ends) else 0, np.uint32)
    places = np.concatenate([[0], ends[:-1]])[: len(symbols)]
    while len(symbols):
        is_rule = symbols >= base
        ids[places[~is_rule]] = symbols[~is_rule]
        pairs, places = rules[symbols[is_rule] - base], places[is_rule]
        places = np.concatenate([places, places + sizes(pairs[:, 0])])
        symbols = pairs.T.ravel()
    return ids


_AT_ONCE = 1 << 16


def _narrow(values: np.ndarray, width: int) -> bytes:
    """Values of ``width`` bits end to end."""
    out = []
    for part in np.split(values.astype("<u4").ravel(), range(_AT_ONCE, values.size, _AT_ONCE)):
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
        out.append(np.packbits(bits[:, :width], bitorder="little").tobytes())
    return b"".join(out)


def _widen(data: np.ndarray, n: int, width: int) -> np.ndarray:
    found = np.empty(n, np.uint32)
    for at in range(0, n, _AT_ONCE):
        size = min(_AT_ONCE, n - at)
        bits = np.zeros((size, 32), np.uint8)
        own = data[at * width // 8 :][: -(-size * width // 8)]
        bits[:, :width] = np.unpackbits(own, bitorder="little", count=size * width).reshape(size, width)
        found[at : at + size] = np.packbits(bits, axis=1, bitorder="little").view("<u4").ravel()
    return found


def pack(doc_ids: np.ndarray, ids: np.ndarray, starts: np.ndarray, nulls: int = 0) -> bytes:
    """One shard as bytes. ``starts`` has one entry per document and one for the end; the first ``nulls`` have no id."""
    symbols, places, rules, base = compress(ids, starts)
    width = (base + len(rules)).bit_length()
    head = _HEAD.pack(MAGIC, len(doc_ids), len(ids), len(symbols), len(rules), base, nulls)
    body = b"".join(
        (
            head,
            doc_ids.astype("<i8").tobytes(),
            starts.astype("<u4").tobytes(),
            places.astype("<u4").tobytes(),
            _narrow(rules, width),
            expansion_lengths(rules, base).astype("<u4").tobytes(),
            _narrow(symbols, width),
        )
    )
    return body + struct.pack("<I", zlib.crc32(body))


class Shard:
    """One shard read back; documents are decoded when asked for."""

    def __init__(self, payload: bytes):
        body, (crc,) = payload[:-4], struct.unpack("<I", payload[-4:])
        if body[:4] != MAGIC or zlib.crc32(body) != crc:
            raise ValueError("not a whole shard")
        _, docs, self.n_tokens, n_symbols, n_rules, base, self.nulls = _HEAD.unpack_from(body)
        self.base = base
        width = (base + n_rules).bit_length()
        at = _HEAD.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(body, kind, n, at)
            at += found.nbytes
            return found

        def wider(n: int) -> np.ndarray:
            return _widen(take("u1", -(-n * width // 8)), n, width)

        self.doc_ids = take("<i8", docs)
        self.starts = take("<u4", docs + 1).astype(np.int64)
        self.places = take("<u4", docs + 1).astype(np.int64)
        self.rules = wider(2 * n_rules).reshape(-1, 2)
        self.lengths = take("<u4", n_rules).astype(np.int64)
        self.symbols = wider(n_symbols)

    def all(self) -> np.ndarray:
        return expand(self.symbols, self.rules, self.base, self.lengths)

    def document(self, row: int) -> np.ndarray:
        own = self.symbols[self.places[row] : self.places[row + 1]]
        return expand(own, self.rules, self.base, self.lengths)

    def ids(self, row: int, first: int, last: int) -> np.ndarray:
        """Ids ``first`` to ``last`` (not included) of a document, expanding only symbols that touch them."""
        own = self.symbols[self.places[row] : self.places[row + 1]]
        if not len(own):
            return own
        sizes = np.ones(len(own), np.int64)
        is_rule = own >= self.base
        sizes[is_rule] = self.lengths[own[is_rule] - self.base]
        ends = np.cumsum(sizes)
        a, b = np.searchsorted(ends, first, side="right"), np.searchsorted(ends, last, side="left")
        before = int(ends[a - 1]) if a else 0
        return expand(own[a : b + 1], self.rules, self.base, self.lengths)[first - before : last - before]


# Byte-level BPE writes every byte as a visible character: those that are one stand for
# themselves, the others for the characters from U+0100 on, in order.
_VISIBLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_MARKS = {b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in _VISIBLE)}
_MARKED = "".join(chr(_MARKS.get(b, b)) for b in range(256))


class WordBpe:
    """A tokenizers file whose parts of a text at white space don't touch each other.

    The file's tokenizer must lower-case. A word's ASCII punctuation at its end is a part of its own
    where it follows a letter, and A-Z are lowered ahead, so that a word is encoded once whatever
    follows it; words with ``<`` stay as they are, since special tokens may stand in them.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.parts = PartIds(self._encode)
        byte = np.arange(256)
        self.letter = ((byte >= 65) & (byte <= 90)) | ((byte >= 97) & (byte <= 122))
        self.plain = (byte < 128) & (byte > 32) & ~self.letter & ~((byte >= 48) & (byte <= 57))

    def _encode(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the parts end to end, and how many each has.

        Parts of Latin letters alone are one word to the library: they are lowered and written in visible
        characters all at once, for its model alone. The others go through the whole tokenizer.
        """
        raw = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
        ends = np.flatnonzero(raw == 0x0A)
        starts = np.concatenate([[0], ends[:-1] + 1])
        lead = np.concatenate([[False], raw[:-1] == 0xC3])
        second = lead & (raw != 0x97) & (raw != 0xB7)  # all of U+00C0 to U+00FF but two are letters
        fine = self.letter[raw] | second
        fine[:-1] |= (raw[:-1] == 0xC3) & second[1:]
        fine[ends] = True
        word = np.logical_and.reduceat(fine, starts) & (ends > starts)
        lower = np.where(second & (raw >= 0x80) & (raw <= 0x9E), raw + np.uint8(0x20), LOWER[raw])

        body = lower[np.repeat(word, ends - starts + 1)]
        words = codecs.charmap_decode(body.tobytes(), "strict", _MARKED)[0].split(_MARKED[0x0A])[:-1]
        rows = list(map(self.tokenizer.model.tokenize, words))
        odd = self.tokenizer.encode_batch_fast(
            [parts[i].decode("utf-8") for i in np.flatnonzero(~word).tolist()], add_special_tokens=False
        )
        found = [r.ids for r in odd]
        lengths = np.empty(len(parts), np.int64)
        lengths[word] = np.fromiter(map(len, rows), np.int64, len(rows))
        lengths[~word] = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.empty(int(lengths.sum()), np.uint32)
        of_word = np.repeat(word, lengths)
        ids[of_word] = np.fromiter((t.id for row in rows for t in row), np.uint32, int(lengths[word].sum()))
        ids[~of_word] = np.fromiter(itertools.chain.from_iterable(found), np.uint32, int(lengths[~word].sum()))
        return ids, lengths

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and where each text starts."""
        words = Words(texts)
        starts, ends = words.starts, words.ends
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(words.offsets), np.int64)
        angle = np.zeros(len(starts), dtype=bool)
        angle[np.searchsorted(starts, np.flatnonzero(words.raw == 0x3C), side="right") - 1] = True
        raw = LOWER[words.raw]
        for a, b in zip(starts[angle].tolist(), ends[angle].tolist(), strict=True):
            raw[a:b] = words.raw[a:b]
        more = np.flatnonzero(self.plain[raw[ends - 1]] & ~angle)
        other = np.flatnonzero(~self.plain[raw])
        last = np.searchsorted(other, ends[more])
        core = np.concatenate([[0], other + 1])[last]
        before = raw[np.maximum(core - 1, 0)]
        two = raw[np.maximum(core - 2, 0)]
        latin = (two == 0xC3) & (before >= 0x80) & (before != 0x97) & (before != 0xB7)
        split = (core > starts[more]) & (self.letter[before] | latin)
        more, cut = more[split], core[split]
        at = np.insert(starts, more + 1, cut)
        to = np.insert(ends, more, cut)
        ids, lengths = self.parts.ids(raw, at, to)
        upto = np.concatenate([[0], np.cumsum(lengths)])
        return ids, upto[words.offsets + np.searchsorted(more, words.offsets)]


@functools.cache
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)


def with_end(ids: np.ndarray, starts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end_id`` after every document."""
    return np.insert(ids, starts[1:], end_id), starts + np.arange(len(starts))


SHARD_SCHEMA = "part int, shard int, n_docs int, n_tokens long, before long, payload binary"


def write_shards(
    docs: DataFrame,
    path: str,
    encoder: Callable[[], WordBpe],
    end_id: int = END_ID,
    shard_tokens: int = SHARD_TOKENS,
) -> None:
    """Encode ``doc_id, text`` in ascending ``doc_id`` order and write the shards under ``path``.

    Documents are dealt by ranges of ``doc_id`` and, where many rows have one, of their texts' hashes. Null
    texts are empty and get the end id alone; a null ``doc_id`` comes before all others and is read back
    as null; repeated ids stay as they are, in the order of those hashes. Other columns aren't read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_deal"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder()
        part, shard, before = TaskContext.get().partitionId(), 0, 0
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]] = []
        size = 0

        def shut() -> pa.RecordBatch:
            nonlocal shard, before, held, size
            docs_of = np.concatenate([h[0] for h in held])
            ids = np.concatenate([h[1] for h in held])
            starts = np.concatenate([[0], np.cumsum(np.concatenate([h[2] for h in held]))])
            payload = pack(docs_of, ids, starts, sum(h[3] for h in held))
            row = [[part], [shard], [len(docs_of)], [len(ids)], [before], [payload]]
            shard, before, held, size = shard + 1, before + len(ids), [], 0
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            names = ["part", "shard", "n_docs", "n_tokens", "before", "payload"]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(row, kinds, strict=True)], names
            )

        for batch in pieces(batches):
            ids, starts = with_end(*words.encode(batch.column("text")), end_id)
            column = batch.column("doc_id")
            nulls, doc_ids = column.null_count, column.fill_null(0).to_numpy()  # nulls come first
            first = 0
            while first < len(doc_ids):
                room = starts[first] + max(shard_tokens - size, 0)
                last = int(np.searchsorted(starts, room, side="right")) - 1
                last = max(last, first + (not held))
                if last > first:
                    sizes = np.diff(starts[first : last + 1])
                    own = max(min(nulls, last) - first, 0)
                    held.append((doc_ids[first:last], ids[starts[first] : starts[last]], sizes, own))
                    size += int(sizes.sum())
                    first = last
                if first < len(doc_ids):
                    yield shut()
        if held:
            yield shut()

    order = ["doc_id", "_deal", "text"]
    ordered = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order).drop("_deal")
    ordered.mapInArrow(run, SHARD_SCHEMA).write.parquet(path)


def read_shards(shards: DataFrame) -> DataFrame:
    """One row per document, all from the shards: ``doc_id, start, n_tokens, ids_crc32``.

    Where a part starts comes from the parts' totals: one row per part of the writing job.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard(batch.column("payload")[i].as_py())
                body = shard.all().astype("<u4").tobytes()
                a = shard.starts.tolist()
                crc = [zlib.crc32(body[4 * x : 4 * y]) for x, y in zip(a[:-1], a[1:], strict=True)]
                n = len(shard.doc_ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, batch.column("part")[i].as_py(), np.int32)),
                        pa.array(shard.doc_ids, mask=np.arange(n) < shard.nulls),
                        pa.array(shard.starts[:-1] + batch.column("before")[i].as_py()),
                        pa.array(np.diff(shard.starts)),
                        pa.array(crc, pa.int64()),
                    ],
                    ["part", "doc_id", "within", "n_tokens", "ids_crc32"],
                )

    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = totals.select(
        "part", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).cast("long").alias("first")
    )
    schema = "part int, doc_id long, within long, n_tokens long, ids_crc32 long"
    docs = shards.select("part", "before", "payload").mapInArrow(run, schema)
    return docs.join(firsts, "part").select(
        "doc_id", (F.col("first") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"
    )


def read_documents(shards: DataFrame) -> DataFrame:
    """``doc_id`` and its ids (array<int>), for readers who want the ids themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard(batch.column("payload")[i].as_py())
                flat = pa.array(shard.all().astype(np.int32))
                lists = pa.ListArray.from_arrays(shard.starts.astype(np.int32), flat)
                doc_ids = pa.array(shard.doc_ids, mask=np.arange(len(shard.doc_ids)) < shard.nulls)
                yield pa.RecordBatch.from_arrays([doc_ids, lists], ["doc_id", "ids"])

    return shards.select("payload").mapInArrow(run, "doc_id long, ids array<int>")
