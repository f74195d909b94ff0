"""Collocations: phrases of two and three words that stand together more often than their parts suggest.

Words and pieces are those of the query's contract: A-Z are lowered, ``.,;:!?`` and line ends part
pieces, spaces and tabs part words; a phrase lies in one piece. Everything is per language.

1. Words are counted exactly. A count-min sketch over all pairs of neighbours, then one over the
   triples whose two pairs may be frequent, say which phrases may have ``least`` occurrences. A sketch
   never counts too little and a phrase is never more frequent than its parts, so the candidates
   miss none (Apriori).
   Each is found out by its hash alone, together with one document that holds it, which then gives its words.
2. Candidates are put in a double-array trie over the two digits of words' numbers: a state ``s`` has a
   child for digit ``c`` at slot ``base[s] + c`` if ``owner`` of that slot is ``s``. The trie is broadcast.
   Its size has a bound (``MOST_PHRASES``); where there are more candidates, it holds those with the highest estimates, and
   the others' occurrences, few each, are added up by key in the same pass.
3. Every task advances the states of all positions of a batch together, word by word, and counts the
   accepting states by ``bincount``; the counts of the tasks, the shards, are summed by block of states.
4. Scores are exact decimals. Lists of the best are cut by language and salt first, then by language.

Defined results: null texts are empty; a null ``lang`` is ``und``, and one list with a language of that
name; rows count as often as they stand, whatever their ``doc_id``; equal scores and counts are
ordered by the phrase's UTF-8 bytes; an empty table gives an empty result. Other columns aren't read.
Words are compared by 64-bit hashes within their language.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.llm import sketch
from tallybook.llm.words import LOWER, mixed, pieces, span_bytes, span_hashes, text_bytes
from tallybook.session import materialise

LEAST = 10
LONGEST = 3
COVERED_PERCENT = 50
BEST = 2_000
MOST_PHRASES = 1_500_000
"""Phrases in the broadcast trie: some 50 MB in a task at most."""
HELD = 1_000_000
"""Different words or phrases that a task holds before it sends them."""
BLOCK_STATES = 1 << 16
BLOCK_BYTES = 32 << 20
"""Text for each block of candidates, about."""
SALTS = 64

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_CUTS = np.zeros(256, dtype=bool)
_CUTS[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = True
_GAPS = _CUTS.copy()
_GAPS[[0x20, 0x09]] = True


class Phrases:
    """The words of a batch: where they are, in which piece, and their hashes by language."""

    def __init__(self, batch: pa.RecordBatch):
        raw, at = text_bytes(batch.column("text"))
        self.raw, self.at = LOWER[raw], at
        self.tag = (batch.column("tag").to_numpy().view(np.uint64) >> np.uint64(32)).astype(np.uint32)
        langs = batch.column("lang").dictionary_encode()
        self.langs = langs.dictionary.to_pylist()
        lang_raw, lang_at = text_bytes(langs.dictionary)
        seeds = mixed(span_hashes(lang_raw, lang_at[:-1], lang_at[1:], 1) + _GOLD)
        inside = ~_GAPS[raw]
        edge = np.ones(len(raw) + 1, dtype=bool)
        edge[1:] = ~inside
        edge[at] = True
        self.starts = np.flatnonzero(inside & edge[:-1])
        last = np.ones(len(raw), dtype=bool)
        last[:-1] = edge[1:-1] | ~inside[1:]
        last[at[1:][at[1:] > 0] - 1] = True
        self.ends = np.flatnonzero(inside & last) + 1
        row = np.searchsorted(at, self.starts, side="right") - 1
        self.lang = langs.indices.to_numpy()[row]
        piece = np.cumsum(_CUTS[raw], dtype=np.int32)[self.starts] if len(self.starts) else row
        self.hashes = mixed(span_hashes(self.raw, self.starts, self.ends) ^ seeds[self.lang])
        self.joined = (row[1:] == row[:-1]) & (piece[1:] == piece[:-1])
        """Whether each word but the last has the next one in its piece."""

    def __len__(self) -> int:
        return len(self.starts)

    def spans(self, first: np.ndarray, words: int) -> list[str]:
        """The phrases of so many words from the given words on, their words joined by one space."""
        parts = [span_bytes(self.raw, self.starts[first + k], self.ends[first + k]) for k in range(words)]
        return [b" ".join(x).decode("utf-8") for x in zip(*parts, strict=True)]

    def tags(self, first: np.ndarray) -> np.ndarray:
        """The tags of the documents of some words."""
        return self.tag[np.searchsorted(self.at, self.starts[first], side="right") - 1]

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """First words of all pairs of neighbours, and a hash of each."""
        first = np.flatnonzero(self.joined)
        return first, pair_hash(self.hashes[first], self.hashes[first + 1])

    def triples(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First words of the triples both of whose pairs are among those given, and a hash of each."""
        there = np.zeros(len(self), dtype=bool)
        there[pairs] = True
        first = np.flatnonzero(there[:-1] & there[1:])
        return first, pair_hash(pair_hash(self.hashes[first], self.hashes[first + 1]), self.hashes[first + 2])


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mixed((a ^ (a >> np.uint64(29))) * _GOLD + b)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[Phrases]:
    for batch in pieces(batches):
        found = Phrases(batch)
        if len(found):
            yield found


def word_counts(rows: DataFrame) -> DataFrame:
    """``lang, word, hash, f``: how often each word stands in each language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts, names, langs = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], []

        def out() -> pa.RecordBatch:
            columns = [pa.array(langs, pa.string()), pa.array(names, pa.string()), pa.array(hashes.view(np.int64)), pa.array(counts)]
            return pa.RecordBatch.from_arrays(columns, ["lang", "word", "hash", "f"])

        for found in _batches(batches):
            new, first, n = np.unique(found.hashes, return_index=True, return_counts=True)
            at, fresh = _places(hashes, new)
            counts[at[~fresh]] += n[~fresh]
            if fresh.any():
                where = first[fresh]
                hashes, order = _merged(hashes, new[fresh])
                counts = np.concatenate([counts, n[fresh]])[order]
                names += found.spans(where, 1)
                langs += [found.langs[i] for i in found.lang[where].tolist()]
                names, langs = [names[i] for i in order.tolist()], [langs[i] for i in order.tolist()]
            if len(hashes) >= HELD:
                yield out()
                hashes, counts, names, langs = hashes[:0], counts[:0], [], []
        if len(hashes):
            yield out()

    partial = rows.mapInArrow(run, "lang string, word string, hash long, f long")
    return partial.groupBy("lang", "word", "hash").agg(F.sum("f").alias("f"))


def _places(known: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each wanted value is in the ascending known ones, and whether it is missing."""
    at = np.searchsorted(known, wanted)
    missing = np.ones(len(wanted), dtype=bool)
    inside = at < len(known)
    missing[inside] = known[at[inside]] != wanted[inside]
    return at, missing


def _merged(known: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in ascending order, and the order that makes it."""
    both = np.concatenate([known, new])
    order = np.argsort(both, kind="stable")
    return both[order], order


class Filter:
    """Which pairs and triples may be frequent, by two sketches, and how often about."""

    def __init__(self, pairs: sketch.Sketch, triples: sketch.Sketch):
        self.sketches = (pairs, triples)

    def phrases(self, found: Phrases) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Words in the phrase, first words, hashes, and levels of all occurrences of candidates."""
        first, hashes = found.pairs()
        for words, met in zip((2, 3), self.sketches, strict=True):
            if words == 3:
                first, hashes = found.triples(first)
            hit = met.repeated(hashes)
            first, hashes = first[hit], hashes[hit]
            yield words, first, hashes, met.level(hashes)


def _filter(rows: DataFrame, total: int, least: int) -> Filter:
    spark = rows.sparkSession
    expected = total // 48 + 1

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for found in _batches(batches):
            yield found.pairs()[1]

    met = sketch.build(rows, pairs, expected, least=least)
    sent = spark.sparkContext.broadcast(met)

    def triples(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for found in _batches(batches):
            first, hashes = found.pairs()
            yield found.triples(first[sent.value.repeated(hashes)])[1]

    more = sketch.build(rows, triples, expected, least=least)
    sent.destroy()
    return Filter(met, more)


def candidates(rows: DataFrame, filtered, blocks: int) -> DataFrame:
    """One row per phrase that may be frequent: ``hash, words, level, tag``; the level is log2 of about how often
    it stands, the tag that of one document with it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(np.zeros(0, np.uint64), np.zeros(0, np.uint32))] * 2

        def out() -> Iterator[pa.RecordBatch]:
            for words, (hashes, tags) in enumerate(held, start=2):
                block = hashes % np.uint64(blocks)
                order = np.argsort(block, kind="stable")
                edges = np.searchsorted(block[order], np.arange(blocks + 1))
                for b in np.flatnonzero(np.diff(edges)).tolist():
                    own = order[edges[b] : edges[b + 1]]
                    body = np.diff(hashes[own], prepend=np.uint64(0)).tobytes() + tags[own].tobytes()
                    columns = [pa.array([x], pa.int32()) for x in (b, words, len(own))]
                    columns.append(pa.array([pa.compress(body, codec="zstd", asbytes=True)], pa.binary()))
                    yield pa.RecordBatch.from_arrays(columns, ["block", "words", "n", "body"])

        for found in _batches(batches):
            for words, first, hashes, _ in filtered.value.phrases(found):
                known, tags = held[words - 2]
                held[words - 2] = _least_tags(np.concatenate([known, hashes]), np.concatenate([tags, found.tags(first)]))
            if max(len(h) for h, _ in held) >= HELD:
                yield from out()
                held = [(h[:0], t[:0]) for h, t in held]
        yield from out()

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = (-1, -1), []

        def out() -> pa.RecordBatch:
            hashes, tags = _least_tags(*(np.concatenate(x) for x in zip(*held, strict=True)))
            level = filtered.value.sketches[current[1] - 2].level(hashes).astype(np.int32)
            columns = [hashes.view(np.int64), np.full(len(hashes), current[1], np.int32), level, tags.astype(np.int64)]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["hash", "words", "level", "tag"])

        for batch in batches:
            for block, words, n, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (block, words) != current:
                    if held:
                        yield out()
                    current, held = (block, words), []
                data = pa.decompress(body, 12 * n, codec="zstd", asbytes=True)
                held.append((np.cumsum(np.frombuffer(data, "<u8", n)), np.frombuffer(data, "<u4", n, 8 * n)))
        if held:
            yield out()

    found = rows.mapInArrow(run, "block int, words int, n int, body binary")
    dealt = found.repartition("block", "words").sortWithinPartitions("block", "words")
    return dealt.mapInArrow(distinct, "hash long, words int, level int, tag long")


def _least_tags(hashes: np.ndarray, tags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes in order, and the least tag of each."""
    order = np.argsort(hashes, kind="stable")
    hashes, tags = hashes[order], tags[order]
    edge = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])[: len(hashes)])
    return hashes[edge], np.minimum.reduceat(tags, edge) if len(edge) else tags


_PHRASE = "lang string, words int, phrase string, hash long, part1 long, part2 long, part3 long, a long"
_NAMES = [x.split()[0] for x in _PHRASE.split(", ")]


def _described(found: Phrases, first: np.ndarray, words: int, hashes: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """Rows of ``_PHRASE`` for the phrases that start at some words."""
    parts = [found.hashes[first + k].view(np.int64) for k in range(words)]
    parts += [np.zeros(len(first), np.int64)] * (LONGEST - words)
    columns = [
        pa.array([found.langs[i] for i in found.lang[first].tolist()], pa.string()),
        pa.array(np.full(len(first), words, np.int32)),
        pa.array(found.spans(first, words), pa.string()),
        pa.array(hashes.view(np.int64)),
        *map(pa.array, parts),
        pa.array(counts),
    ]
    return pa.RecordBatch.from_arrays(columns, _NAMES)


def described(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """The words of the chosen phrases (a bounded number), each from documents of its tag."""
    table = chosen.select("hash", "words", "tag").toArrow()
    hashes, words = table.column("hash").to_numpy().view(np.uint64), table.column("words").to_numpy()
    order = np.lexsort((hashes, words))
    parts = np.split(order, [int((words == 2).sum())])
    tags = table.column("tag").to_numpy()
    sent = rows.sparkSession.sparkContext.broadcast([(hashes[x], tags[x].astype(np.uint32)) for x in parts])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _batches(batches):
            first, hashes = found.pairs()
            for words, (known, tags) in enumerate(sent.value, start=2):
                if words == 3:
                    first, hashes = found.triples(first)
                at, missing = _places(known, hashes)
                there = np.flatnonzero(~missing)
                there = there[tags[at[there]] == found.tags(first[there])]
                distinct, one = np.unique(hashes[there], return_index=True)
                if len(distinct):
                    yield _described(found, first[there[one]], words, distinct, np.zeros(len(one), np.int64))

    return rows.mapInArrow(run, _PHRASE).drop("a").dropDuplicates(["hash", "words"])


class Trie:
    """A double-array trie of phrases over the numbers of their words, each written as two digits.

    Slots ``0 .. n - 1`` are kept for the states after one word; those that no phrase begins with are
    free for others. ``owner`` is -1 where a slot is free and -2 where its parent is the root.
    """

    WINDOW = 4096
    """Bases that are tried at a time."""

    def __init__(self, phrases: list[np.ndarray]):
        """``phrases`` has word hashes, a row each: those of two words, then those of three."""
        self.words = np.unique(np.concatenate([x.ravel() for x in phrases]))
        self.n = len(self.words)
        self.bits = max(1, (self.n.bit_length() + 1) // 2)
        pairs, triples = (np.searchsorted(self.words, x) for x in phrases)
        self.owner = np.full(self.n, -1, np.int64)
        self.base = np.zeros(self.n, np.int64)
        two = np.concatenate([pairs, triples[:, :2]])
        self.owner[two[:, 0]] = -2
        self.begins = self.owner == -2
        state = self._child(two[:, 0], two[:, 1])
        third = self._child(state[len(pairs) :], triples[:, 2])
        self.accepting = np.concatenate([state[: len(pairs)], third])
        self.slots = int(np.flatnonzero(self.owner != -1)[-1]) + 1
        self.owner = self.owner[: self.slots].astype(np.int32)
        self.base = self.base[: self.slots].astype(np.int32)

    def _child(self, state: np.ndarray, word: np.ndarray) -> np.ndarray:
        """New states after one more word, as many as differ, for each phrase."""
        for digit in (word >> self.bits, word & ((1 << self.bits) - 1)):
            keys, number = np.unique((state << self.bits) | digit, return_inverse=True)
            state = self._place(keys >> self.bits, keys & ((1 << self.bits) - 1))[number]
        return state

    def _grow(self, slots: int) -> None:
        if slots > len(self.owner):
            more = max(slots, len(self.owner) * 5 // 4) - len(self.owner)
            self.owner = np.concatenate([self.owner, np.full(more, -1, np.int64)])
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])

    def _place(self, parent: np.ndarray, digit: np.ndarray) -> np.ndarray:
        """Slots for children in order of their parents: parents with most go first, each where it first fits."""
        edge = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]])[: len(parent)])
        sizes = np.diff(np.concatenate([edge, [len(parent)]]))
        slots = np.empty(len(parent), np.int64)
        order = np.argsort(-sizes, kind="stable")
        several = order[sizes[order] > 1]
        free = self.owner == -1
        start = kind = 0
        for i, size in zip(several.tolist(), sizes[several].tolist(), strict=True):
            if size.bit_length() != kind:
                start, kind = 0, size.bit_length()
            own = slice(edge[i], edge[i] + size)
            shift = digit[own] - digit[edge[i]]
            while True:
                self._grow(start + self.WINDOW + (1 << self.bits))
                if len(free) < len(self.owner):
                    free = np.concatenate([free, np.ones(len(self.owner) - len(free), dtype=bool)])
                fits = free[start : start + self.WINDOW].copy()
                for s in shift[1:].tolist():
                    fits &= free[start + s : start + s + self.WINDOW]
                at = int(fits.argmax())
                if fits[at]:
                    break
                start += self.WINDOW
            slots[own] = start + at + shift
            free[slots[own]] = False
        single = order[sizes[order] == 1]
        self._grow(len(free) + max(0, len(single) - int(free.sum())))
        free = np.concatenate([free, np.ones(len(self.owner) - len(free), dtype=bool)])
        slots[edge[single]] = np.flatnonzero(free)[: len(single)]
        self.owner[slots] = parent
        self.base[parent[edge]] = slots[edge] - digit[edge]
        return slots

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word; -1 for one that no phrase has."""
        at = np.minimum(np.searchsorted(self.words, hashes), self.n - 1)
        return np.where(self.words[at] == hashes, at, -1)

    def first(self, numbers: np.ndarray) -> np.ndarray:
        """The state of each position after its own word; -1 where there is none."""
        return np.where((numbers >= 0) & self.begins[numbers], numbers, -1)

    def step(self, states: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """The state of each position after one more word; -1 where there is none."""
        at = np.flatnonzero((states >= 0) & (numbers >= 0))
        state = states[at]
        for shift in (self.bits, 0):
            slot = self.base[state] + ((numbers[at] >> shift) & ((1 << self.bits) - 1))
            there = (slot >= 0) & (slot < self.slots)
            there[there] = self.owner[slot[there]] == state[there]
            at, state = at[there], slot[there]
        found = np.full(len(states), -1, np.int64)
        found[at] = state
        return found


def _chosen(phrases: DataFrame, most: int) -> DataFrame:
    """At most about ``most`` of the phrases: those with the highest levels, of the last level a share by hash."""
    counts = dict(phrases.groupBy("level").agg(F.count(F.lit(1))).collect())
    room = most
    for level in sorted(counts, reverse=True):
        if counts[level] > room:
            steps = 1 << 30
            share = F.pmod(F.xxhash64("hash", "words"), F.lit(steps)) < int(steps * room / counts[level])
            return phrases.filter((F.col("level") > level) | ((F.col("level") == level) & share))
        room -= counts[level]
    return phrases


def phrase_counts(rows: DataFrame, phrases: DataFrame, filtered) -> DataFrame:
    """``_PHRASE``: occurrences of all candidates; those of ``phrases`` (described, bounded) by a trie."""
    spark = rows.sparkSession
    chosen = phrases.select("words", "hash", "part1", "part2", "part3").toArrow()
    hashes, words = chosen.column("hash").to_numpy().view(np.uint64), chosen.column("words").to_numpy()
    order = np.lexsort((hashes, words))
    hashes, n_pairs = hashes[order], int((words == 2).sum())
    parts = np.stack([chosen.column(f"part{k}").to_numpy()[order] for k in (1, 2, 3)], axis=1).view(np.uint64)
    trie = Trie([parts[:n_pairs, :2], parts[n_pairs:]]) if len(hashes) else None
    del chosen, parts
    sent = spark.sparkContext.broadcast((trie, hashes, n_pairs))
    blocks = -(-trie.slots // BLOCK_STATES) if trie is not None else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, known, n_pairs = sent.value
        own = {2: known[:n_pairs], 3: known[n_pairs:]}
        counts = np.zeros(blocks * BLOCK_STATES, np.int64)
        for found in _batches(batches):
            if trie is not None:
                numbers = trie.numbers(found.hashes)
                state = trie.first(numbers)
                for words in range(2, LONGEST + 1):
                    goes_on = np.zeros(len(found), dtype=bool)
                    goes_on[: max(len(found) - words + 1, 0)] = found.joined[words - 2 :]
                    following = np.concatenate([numbers[words - 1 :], np.full(words, -1)])[: len(numbers)]
                    state = trie.step(np.where(goes_on, state, -1), following)
                    counts += np.bincount(state[state >= 0], minlength=len(counts))
            for words, first, hashes, _ in filtered.value.phrases(found):
                rest = np.flatnonzero(_places(own[words], hashes)[1])
                other, one, n = np.unique(hashes[rest], return_index=True, return_counts=True)
                if len(other):
                    yield _counted_row(_described(found, first[rest[one]], words, other, n))
        for block in range(blocks):
            part = counts[block * BLOCK_STATES : (block + 1) * BLOCK_STATES]
            if part.any():
                yield _counted_block(block, part)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, known, n_pairs = sent.value
        order = np.argsort(trie.accepting)
        states = trie.accepting[order]
        current, summed = -1, np.zeros(BLOCK_STATES, np.int64)

        def out() -> pa.RecordBatch:
            low, high = np.searchsorted(states, np.array([current, current + 1]) * BLOCK_STATES)
            a = summed[states[low:high] - current * BLOCK_STATES]
            which = order[low:high]
            words = np.where(which < n_pairs, 2, 3).astype(np.int32)
            columns = [pa.array(known[which].view(np.int64)), pa.array(words), pa.array(a)]
            return pa.RecordBatch.from_arrays(columns, ["hash", "words", "a"])

        for batch in batches:
            for block, body in zip(*(batch.column(c).to_pylist() for c in ("block", "body")), strict=True):
                if block != current:
                    if current >= 0:
                        yield out()
                    current, summed = block, np.zeros(BLOCK_STATES, np.int64)
                summed += np.frombuffer(pa.decompress(body, 8 * BLOCK_STATES, codec="zstd"), "<i8")
        if current >= 0:
            yield out()

    sums, _ = materialise(rows.mapInArrow(run, f"block int, body binary, {_PHRASE}"), "phrase-counts")
    rest = sums.filter("block IS NULL").groupBy(*_NAMES[:-1]).agg(F.sum("a").alias("a"))
    if trie is None:
        return rest
    dealt = sums.filter("block IS NOT NULL").select("block", "body").repartition("block").sortWithinPartitions("block")
    by_trie = dealt.mapInArrow(total, "hash long, words int, a long")
    return phrases.join(by_trie, ["hash", "words"]).select(*_NAMES).unionByName(rest)


def _counted_row(phrases: pa.RecordBatch) -> pa.RecordBatch:
    n = phrases.num_rows
    columns = [pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), *phrases.columns]
    return pa.RecordBatch.from_arrays(columns, ["block", "body", *_NAMES])


def _counted_block(block: int, counts: np.ndarray) -> pa.RecordBatch:
    body = pa.compress(counts.astype("<i8").tobytes(), codec="zstd", asbytes=True)
    kinds = [pa.string(), pa.int32(), pa.string(), *[pa.int64()] * 5]
    columns = [pa.array([block], pa.int32()), pa.array([body], pa.binary()), *(pa.nulls(1, k) for k in kinds)]
    return pa.RecordBatch.from_arrays(columns, ["block", "body", *_NAMES])


def _score(a: str, left: str, right: str) -> Column:
    """floor(1,000,000 a² / (left right)), exactly."""
    big = "CAST({} AS DECIMAL(15, 0))".format
    top = f"CAST(1000000 AS DECIMAL(7, 0)) * ({big(a)} * {big(a)})"
    return F.expr(f"CAST(({top}) div ({big(left)} * {big(right)}) AS BIGINT)")


def best(docs: DataFrame, least: int = LEAST, most_in_trie: int = MOST_PHRASES, most: int = BEST) -> DataFrame:
    """The best ``most`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``."""
    rows = _rows(docs)
    words, _ = materialise(word_counts(rows), "words")
    kept = scored(rows, words, least, most_in_trie)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    first = kept.withColumn("salt", salt)
    first = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
    first = first.filter(F.col("rank") <= most)
    last = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    last = last.filter(F.col("rank") <= most).join(words.groupBy("lang").agg(F.sum("f").alias("n")), "lang")
    return last.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _rows(docs: DataFrame) -> DataFrame:
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    return docs.select("text", lang.alias("lang"), F.xxhash64("text").alias("tag"))


def scored(rows: DataFrame, words: DataFrame, least: int = LEAST, most_in_trie: int = MOST_PHRASES) -> DataFrame:
    """All candidates of ``rows`` (``text, lang, tag``) that no longer one covers, with their cut: ``lang, phrase, a,
    l, r, score``. ``words`` are the ``word_counts`` of the same rows."""
    spark = rows.sparkSession
    total = int(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    filtered = spark.sparkContext.broadcast(_filter(rows, total, least))
    found, _ = materialise(candidates(rows, filtered, max(64, total // BLOCK_BYTES)), "candidates")
    phrases, _ = materialise(described(rows, _chosen(found, most_in_trie)), "described")
    frequent = phrase_counts(rows, phrases, filtered).filter(F.col("a") >= least)
    frequent, _ = materialise(frequent, "phrases")

    pairs = frequent.filter("words = 2").select("lang", "phrase", "a", "part1", "part2")
    triples = frequent.filter("words = 3").select("lang", "phrase", "a", "part1", "part2", "part3")
    frequent_words = words.filter(F.col("f") >= least).select(F.col("hash").alias("part"), "f")
    single = functools.partial(_counted, frequent_words)
    double = functools.partial(_counted_pairs, pairs)

    two = single(single(pairs, "part1", "l"), "part2", "r")
    two = two.withColumn("score", _score("a", "l", "r"))
    three = single(single(triples, "part1", "l1"), "part3", "r2")
    three = double(double(three, "part1", "part2", "l2"), "part2", "part3", "r1")
    three = three.withColumns({"s1": _score("a", "l1", "r1"), "s2": _score("a", "l2", "r2")})
    first = F.col("s1") <= F.col("s2")
    three = three.withColumns(
        {
            "l": F.when(first, F.col("l1")).otherwise(F.col("l2")),
            "r": F.when(first, F.col("r1")).otherwise(F.col("r2")),
            "score": F.least("s1", "s2"),
        }
    )
    longer = triples.select("lang", F.col("part1").alias("x"), F.col("part2").alias("y"), "a").unionByName(
        triples.select("lang", F.col("part2").alias("x"), F.col("part3").alias("y"), "a")
    )
    longer = longer.groupBy("lang", "x", "y").agg(F.max("a").alias("longest"))
    covered = (two.lang == longer.lang) & (two.part1 == longer.x) & (two.part2 == longer.y)
    covered &= 100 * longer.longest >= COVERED_PERCENT * two.a
    columns = ["lang", "phrase", "a", "l", "r", "score"]
    return two.join(longer, covered, "left_anti").select(*columns).unionByName(three.select(*columns))


def _counted(words: DataFrame, phrases: DataFrame, part: str, name: str) -> DataFrame:
    return phrases.join(words.withColumnsRenamed({"part": part, "f": name}), part)


def _counted_pairs(pairs: DataFrame, phrases: DataFrame, first: str, second: str, name: str) -> DataFrame:
    found = pairs.select(F.col("lang"), F.col("part1").alias("x"), F.col("part2").alias("y"), F.col("a").alias(name))
    found = found.select("lang", F.col("x").alias(first), F.col("y").alias(second), name)
    return phrases.join(found, ["lang", first, second])


def oracle() -> str:
    """DuckDB SQL for ``best`` over ``documents``."""
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({lowered}, '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
grams AS (
  SELECT lang, k, unnest(list_transform(range(len(ws) - k + 1), lambda i: ws[i + 1 : i + k])) AS g
  FROM split, (SELECT unnest([1, 2, 3]) AS k) WHERE len(ws) >= k),
counts AS MATERIALIZED (SELECT lang, k, g, count(*)::HUGEINT AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f)::HUGEINT AS n FROM counts WHERE k = 1 GROUP BY lang),
places AS (
  SELECT lang, k, g, f AS a, j, g[1 : j] AS p, g[j + 1 : k] AS q
  FROM counts, (SELECT unnest([1, 2]) AS j) WHERE k > j AND f >= {LEAST}),
lefts AS MATERIALIZED (
  SELECT places.*, counts.f AS l FROM places JOIN counts ON counts.lang = places.lang AND counts.g = places.p),
cuts AS (
  SELECT lefts.*, counts.f AS r, 1000000 * a * a // (l * counts.f) AS score
  FROM lefts JOIN counts ON counts.lang = lefts.lang AND counts.g = lefts.q),
candidates AS (
  SELECT lang, k, g, a, arg_min(l, (score, j)) AS l, arg_min(r, (score, j)) AS r, min(score) AS score
  FROM cuts GROUP BY lang, k, g, a),
longer AS (
  SELECT lang, unnest([g[1 : 2], g[2 : 3]]) AS g, a FROM candidates WHERE k = 3),
covered AS (
  SELECT DISTINCT c.lang, c.g FROM candidates c JOIN longer b ON b.lang = c.lang AND b.g = c.g
  WHERE 100 * b.a >= {COVERED_PERCENT} * c.a),
ranked AS (
  SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score,
    row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank
  FROM candidates ANTI JOIN covered USING (lang, g))
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= {BEST}
"""
