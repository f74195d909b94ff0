"""Documents that hold items of a benchmark, found by BM25 retrieval and checked word by word.

The items are indexed: term -> postings of items with BM25 impacts, in blocks of ``BLOCK`` items with
the largest impact of each block. An item's impacts are divided by its score against itself, so
every score is the part of the item's weight that a passage holds, from 0 to 1, and one threshold
serves all items. Every passage of every document (overlapping runs of words, long enough that each
item fits in one) is a query. As in block-max WAND, the block maxima of a passage's terms are summed
first; blocks that cannot reach the threshold are skipped, the others are scored exactly; all items
at or above ``THRESHOLD`` are retrieved. The queries of a batch run together as array operations.

A retrieved item counts when the passage holds at least ``QUESTION`` of the distinct word n-grams of
its question and ``ANSWER`` of those of its answer. The answer is the last third of the item's words.

The index is built on the driver and broadcast in parts of at most ``INDEX_BYTES`` of item text.

Defined results: words are compared in lower case (A-Z); null and empty texts match nothing, and items
without words are no items; rows that share an ``item_id`` are items of their own under one id, and
results name each pair once; equal scores need no order, as nothing is cut off; an empty benchmark
matches nothing.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.parts import ranges
from tallybook.llm.words import Words, pieces, window_hashes

K1, B = 1.2, 0.75
BLOCK = 16
SHARD_ITEMS = 1_024
"""Items whose block maxima stand in one table (terms x 64 blocks)."""
THRESHOLD = 0.5
QUESTION = 0.5
ANSWER = 0.5
GRAM = 3
LEAST_STRIDE = 64
INDEX_BYTES = 32 << 20


def _grams(hashes: np.ndarray) -> np.ndarray:
    """Distinct n-grams of a run of words; a shorter run is one n-gram."""
    return np.unique(window_hashes(hashes, min(GRAM, len(hashes)))) if len(hashes) else hashes


@dataclass
class Item:
    item_id: int
    hashes: np.ndarray

    @functools.cached_property
    def cut(self) -> int:
        """Number of words of the question."""
        return len(self.hashes) - max(len(self.hashes) // 3, 1)

    @functools.cached_property
    def question(self) -> np.ndarray:
        return _grams(self.hashes[: self.cut])

    @functools.cached_property
    def answer(self) -> np.ndarray:
        return _grams(self.hashes[self.cut :])

    def held_by(self, passage: np.ndarray) -> tuple[float, float]:
        """Parts of the question's and the answer's n-grams that a passage has."""
        found = []
        for grams, words in ((self.question, self.cut), (self.answer, len(self.hashes) - self.cut)):
            if not len(grams):
                found.append(1.0)
                continue
            own = window_hashes(passage, min(GRAM, words))
            found.append(float(np.isin(grams, own).mean()))
        return found[0], found[1]


class Shard:
    """Inverted index of at most ``SHARD_ITEMS`` items."""

    def __init__(self, items: list[Item], terms: np.ndarray, impacts: list[tuple[np.ndarray, np.ndarray]]):
        self.items = items
        item = np.repeat(np.arange(len(items)), [len(t) for t, _ in impacts])
        term = np.searchsorted(terms, np.concatenate([t for t, _ in impacts]))
        impact = np.concatenate([i for _, i in impacts])
        order = np.lexsort((item, term))
        self.item, self.impact = item[order], impact[order]
        self.starts = np.searchsorted(term[order], np.arange(len(terms) + 1))
        self.maxima = np.zeros((len(terms), -(-len(items) // BLOCK)))
        np.maximum.at(self.maxima, (term, item // BLOCK), impact)

    def retrieve(self, passage: np.ndarray, term: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of passage and item at or above the threshold, from distinct (passage, term) in order."""
        none = np.zeros(0, np.int64)
        if not len(passage):
            return none, none
        at = np.searchsorted(passage, np.arange(n + 1))
        filled = np.flatnonzero(np.diff(at))
        bounds = np.add.reduceat(self.maxima[term], at[filled], axis=0)
        alive = bounds >= THRESHOLD - 1e-9
        keep = filled[alive.any(axis=1)]
        if not len(keep):
            return none, none
        blocks = np.zeros((n, self.maxima.shape[1]), dtype=bool)
        blocks[filled] = alive
        own = ranges(at[keep], at[keep + 1] - at[keep])
        passage, term = passage[own], term[own]
        lengths = self.starts[term + 1] - self.starts[term]
        place = ranges(self.starts[term], lengths)
        item, of = self.item[place], np.repeat(passage, lengths)
        live = blocks[of, item // BLOCK]
        key, number = np.unique(of[live] * len(self.items) + item[live], return_inverse=True)
        score = np.bincount(number, weights=self.impact[place][live])
        hit = key[score >= THRESHOLD - 1e-9]
        return hit // len(self.items), hit % len(self.items)


class Index:
    """All items of one part of the benchmark; ``corpus`` has the statistics of the whole of it."""

    def __init__(self, ids: list[int], texts: list[str], corpus: Corpus):
        words = Words(pa.array(texts, pa.string()), lower=True)
        hashes = words.hashes()
        lists = np.split(hashes, words.offsets[1:-1]) if texts else []
        items = [Item(i, h) for i, h in zip(ids, lists, strict=True) if len(h)]
        self.terms = np.unique(np.concatenate([i.hashes for i in items] or [np.zeros(0, np.uint64)]))
        self.stride = max(LEAST_STRIDE, corpus.longest)
        self.shards = []
        for first in range(0, len(items), SHARD_ITEMS):
            own = items[first : first + SHARD_ITEMS]
            self.shards.append(Shard(own, self.terms, [corpus.impacts(i.hashes) for i in own]))

    def matches(self, texts: pa.Array) -> Iterator[tuple[int, int, float, float]]:
        """Row, item id, and the parts of question and answer, for every passage that holds an item."""
        if not self.shards:
            return
        words = Words(texts, lower=True)
        hashes = words.hashes()
        known = np.searchsorted(self.terms, hashes)
        known[known == len(self.terms)] = 0
        at = np.flatnonzero(self.terms[known] == hashes)
        counts = words.counts
        passages = np.maximum(-(-(counts - self.stride) // self.stride), 1)
        first = np.concatenate([[0], np.cumsum(passages)])
        owner = words.owners()[at]
        step = (at - words.offsets[owner]) // self.stride
        later = first[owner] + np.minimum(step, passages[owner] - 1)
        earlier = first[owner] + np.maximum(step - 1, 0)
        key = np.concatenate([later, earlier]) * len(self.terms) + np.concatenate([known[at], known[at]])
        key = np.unique(key)
        passage, term = key // len(self.terms), key % len(self.terms)
        for shard in self.shards:
            for p, i in zip(*(x.tolist() for x in shard.retrieve(passage, term, int(first[-1]))), strict=True):
                row = int(np.searchsorted(first, p, side="right")) - 1
                start = words.offsets[row] + (p - first[row]) * self.stride
                stop = min(start + 2 * self.stride, words.offsets[row + 1])
                question, answer = shard.items[i].held_by(hashes[start:stop])
                if question >= QUESTION - 1e-9 and answer >= ANSWER - 1e-9:
                    yield row, shard.items[i].item_id, question, answer


@dataclass
class Corpus:
    """BM25 statistics of the whole benchmark."""

    n: int
    mean: float
    longest: int
    terms: np.ndarray
    df: np.ndarray

    @classmethod
    def of(cls, batches: Iterator[list[str]]) -> Corpus:
        n = total = longest = 0
        terms, df = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for texts in batches:
            words = Words(pa.array(texts, pa.string()), lower=True)
            counts = words.counts
            n, total = n + int((counts > 0).sum()), total + len(words)
            longest = max(longest, int(counts.max(initial=0)))
            pair = np.unique(np.stack([words.owners().astype(np.uint64), words.hashes()]), axis=1)
            found = np.concatenate([terms, pair[1]])
            more = np.concatenate([df, np.ones(pair.shape[1], np.int64)])
            terms, number = np.unique(found, return_inverse=True)
            df = np.bincount(number.reshape(-1), weights=more).astype(np.int64)
        return cls(n, total / max(n, 1), longest, terms, df)

    def impacts(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Terms of an item and their parts of its score against itself."""
        term, tf = np.unique(hashes, return_counts=True)
        df = self.df[np.searchsorted(self.terms, term)]
        idf = np.log(1 + (self.n - df + 0.5) / (df + 0.5))
        impact = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(hashes) / self.mean))
        return term, impact / impact.sum()


def _indexes(benchmark: DataFrame) -> list[Broadcast]:
    """The index in parts of bounded size; which items are in a part is a matter of their ids' hash."""
    spark = benchmark.sparkSession
    items = benchmark.filter("text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text")
    size = int(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    parts = max(1, -(-size // INDEX_BYTES))

    def read(part: int) -> tuple[list[int], list[str]]:
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).collect()
        return [r["item_id"] for r in rows], [r["text"] for r in rows]

    corpus = Corpus.of(read(p)[1] for p in range(parts))
    return [spark.sparkContext.broadcast(Index(*read(p), corpus)) for p in range(parts)]


def hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, question_held, answer_held``: every document that holds an item, once a pair.

    The parts are those of the passage that holds most of the question, then of the answer.
    """

    def found(docs: DataFrame, index: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches):
                rows = list(index.value.matches(batch.column("text")))
                ids = batch.column("doc_id").cast(pa.int64()).take(pa.array([r[0] for r in rows], pa.int64()))
                columns = [
                    ids,
                    pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([r[2] for r in rows], pa.float64()),
                    pa.array([r[3] for r in rows], pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "q", "a"])

        return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, item_id long, q double, a double")

    parts = [found(docs, index) for index in _indexes(benchmark)]
    return (
        functools.reduce(DataFrame.unionByName, parts)
        .groupBy("doc_id", "item_id")
        .agg(F.max(F.struct("q", "a")).alias("x"))
        .select("doc_id", "item_id", F.col("x.q").alias("question_held"), F.col("x.a").alias("answer_held"))
    )


def without_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text holds an item; each row is judged by its own text, no join."""

    def kept(docs: DataFrame, index: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches):
                keep = np.ones(batch.num_rows, dtype=bool)
                for row, *_ in index.value.matches(batch.column("text")):
                    keep[row] = False
                yield batch.filter(pa.array(keep))

        return docs.mapInArrow(run, docs.schema)

    return functools.reduce(kept, _indexes(benchmark), docs)


def oracle(sf_threshold: float = THRESHOLD) -> str:
    """DuckDB SQL for ``hits``: the same definitions, without an index."""
    word = r"'[^\x20\x09-\x0D]+'"
    lower = f"translate(text, '{''.join(map(chr, range(65, 91)))}', '{''.join(map(chr, range(97, 123)))}')"
    return f"""
WITH items AS (
  SELECT row_number() OVER () AS i, item_id, ws, len(ws) AS n, len(ws) - greatest(len(ws) // 3, 1) AS cut
  FROM (SELECT item_id, regexp_extract_all({lower}, {word}) AS ws FROM benchmark WHERE text IS NOT NULL)
  WHERE len(ws) > 0),
size AS (SELECT greatest({LEAST_STRIDE}, max(n)) AS s, count(*) AS total, avg(n) AS mean FROM items),
tf AS (SELECT i, n, t, count(*) AS tf FROM (SELECT i, n, unnest(ws) AS t FROM items) GROUP BY i, n, t),
df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
raw AS (
  SELECT i, t, ln(1 + (total - df + 0.5) / (df + 0.5)) * tf * ({K1} + 1)
    / (tf + {K1} * (1 - {B} + {B} * n / mean)) AS impact
  FROM tf JOIN df USING (t), size),
impacts AS (SELECT i, t, impact / sum(impact) OVER (PARTITION BY i) AS impact FROM raw),
words AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all({lower}, {word}) AS ws
  FROM documents WHERE text IS NOT NULL),
passages AS (
  SELECT doc_id, r, p, ws[p * s + 1 : p * s + 2 * s] AS ws
  FROM (SELECT doc_id, r, ws, s, unnest(range(greatest(CAST(ceil((len(ws) - s) / s) AS BIGINT), 1))) AS p
        FROM words, size)),
terms AS (SELECT DISTINCT r, p, unnest(ws) AS t FROM passages),
retrieved AS (
  SELECT r, p, i FROM terms JOIN impacts USING (t) GROUP BY r, p, i HAVING sum(impact) >= {sf_threshold} - 1e-9),
grams AS (
  SELECT DISTINCT i, part, g, least({GRAM}, len(own)) AS k FROM (
    SELECT i, part, own, unnest(list_transform(range(greatest(len(own) - {GRAM} + 1, 1)),
      lambda x: array_to_string(own[x + 1 : x + {GRAM}], ' '))) AS g
    FROM (SELECT i, 'q' AS part, ws[1 : cut] AS own FROM items
          UNION ALL SELECT i, 'a', ws[cut + 1 : n] FROM items)
    WHERE len(own) > 0)),
checked AS (
  SELECT r, p, i, part,
    avg(CASE WHEN list_contains(list_transform(range(greatest(len(ws) - k + 1, 0)),
      lambda x: array_to_string(ws[x + 1 : x + k], ' ')), g) THEN 1.0 ELSE 0.0 END) AS held
  FROM retrieved JOIN passages USING (r, p) JOIN grams USING (i) GROUP BY r, p, i, part),
both_parts AS (
  SELECT r, p, i, coalesce(max(held) FILTER (part = 'q'), 1.0) AS q, coalesce(max(held) FILTER (part = 'a'), 1.0) AS a
  FROM checked GROUP BY r, p, i)
SELECT doc_id, item_id, max({{'q': q, 'a': a}}).q AS question_held, max({{'q': q, 'a': a}}).a AS answer_held
FROM both_parts JOIN (SELECT r, doc_id FROM words) USING (r) JOIN (SELECT i, item_id FROM items) USING (i)
WHERE q >= {QUESTION} - 1e-9 AND a >= {ANSWER} - 1e-9
GROUP BY doc_id, item_id
"""
