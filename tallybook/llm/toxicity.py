"""Toxicity of whole texts by a bidirectional gated recurrent network with attention pooling.

Each word (letters A-Z in lower case, punctuation around it left out) is a learned vector of the word,
where the training sample knows it, beside the mean of learned vectors of its character n-grams (3 to 5,
word ends marked) and the highest log-odds among those.
A forward and a backward gated recurrent unit read windows of ``WINDOW`` words; attention over the
steps pools their states, and a logistic unit scores the window. All overlapping windows of a text
(a new one every ``STRIDE`` words, the last one ending with the text) are scored; the text has the score
of its worst, put on the scale of the labels by a logistic curve fitted on the sample's documents.

The network is trained with numpy on the driver, by back-propagation through time and Adam, on at most
``SAMPLE_ROWS`` labelled documents in equal shares by label. The first number of each vector starts as
the log-odds of its word or n-gram in the sample. Only documents have labels, so a document trains
with the windows that hold its words of the highest log-odds.

Defined results: null and empty texts are one window without words; without labels, or with labels of
one kind only, every score is the share of label 1, one half where there is none (an exact half is
predicted 1); equal scores and repeated rows stay as they are; labels, language, source and id are no
inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from tallybook.llm.parts import ranges
from tallybook.llm.sampling import crc_is, labelled_sample
from tallybook.llm.words import Words, mixed, pieces, span_hashes

WINDOW, STRIDE = 32, 24
SAMPLE_ROWS = 2_000
VOCABULARY = 20_000
GRAMS = 1 << 16
"""Hashed places of character n-grams."""
GRAM_SIZES = (3, 4, 5)
WORD_SIZE, CHAR_SIZE, HIDDEN = 6, 4, 8
EPOCHS, AT_ONCE, RATE = 6, 128, 0.01
WINDOWS_PER_DOCUMENT = 4
"""Windows of a document that train: those of its highest log-odds."""
SCORED_AT_ONCE = 4_096

_CORE = np.zeros(256, dtype=bool)
_CORE[97:123] = _CORE[128:] = True
_SIZE = WORD_SIZE + CHAR_SIZE + 1
_CHARS = slice(WORD_SIZE, WORD_SIZE + CHAR_SIZE)


@dataclass
class Read:
    """Words of a batch: the distinct ones' identities and n-grams, and each word's number among them.

    ``grams`` has a row for each size and a column for each place of a word, its end marks included;
    where no n-gram of that size begins it is ``GRAMS``.
    """

    number: np.ndarray
    offsets: np.ndarray
    identity: np.ndarray
    grams: np.ndarray
    gram_starts: np.ndarray

    def gram_counts(self) -> np.ndarray:
        return np.add.reduceat((self.grams < GRAMS).sum(axis=0), self.gram_starts[:-1])

    @classmethod
    def of(cls, texts: pa.Array) -> Read:
        words = Words(texts, lower=True)
        raw, starts, ends = words.raw, words.starts, words.ends
        if not len(starts):
            empty = np.zeros(0, np.int64)
            none = np.zeros((len(GRAM_SIZES), 0), np.int64)
            return cls(empty, words.offsets, np.zeros(0, np.uint64), none, np.zeros(1, np.int64))
        place = np.arange(len(raw))
        core = _CORE[raw]
        first = np.minimum.reduceat(np.where(core, place, len(raw)), starts)
        last = np.maximum.reduceat(np.where(core, place, -1), starts) + 1
        # reduceat runs to the next word's start, so only white space lies behind a word
        some = first < last
        starts, ends = np.where(some, first, starts), np.where(some, last, ends)
        identity, at, number = np.unique(span_hashes(raw, starts, ends), return_index=True, return_inverse=True)
        starts, lengths = starts[at], ends[at] - starts[at]
        upto = np.concatenate([[0], np.cumsum(lengths + 2)])
        body = np.zeros(upto[-1] + max(GRAM_SIZES), np.uint64)
        body[ranges(upto[:-1] + 1, lengths)] = raw[ranges(starts, lengths)]
        body[upto[:-1]], body[upto[1:] - 1] = 1, 2
        left = np.repeat(upto[1:], lengths + 2) - np.arange(upto[-1])
        grams = np.full((len(GRAM_SIZES), upto[-1]), GRAMS, np.int64)
        for row, size in enumerate(GRAM_SIZES):
            key = np.zeros(upto[-1], np.uint64)
            for k in range(size):
                key = (key << np.uint64(8)) | body[k : k + upto[-1]]
            grams[row] = np.where(left >= size, mixed(key + np.uint64(size)) % np.uint64(GRAMS), GRAMS)
        return cls(number, words.offsets, identity, grams, upto)

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word and length of every window, and where each text's windows begin."""
        counts = np.diff(self.offsets)
        number = 1 + np.maximum(-(-(counts - WINDOW) // STRIDE), 0)
        first = np.concatenate([[0], np.cumsum(number)])
        row = np.repeat(np.arange(len(counts)), number)
        start = np.minimum((np.arange(first[-1]) - first[row]) * STRIDE, np.maximum(counts[row] - WINDOW, 0))
        return self.offsets[row] + start, np.minimum(counts[row], WINDOW), first


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Network:
    """Weights and the passes through them. Two units: 0 reads forward, 1 backward."""

    def __init__(self, vocabulary: np.ndarray, word: np.ndarray, char: np.ndarray, seed: int = 11):
        rng = np.random.default_rng(seed)
        draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
        self.vocabulary = vocabulary
        p = {"word": draw(len(word) + 1, WORD_SIZE) * 0.1, "char": draw(GRAMS + 1, CHAR_SIZE) * 0.1}
        p["word"] *= np.sqrt(len(word) + 1) / 3
        p["char"] *= np.sqrt(GRAMS) / 3
        p["word"][:-1, 0], p["word"][-1] = word, 0
        p["char"][:-1, 0], p["char"][-1] = char, 0
        self.odds = np.append(char, -9).astype(np.float32)
        for way in (0, 1):
            p[f"w{way}"], p[f"u{way}"] = draw(_SIZE, 3 * HIDDEN), draw(HIDDEN, 3 * HIDDEN)
            p[f"b{way}"] = np.zeros(3 * HIDDEN, np.float32)
        p["a"], p["c"], p["d"] = draw(2 * HIDDEN), draw(2 * HIDDEN), np.zeros(1, np.float32)
        self.p = p
        self.slope, self.offset = 1.0, 0.0

    def known(self, identity: np.ndarray) -> np.ndarray:
        """Place of each word among the known; one place more for all others."""
        n = len(self.vocabulary)
        at = np.searchsorted(self.vocabulary, identity)
        hit = np.zeros(len(identity), dtype=bool)
        inside = at < n
        hit[inside] = self.vocabulary[at[inside]] == identity[inside]
        return np.where(hit, at, n)

    def vectors(self, read: Read) -> np.ndarray:
        """One row for each distinct word and one of zeros, for where a window has ended."""
        out = np.zeros((len(read.identity) + 1, _SIZE), np.float32)
        if len(read.identity):
            out[:-1, :WORD_SIZE] = self.p["word"][self.known(read.identity)]
            chars = self.p["char"]
            sums = np.add.reduceat(sum(chars[g] for g in read.grams), read.gram_starts[:-1], axis=0)
            out[:-1, _CHARS] = sums / read.gram_counts()[:, None]
            highest = np.max([self.odds[g] for g in read.grams], axis=0)
            out[:-1, -1] = np.maximum.reduceat(highest, read.gram_starts[:-1])
        return out

    def forward(self, inputs: list[np.ndarray], steps: np.ndarray, mask: np.ndarray, keep_all: bool = True) -> dict:
        """``inputs`` are the units' projections of the distinct words, ``steps`` windows x words.

        Inside, windows are the last axis, so that every operation runs over long rows.
        """
        n, t = steps.shape
        kept: dict = {"states": np.empty((t, 2 * HIDDEN, n), np.float32), "gates": ({}, {})}
        whole = mask.all(axis=0)
        for way in (0, 1):
            u, h = np.ascontiguousarray(self.p[f"u{way}"].T), np.zeros((HIDDEN, n), np.float32)
            for k in range(t) if way == 0 else range(t - 1, -1, -1):
                x, recurrent = inputs[way][steps[:, k]].T.copy(), u @ h
                gates = x[: 2 * HIDDEN]
                gates += recurrent[: 2 * HIDDEN]
                gates = _sigmoid(gates)
                z, r = gates[:HIDDEN], gates[HIDDEN:]
                last = recurrent[2 * HIDDEN :]
                new = np.tanh(x[2 * HIDDEN :] + r * last)
                keep = z if whole[k] else 1 - (1 - z) * mask[:, k]
                if keep_all:
                    kept["gates"][way][k] = (h, keep, z, r, new, last)
                h = new + keep * (h - new)
                kept["states"][k, way * HIDDEN : (way + 1) * HIDDEN] = h
        score = np.stack([self.p["a"] @ s for s in kept["states"]]) + (mask.T - 1) * np.float32(1e9)
        e = np.exp(score - score.max(axis=0)) + np.float32(1e-12)
        kept["att"] = e / e.sum(axis=0)
        kept["z"] = sum(w * s for w, s in zip(kept["att"], kept["states"], strict=True))
        kept["logit"] = self.p["c"] @ kept["z"] + self.p["d"]
        return kept

    def backward(self, kept: dict, to_logit: np.ndarray, mask: np.ndarray) -> tuple[dict, list[np.ndarray]]:
        """Gradients of the weights above the inputs, and of the inputs (by unit: windows x words x gates)."""
        p, (t, _, n) = self.p, kept["states"].shape
        grads = {"c": kept["z"] @ to_logit, "d": to_logit.sum(keepdims=True)}
        to_z = p["c"][:, None] * to_logit
        to_att = np.einsum("hn,thn->tn", to_z, kept["states"])
        to_score = kept["att"] * (to_att - (kept["att"] * to_att).sum(axis=0))
        grads["a"] = np.einsum("tn,thn->h", to_score, kept["states"])
        inputs = []
        for way in (0, 1):
            u, own = p[f"u{way}"], slice(way * HIDDEN, (way + 1) * HIDDEN)
            to_h = np.zeros((HIDDEN, n), np.float32)
            to_x = np.empty((n, t, 3 * HIDDEN), np.float32)
            to_u = np.zeros_like(u)
            for k in range(t - 1, -1, -1) if way == 0 else range(t):
                h, keep, z, r, new, last = kept["gates"][way][k]
                g = to_h + kept["att"][k] * to_z[own] + to_score[k] * p["a"][own, None]
                to_new = g * (1 - keep) * (1 - new**2)
                to_zz = g * (h - new) * mask[:, k] * z * (1 - z)
                to_r = to_new * last * r * (1 - r)
                to_x[:, k] = np.concatenate([to_zz, to_r, to_new]).T
                back = np.concatenate([to_zz, to_r, to_new * r])
                to_u += h @ back.T
                to_h = g * keep + u @ back
            grads[f"u{way}"] = to_u
            inputs.append(to_x)
        return grads, inputs

    def logits(self, texts: pa.Array) -> np.ndarray:
        """The largest window logit of each text."""
        read = Read.of(texts)
        start, length, first = read.windows()
        vectors = self.vectors(read)
        inputs = [vectors @ self.p[f"w{way}"] + self.p[f"b{way}"] for way in (0, 1)]
        found = np.empty(len(start), np.float32)
        for a in range(0, len(start), SCORED_AT_ONCE):
            steps, mask = _steps(read, start[a : a + SCORED_AT_ONCE], length[a : a + SCORED_AT_ONCE])
            found[a : a + SCORED_AT_ONCE] = self.forward(inputs, steps, mask, False)["logit"]
        return np.maximum.reduceat(found, first[:-1])

    def scores(self, texts: pa.Array) -> np.ndarray:
        return _sigmoid(self.slope * self.logits(texts).astype(float) + self.offset)


def _steps(read: Read, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of each window (the row of zeros beyond its end), and which are words."""
    at = start[:, None] + np.arange(WINDOW)
    mask = np.arange(WINDOW) < length[:, None]
    padded = np.concatenate([read.number, [0]])
    steps = np.where(mask, padded[np.minimum(at, len(read.number))], len(read.identity))
    return steps, mask.astype(np.float32)


def _grams_of(read: Read, words: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of some of the distinct words."""
    grams = read.grams[:, ranges(read.gram_starts[words], lengths[words])]
    return grams, np.concatenate([[0], np.cumsum(lengths[words])])


def _log_odds(rows: np.ndarray, items: np.ndarray, goal: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of distinct (row, item) pairs: smoothed log-odds of label 1 by item, and its number of rows."""
    hot = np.bincount(items, weights=goal[rows], minlength=n)
    every = np.bincount(items, minlength=n)
    yes, no = max(goal.sum(), 1), max((1 - goal).sum(), 1)
    return np.log((hot + 1) / (yes + 2)) - np.log((every - hot + 1) / (no + 2)), every


def train(texts: list[str], goal: np.ndarray, shares: tuple[int, int], seed: int = 11) -> Network:
    """A network from texts and their 0/1 labels. ``shares`` are the numbers of all rows of each label."""
    read = Read.of(pa.array(texts, pa.string()))
    owner = np.repeat(np.arange(len(texts)), np.diff(read.offsets))
    pair = np.unique(owner * max(len(read.identity), 1) + read.number)
    odds, every = _log_odds(pair // max(len(read.identity), 1), pair % max(len(read.identity), 1), goal, len(read.identity))
    top = np.sort(np.argsort(-every, kind="stable")[: min(VOCABULARY, int((every > 1).sum()))])
    by_word = np.split(read.grams, read.gram_starts[1:-1], axis=1)
    chars = [
        np.unique(np.concatenate([by_word[w].ravel() for w in np.unique(read.number[a:b])] or [np.zeros(0, np.int64)]))
        for a, b in zip(read.offsets[:-1].tolist(), read.offsets[1:].tolist(), strict=True)
    ]
    chars = [c[c < GRAMS] for c in chars]
    rows = np.repeat(np.arange(len(texts)), [len(c) for c in chars])
    char_odds, _ = _log_odds(rows, np.concatenate([*chars, np.zeros(0, np.int64)]).astype(np.int64), goal, GRAMS)
    net = Network(read.identity[top], odds[top], char_odds, seed)

    start, length, first = read.windows()
    worth = np.concatenate([odds, [-9.0]])
    best = np.array([worth[read.number[s : s + k]].max(initial=-9.0) for s, k in zip(start, length, strict=True)])
    chosen = np.concatenate(
        [a + np.argsort(-best[a:b], kind="stable")[:WINDOWS_PER_DOCUMENT if goal[i] == 0 else 1]
         for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True))]
    )
    label = goal[np.searchsorted(first, chosen, side="right") - 1]
    weight = np.where(label == 1, 0.5 / max(label.sum(), 1), 0.5 / max((1 - label).sum(), 1)) * len(label)
    rng = np.random.default_rng(seed)
    moments = {k: (np.zeros_like(w), np.zeros_like(w)) for k, w in net.p.items()}
    step = 0
    known = np.concatenate([net.known(read.identity), [len(net.vocabulary)]])
    lengths, gram_counts = np.diff(read.gram_starts), read.gram_counts()
    for _ in range(EPOCHS):
        order = rng.permutation(len(chosen))
        for a in range(0, len(order), AT_ONCE):
            own = order[a : a + AT_ONCE]
            steps, mask = _steps(read, start[chosen[own]], length[chosen[own]])
            used, local = np.unique(steps, return_inverse=True)
            local = local.reshape(steps.shape)
            real = used < len(read.identity)
            words = used[real]
            vectors = np.zeros((len(used), _SIZE), np.float32)
            own_words = Read(words, read.offsets, read.identity[words], *_grams_of(read, words, lengths))
            vectors[real] = net.vectors(own_words)[:-1]
            gram_word = np.repeat(np.flatnonzero(real), lengths[words])
            kept = net.forward([vectors @ net.p[f"w{w}"] + net.p[f"b{w}"] for w in (0, 1)], local, mask)
            error = (_sigmoid(kept["logit"]) - label[own]) * weight[own] / len(own)
            grads, to_inputs = net.backward(kept, error.astype(np.float32), mask)
            to_vectors = np.zeros_like(vectors)
            for way, to_x in enumerate(to_inputs):
                flat = np.zeros((len(used), 3 * HIDDEN), np.float32)
                np.add.at(flat, local.reshape(-1), to_x.reshape(-1, 3 * HIDDEN))
                grads[f"w{way}"], grads[f"b{way}"] = vectors.T @ flat, flat.sum(axis=0)
                to_vectors += flat @ net.p[f"w{way}"].T
            grads["word"], grads["char"] = np.zeros_like(net.p["word"]), np.zeros_like(net.p["char"])
            np.add.at(grads["word"], known[words], to_vectors[real, :WORD_SIZE])
            grads["word"][-1] = 0
            to_char = to_vectors[gram_word][:, _CHARS] / np.repeat(gram_counts[words], lengths[words])[:, None]
            for row in own_words.grams:
                np.add.at(grads["char"], row, to_char)
            grads["char"][-1] = 0
            step += 1
            for k, g in grads.items():
                m, s = moments[k]
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                rate = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                net.p[k] -= (rate * m / (np.sqrt(s) + 1e-8)).astype(np.float32)
    _calibrate(net, texts, goal, shares)
    return net


def _calibrate(net: Network, texts: list[str], goal: np.ndarray, shares: tuple[int, int]) -> None:
    """Slope and offset from largest logits to labels, by Newton steps on the weighted log loss."""
    x = np.concatenate([net.logits(pa.array(texts[i : i + 500], pa.string())) for i in range(0, len(texts), 500)])
    x = x.astype(float)
    of = np.array([shares[0] / max((goal == 0).sum(), 1), shares[1] / max((goal == 1).sum(), 1)])
    weight = of[goal.astype(int)] / of[goal.astype(int)].mean()
    design = np.stack([x, np.ones_like(x)], axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(25):
        p = _sigmoid(design @ beta)
        slope = design.T @ (weight * (p - goal)) + 0.1 * (beta - [1.0, 0.0])
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(2)
        beta = beta - np.clip(np.linalg.solve(curve, slope), -2, 2)
    net.slope, net.offset = float(max(beta[0], 0.05)), float(beta[1])


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", held_out: Column | None = None, most: int = SAMPLE_ROWS
) -> Network | float:
    """A network; where the labels aren't of both kinds, the share of label 1 (one half without any)."""
    rows, counts = labelled_sample(docs, labels, label, most, held_out)
    sample = sorted((r["doc_id"], r["text"] or "", r["goal"]) for r in rows.collect())
    goal = np.array([r[2] for r in sample], float)
    if len(set(goal.tolist())) < 2:
        return float(goal.mean()) if len(goal) else 0.5
    return train([r[1] for r in sample], goal, (counts.get(0, 0), counts.get(1, 0)))


def with_scores(docs: DataFrame, model: Network | float, name: str = "toxicity_score") -> DataFrame:
    """``docs`` with a column ``name`` (double, 0 to 1); it replaces one of that name."""
    docs = docs.drop(name)
    held = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            model = held.value
            if isinstance(model, float):
                score = np.full(batch.num_rows, model)
            else:
                score = model.scores(batch.column("text"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score.astype(float))], schema.names)

    return docs.mapInArrow(run, schema)


def predicted(docs: DataFrame, labels: DataFrame, modulus: int = 5, remainder: int = 0) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``; learns from those not held out."""
    held_out = crc_is(modulus, remainder)
    model = fit(docs, labels, "toxic", held_out)
    scored = with_scores(docs.select("doc_id", "text").withColumn("held_out", held_out), model, "score")
    return scored.selectExpr("doc_id", "held_out", "score", "CAST(score >= 0.5 AS INT) AS predicted")
