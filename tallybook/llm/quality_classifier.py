"""Quality of documents by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words. Every passage is encoded: shares of the kinds of
characters and of their pairs, word length and repetition, then one learned layer. Gated attention
(a tanh branch times a sigmoid branch) weighs the passages, a softmax over the document makes the
weights sum to one, and the weighted sum is scored by a logistic unit. Only documents carry labels;
which passages matter is learned from them.

The model is fitted with Adam on the driver on at most ``SAMPLE_ROWS`` labelled documents, in equal
shares by label; the shares are put right in the logistic unit's offset. Tasks encode them, so that the
driver gets numbers, not texts. Scoring reads all passages of all whole texts.

Defined results: null and empty texts are one passage without words; several labels of one document
are so many rows to learn from, null labels none; without labels every score is 0.5, with one kind of
label alone it is that label; labels of documents that aren't there count for nothing; rows that repeat
give repeated rows; labels, language, source and id are no inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.sampling import crc_is, labelled_sample
from tallybook.llm.words import Words, pieces

PASSAGE = 64
SAMPLE_ROWS = 3_000
HIDDEN, ATTENTION = 24, 12
SCORED_BYTES = 1 << 20
"""Text that is encoded at a time, a single longer one by itself."""
EPOCHS, BAGS_AT_ONCE, RATE, DECAY = 30, 64, 0.01, 1e-4

_KINDS = 16


def _kinds() -> np.ndarray:
    kind = np.full(256, 15, np.int64)
    groups = (" ", "\n\r", "aeiou", "bcdfghjklmnpqrstvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789",
              ".", ",;:", "!?", "#*$%&", "|", "<>", "\"'()[]{}", None, "+-=_/\\@^~`")
    for number, chars in enumerate(groups):
        if chars:
            kind[[ord(c) for c in chars]] = number
    kind[128:] = 13
    return kind


_KIND = _kinds()
FEATURES = _KINDS + _KINDS**2 + 3


def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages end to end, and where each text's begin. A text without words is one."""
    words = Words(texts)
    counts = words.counts
    number = np.maximum(-(-counts // PASSAGE), 1)
    first = np.concatenate([[0], np.cumsum(number)])
    within = np.arange(len(words)) - words.offsets[:-1][words.owners()]
    passage = first[:-1][words.owners()] + within // PASSAGE
    n = int(first[-1])
    features = np.zeros((n, FEATURES), np.float32)
    if not len(words):
        return features, first
    # a byte belongs to the passage of the word that it follows or is in; those before the first word to it
    owner = np.repeat(passage, np.diff(np.concatenate([[0], words.starts[1:], [len(words.raw)]])))
    kind = _KIND[words.raw]
    single = np.bincount(owner * _KINDS + kind, minlength=n * _KINDS).reshape(n, _KINDS)
    pair = kind[:-1] * _KINDS + kind[1:]
    double = np.bincount(owner[1:] * _KINDS**2 + pair, minlength=n * _KINDS**2).reshape(n, _KINDS**2)
    size = np.maximum(single.sum(axis=1, keepdims=True), 1)
    features[:, :_KINDS] = np.sqrt(single / size)
    features[:, _KINDS:-3] = np.sqrt(double / size)
    in_passage = np.bincount(passage, minlength=n)
    lengths = np.bincount(passage, weights=words.ends - words.starts, minlength=n)
    distinct = _distinct(passage, words.hashes(), n)
    some = np.maximum(in_passage, 1)
    features[:, -3] = lengths / some / 10
    features[:, -2] = distinct / some
    features[:, -1] = in_passage / PASSAGE
    return features, first


def _distinct(passage: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    order = np.lexsort((hashes, passage))
    p, h = passage[order], hashes[order]
    new = np.concatenate([[True], (p[1:] != p[:-1]) | (h[1:] != h[:-1])])
    return np.bincount(p[new], minlength=n)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Model:
    """Weights: encoder (w, b), attention (v tanh branch, u sigmoid branch, a scores), output (c, d)."""

    weights: dict[str, np.ndarray] = field(default_factory=dict)
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None

    @classmethod
    def start(cls, features: np.ndarray, seed: int = 7) -> Model:
        rng = np.random.default_rng(seed)
        shapes = {
            "w": (FEATURES, HIDDEN), "b": (HIDDEN,), "v": (HIDDEN, ATTENTION), "u": (HIDDEN, ATTENTION),
            "a": (ATTENTION,), "c": (HIDDEN,), "d": (1,),
        }
        weights = {
            k: rng.normal(0, 1 / np.sqrt(s[0]), s) if k not in "bd" else np.zeros(s) for k, s in shapes.items()
        }
        return cls(weights, features.mean(axis=0), features.std(axis=0) + 0.02)

    def forward(self, features: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        p = self.weights
        x = (features - self.mean) / self.scale
        h = np.tanh(x @ p["w"] + p["b"])
        t, g = np.tanh(h @ p["v"]), _sigmoid(h @ p["u"])
        score = (t * g) @ p["a"]
        size = np.diff(first)
        e = np.exp(score - np.repeat(np.maximum.reduceat(score, first[:-1]), size))
        attention = e / np.repeat(np.add.reduceat(e, first[:-1]), size)
        z = np.add.reduceat(attention[:, None] * h, first[:-1], axis=0)
        return {"x": x, "h": h, "t": t, "g": g, "att": attention, "z": z, "out": _sigmoid(z @ p["c"] + p["d"])}

    def gradients(self, found: dict[str, np.ndarray], first: np.ndarray, goal: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss, layer by layer from the output back."""
        p, size = self.weights, np.diff(first)
        error = (found["out"] - goal) / len(goal)
        to_z = error[:, None] * p["c"]
        bag = np.repeat(to_z, size, axis=0)
        to_att = (bag * found["h"]).sum(axis=1)
        mean = np.repeat(np.add.reduceat(found["att"] * to_att, first[:-1]), size)
        to_score = found["att"] * (to_att - mean)
        to_t = to_score[:, None] * p["a"] * found["g"] * (1 - found["t"] ** 2)
        to_g = to_score[:, None] * p["a"] * found["t"] * found["g"] * (1 - found["g"])
        to_h = found["att"][:, None] * bag + to_t @ p["v"].T + to_g @ p["u"].T
        to_x = to_h * (1 - found["h"] ** 2)
        return {
            "w": found["x"].T @ to_x, "b": to_x.sum(axis=0), "v": found["h"].T @ to_t, "u": found["h"].T @ to_g,
            "a": (found["t"] * found["g"]).T @ to_score, "c": found["z"].T @ error, "d": error.sum(keepdims=True),
        }

    def scores(self, texts: pa.Array) -> np.ndarray:
        features, first = encode(texts)
        return self.forward(features, first)["out"]


def train(bags: list[np.ndarray], goal: np.ndarray, weight: tuple[float, float], seed: int = 7) -> Model:
    """Adam over shuffled bags. ``weight`` are the labels' shares among all labelled rows (0, then 1)."""
    model = Model.start(np.concatenate(bags), seed)
    rng = np.random.default_rng(seed)
    moments = {k: (np.zeros_like(w), np.zeros_like(w)) for k, w in model.weights.items()}
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BAGS_AT_ONCE):
            own = order[at : at + BAGS_AT_ONCE]
            first = np.concatenate([[0], np.cumsum([len(bags[i]) for i in own])])
            found = model.forward(np.concatenate([bags[i] for i in own]), first)
            step += 1
            for k, g in model.gradients(found, first, goal[own]).items():
                m, s = moments[k]
                g = g + DECAY * model.weights[k]
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                rate = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                model.weights[k] = model.weights[k] - rate * m / (np.sqrt(s) + 1e-8)
    in_sample = np.clip(goal.mean(), 1e-3, 1 - 1e-3)
    share = np.clip(weight[1] / max(sum(weight), 1e-12), 1e-3, 1 - 1e-3)
    model.weights["d"] = model.weights["d"] + np.log(share / (1 - share)) - np.log(in_sample / (1 - in_sample))
    return model


def fit(
    docs: DataFrame, labels: DataFrame, label: str, held_out: Column | None = None, most: int = SAMPLE_ROWS
) -> Model | float:
    """A model from texts and the 0/1 ``label`` in ``labels`` by ``doc_id``; where the labels aren't of both
    kinds, the share of label 1 (one half without any)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            features, first = encode(batch.column("text"))
            edges = zip(first[:-1].tolist(), first[1:].tolist(), strict=True)
            bags = [features[a:b].astype("<f2").tobytes() for a, b in edges]
            columns = [batch.column("doc_id"), batch.column("goal"), pa.array(bags, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "goal", "bag"])

    rows, counts = labelled_sample(docs, labels, label, most, held_out)
    sample = rows.mapInArrow(run, "doc_id long, goal int, bag binary").collect()
    if len({r["goal"] for r in sample}) < 2:
        return float(sample[0]["goal"]) if sample else 0.5
    sample.sort(key=lambda r: (r["doc_id"], r["goal"], bytes(r["bag"])))
    bags = [np.frombuffer(r["bag"], "<f2").astype(np.float32).reshape(-1, FEATURES) for r in sample]
    goal = np.array([r["goal"] for r in sample], float)
    return train(bags, goal, (counts.get(0, 0), counts.get(1, 0)))


def with_scores(docs: DataFrame, model: Model | float | None, name: str = "quality_score") -> DataFrame:
    """``docs`` with a column ``name`` (double, 0 to 1); it replaces one of that name.

    Only the texts go to Python, some at a time; all other columns stay where they are.
    """
    docs = docs.drop(name)
    held: Broadcast = docs.sparkSession.sparkContext.broadcast(0.5 if model is None else model)

    def score(texts: pa.Array) -> pa.Array:
        if isinstance(held.value, float):
            return pa.array(np.full(len(texts), held.value))
        rows = pa.RecordBatch.from_arrays([texts], ["text"])
        found = [held.value.scores(part.column("text")) for part in pieces(iter([rows]), limit=SCORED_BYTES)]
        return pa.array(np.concatenate([np.zeros(0), *found]).astype(float))

    return docs.withColumn(name, F.arrow_udf(score, "double")(F.col("text")))


def predicted(docs: DataFrame, labels: DataFrame, modulus: int = 3, remainder: int = 1) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``; learns from those not held out."""
    rows = docs.select("doc_id", "text").withColumn("held_out", crc_is(modulus, remainder))
    model = fit(docs, labels, "quality", crc_is(modulus, remainder))
    scored = with_scores(rows, model, "score")
    verdict = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", "held_out", "score", verdict)
