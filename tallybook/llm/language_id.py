"""Language of whole texts by string kernels.

The kernel of two texts is the number of distinct character n-grams (n = 1 to 3, "blended
spectrum", presence only) that both have, over the geometric mean of how many each has. Landmark
texts stand for the training set (Nyström): with K their kernel matrix, a text's features are its
kernels with the landmarks times K^(-1/2), and kernel ridge regression is fitted on them for each
language against the rest. Scoring a batch is two matrix products: presence of the landmarks'
n-grams, times the landmarks; and that times one matrix of weights.

N-grams are of folded UTF-8 bytes: a letter counts alike in either case, accented Latin letters
too, and all that is no letter is one symbol.

Learning uses at most ``SAMPLE_ROWS`` training rows, in equal shares by language; their n-grams
are found in the tasks, and only those reach the driver.

Defined results: a null text, or one without any letter, is ``und`` with score 0; without training
rows every text is; equal scores go to the language first in order; rows that repeat give repeated
rows; other columns aren't read for a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.sampling import bounded, crc_is
from tallybook.llm.words import pieces, text_bytes

SAMPLE_ROWS = 2_400
LANDMARKS = 96
RIDGE = 1e-3
ROWS_AT_ONCE = 256
UNKNOWN = "und"

_SYMBOL = np.zeros(256, dtype=np.int32)
_SYMBOL[97:123] = _SYMBOL[65:91] = np.arange(1, 27)
_SYMBOL[0x80:0xC0] = 27 + (np.arange(0x80, 0xC0) & 31)
_SYMBOL[0xC2:] = 61
_SYMBOL[0xC3] = 59
_SYMBOL[0xC4:0xC6] = 60
_SYMBOL[0xE0:0xF0] = 62
_SYMBOL[0xF0:] = 63
GRAMS = 64 + 64**2 + 64**3
"""Numbers of all n-grams: the single symbols first, then pairs, then triples."""


class Grams:
    """Numbers of the n-grams of each text of a batch."""

    def __init__(self, texts: pa.Array):
        raw, self.at = text_bytes(texts)
        one = _SYMBOL[raw]
        two = one[:-1] * 64 + one[1:]
        three = two[:-1] * 64 + one[2:]
        self.levels = (one, two + 64, three + (64 + 64**2))
        self._met = np.zeros(GRAMS, dtype=bool)

    def __iter__(self) -> Iterator[tuple[list[np.ndarray], int]]:
        """For each text its n-grams as they stand, by length, and how many are distinct."""
        for a, b in zip(self.at[:-1].tolist(), self.at[1:].tolist(), strict=True):
            own = [level[a : max(b - n, a)] for n, level in enumerate(self.levels)]
            for level in own:
                self._met[level] = True
            distinct = int(np.count_nonzero(self._met))
            for level in own:
                self._met[level] = False
            yield own, distinct

    def distinct(self) -> Iterator[np.ndarray]:
        for own, _ in self:
            yield np.unique(np.concatenate(own))


def has_letter(texts: pa.Array) -> np.ndarray:
    raw, at = text_bytes(texts)
    plain = np.concatenate([[0], np.cumsum(((raw | 32) >= 97) & ((raw | 32) <= 122))])
    found = plain[at[1:]] > plain[at[:-1]]
    wide = np.concatenate([[0], np.cumsum(raw >= 0x80)])
    for row in np.flatnonzero(~found & (wide[at[1:]] > wide[at[:-1]])).tolist():
        found[row] = any(c.isalpha() for c in texts[row].as_py())
    return found


@dataclass
class Classifier:
    languages: list[str]
    columns: np.ndarray
    """Place of each n-gram among those of the landmarks; the last place is for all others."""
    landmarks: np.ndarray
    """n-grams x landmarks, presence over the root of the landmark's number of n-grams."""
    weights: np.ndarray
    """landmarks x languages"""

    @classmethod
    def fit(cls, grams: list[np.ndarray], languages: list[str], landmarks: int = LANDMARKS) -> Classifier:
        names = sorted(set(languages))
        share = max(landmarks // max(len(names), 1), 1)
        picked = [i for name in names for i in [k for k, x in enumerate(languages) if x == name][:share]]
        known = np.unique(np.concatenate([grams[i] for i in picked]))
        columns = np.full(GRAMS, len(known), np.int32)
        columns[known] = np.arange(len(known))
        matrix = np.zeros((len(known), len(picked)), np.float32)
        for j, i in enumerate(picked):
            matrix[columns[grams[i]], j] = 1 / np.sqrt(max(len(grams[i]), 1))
        model = cls(names, columns, matrix, np.zeros((len(picked), len(names))))
        kernels = np.concatenate(
            [model.kernels(grams[i : i + 256], [len(g) for g in grams[i : i + 256]]) for i in range(0, len(grams), 256)]
        ).astype(float)
        values, vectors = np.linalg.eigh(kernels[picked])
        keep = values > 1e-6 * values.max(initial=1e-12)
        root = vectors[:, keep] / np.sqrt(values[keep])
        features = kernels @ root
        goal = np.where(np.array(languages)[:, None] == np.array(names), 1.0, -1.0)
        inside = features.T @ features + RIDGE * len(grams) * np.eye(features.shape[1])
        model.weights = (root @ np.linalg.solve(inside, features.T @ goal)).astype(np.float32)
        return model

    def kernels(self, grams: list[np.ndarray], sizes: list[int]) -> np.ndarray:
        return self._kernels(([g] for g in grams), np.array(sizes))

    def _kernels(self, rows: Iterator[list[np.ndarray]], sizes: np.ndarray) -> np.ndarray:
        present = np.zeros((len(sizes), len(self.landmarks) + 1), np.float32)
        for row, own in zip(present, rows, strict=True):
            for level in own:
                row[self.columns[level]] = 1
        return (present[:, :-1] @ self.landmarks) / np.sqrt(np.maximum(sizes, 1))[:, None]

    def predict(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Number of the language, or -1; and the score, 0 to 1."""
        outputs = []
        for first in range(0, len(texts), ROWS_AT_ONCE):
            found = list(Grams(texts.slice(first, ROWS_AT_ONCE)))
            sizes = np.array([n for _, n in found])
            outputs.append(self._kernels((own for own, _ in found), sizes) @ self.weights)
        value = np.concatenate(outputs)
        best = value.argmax(axis=1)
        score = np.clip((value[np.arange(len(best)), best].astype(float) + 1) / 2, 0, 1)
        letters = has_letter(texts)
        return np.where(letters, best, -1), np.where(letters, score, 0.0)


def fit(labelled: DataFrame, most: int = SAMPLE_ROWS) -> Classifier | None:
    """A classifier from ``doc_id, text, lang``; None without rows to learn from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            grams = [g.astype("<i4").tobytes() for g in Grams(batch.column("text")).distinct()]
            columns = [batch.column("doc_id"), batch.column("lang"), pa.array(grams, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang", "grams"])

    rows = labelled.filter("text IS NOT NULL").select(F.col("doc_id").cast("long"), "text", "lang")
    sample = bounded(rows, "lang", most).mapInArrow(run, "doc_id long, lang string, grams binary").collect()
    sample = [r for r in sample if len(r["grams"])]
    sample.sort(key=lambda r: (r["lang"], hash(r["doc_id"] or 0), bytes(r["grams"])))
    if not sample:
        return None
    return Classifier.fit([np.frombuffer(r["grams"], "<i4") for r in sample], [r["lang"] for r in sample])


def predicted(docs: DataFrame, modulus: int = 4, remainder: int = 2) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score``; learns from those not held out."""
    rows = docs.select("doc_id", "text", "lang").withColumn("held_out", crc_is(modulus, remainder))
    model = docs.sparkSession.sparkContext.broadcast(fit(rows.filter("NOT held_out")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            if model.value is None:
                best, score, names = np.full(batch.num_rows, -1), np.zeros(batch.num_rows), []
            else:
                best, score = model.value.predict(batch.column("text"))
                names = model.value.languages
            columns = [
                batch.column("doc_id").cast(pa.int64()),
                batch.column("held_out"),
                pa.array([*names, UNKNOWN]).take(pa.array(np.where(best < 0, len(names), best))),
                pa.array(score),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score"])

    schema = "doc_id long, held_out boolean, lang_pred string, score double"
    return rows.select("doc_id", "held_out", "text").mapInArrow(run, schema)
