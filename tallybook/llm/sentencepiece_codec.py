"""SentencePiece encoding and decoding with the tokenizers library as the engine.

The model file is read as the protobuf that it is: pieces with scores and kinds, the trainer's
model type and byte fallback, the normaliser's flags. From these a tokenizers model is rebuilt:
``Unigram`` over the scores, or ``BPE`` with the merges that the scores of a BPE model imply. The
space marker U+2581 and the leading dummy space are put in as the normaliser says.

No piece of a usable model has a marker after another character, so no piece reaches over the
place in front of a run of spaces. Texts are cut there and each distinct part is encoded once;
a model without that property is refused. (Characters that stand in no piece of more than one
character end a part as well.) ``verify=True`` compares the ids of distinct parts with the
sentencepiece library and raises on the first difference: of those that begin with a space and hold
more than it and no U+2581, which are the ones that the library can be given alone.
"""

from __future__ import annotations

import functools
import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallybook.llm.parts import PartIds, ranges
from tallybook.llm.words import pieces, text_bytes

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of one protobuf message; nested messages stay bytes."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}[kind] if kind != 2 else number()
        yield key >> 3, data[at : at + size]
        at += size


@dataclass(frozen=True)
class Model:
    """What a SentencePiece model file says."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[int, ...]
    model_type: int
    byte_fallback: bool
    dummy_prefix: bool
    extra_spaces_removed: bool
    charsmap: bytes

    @classmethod
    def parse(cls, data: bytes) -> Model:
        names, scores, kinds = [], [], []
        trainer: dict[int, int | bytes] = {}
        normaliser: dict[int, int | bytes] = {}
        for field, value in _fields(data):
            if field == 1:
                piece = dict(_fields(value))
                names.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0])
                kinds.append(piece.get(3, NORMAL))
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                normaliser = dict(_fields(value))
        return cls(
            tuple(names),
            tuple(scores),
            tuple(kinds),
            trainer.get(3, UNIGRAM),
            bool(trainer.get(35, 0)),
            bool(normaliser.get(3, 1)),
            bool(normaliser.get(4, 1)),
            normaliser.get(2, b""),
        )

    @functools.cached_property
    def unknown(self) -> int:
        return self.kinds.index(UNKNOWN)

    def engine(self):
        """The tokenizers model with this model's pieces."""
        from tokenizers import models

        if self.model_type == UNIGRAM:
            return models.Unigram(
                list(zip(self.pieces, self.scores, strict=True)), self.unknown, self.byte_fallback
            )
        if self.model_type != BPE:
            raise ValueError("only unigram and BPE models can be rebuilt")
        ids = {p: i for i, p in enumerate(self.pieces)}
        plain = {p: i for p, i in ids.items() if self.kinds[i] in (NORMAL, USER)}
        merges = []
        for piece, i in plain.items():
            for cut in range(1, len(piece)):
                left, right = plain.get(piece[:cut]), plain.get(piece[cut:])
                if left is not None and right is not None:
                    merges.append((-self.scores[i], left, right))
        merges.sort()
        return models.BPE(
            ids,
            [(self.pieces[a], self.pieces[b]) for _, a, b in merges],
            unk_token=self.pieces[self.unknown],
            fuse_unk=True,
            byte_fallback=self.byte_fallback,
        )

    def tokenizer(self):
        """A whole tokenizers pipeline: normaliser, space marker, model."""
        from tokenizers import Tokenizer, normalizers

        steps = []
        if self.charsmap:
            steps.append(normalizers.Precompiled(self.charsmap))
        if self.extra_spaces_removed:
            steps += [normalizers.Strip(), normalizers.Replace("  ", " ")]
        steps.append(normalizers.Replace(" ", MARK))
        tokenizer = Tokenizer(self.engine())
        tokenizer.normalizer = normalizers.Sequence(steps)
        return tokenizer


class Codec:
    """Encodes and decodes Arrow batches of texts with one model."""

    def __init__(self, data: bytes, verify: bool = False):
        self.model = Model.parse(data)
        if self.model.charsmap or self.model.extra_spaces_removed:
            raise ValueError("the model rewrites texts, so that decoding can't give them back")
        names = [p for p, k in zip(self.model.pieces, self.model.kinds, strict=True) if k == NORMAL]
        if any(MARK in p.lstrip(MARK) for p in names):
            raise ValueError("the model has pieces that reach over spaces")
        inside = set("".join(p for p in names if len(p) > 1))
        self.breaks = [c for c in "\n\t\r" if c not in inside]
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer(self.model.engine())
        self.reference = None
        if verify:
            import sentencepiece

            self.reference = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.parts = PartIds(self._encode)
        self._tables()

    def _encode(self, parts: list[bytes]) -> list[list[int]]:
        texts = [p.decode("utf-8") for p in parts]
        marked = [t.replace(" ", MARK) for t in texts]
        found = [e.ids for e in self.tokenizer.encode_batch_fast(marked, add_special_tokens=False)]
        if self.reference is not None:
            self._compare(texts, found)
        return found

    def _compare(self, texts: list[str], found: list[list[int]]) -> None:
        skip = 1 if self.model.dummy_prefix else 0
        at = [i for i, t in enumerate(texts) if t[:1] == " " and len(t) > skip and MARK not in t]
        theirs = self.reference.encode([texts[i][skip:] for i in at], num_threads=1)
        for i, ids in zip(at, theirs, strict=True):
            if ids != found[i]:
                raise AssertionError(f"{texts[i]!r}: {found[i]} here, {ids} in sentencepiece")

    def _tables(self) -> None:
        """Bytes of every id, end to end, for decoding by gathering."""
        body = []
        for piece, kind in zip(self.model.pieces, self.model.kinds, strict=True):
            if kind == BYTE:
                body.append(bytes([int(piece[3:5], 16)]))
            elif kind == CONTROL:
                body.append(b"")
            elif kind == UNKNOWN:
                body.append(" ⁇ ".encode())
            else:
                body.append(piece.replace(MARK, " ").encode())
        self.piece_lengths = np.fromiter(map(len, body), np.int64, len(body))
        self.piece_starts = np.cumsum(self.piece_lengths) - self.piece_lengths
        self.piece_bytes = np.frombuffer(b"".join(body), np.uint8)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and where each text starts in them. Null is empty."""
        raw, at = text_bytes(texts)
        if self.model.dummy_prefix:
            filled = np.diff(at) > 0
            raw = np.insert(raw, at[:-1][filled], 0x20)
            at = at + np.concatenate([[0], np.cumsum(filled)])
        if not len(raw):
            return np.zeros(0, np.uint32), np.zeros(len(at), np.int64)
        space = raw == 0x20
        cut = np.zeros(len(raw) + 1, dtype=bool)
        cut[1:-1] = space[1:] & ~space[:-1]
        for char in self.breaks:
            found = np.flatnonzero(raw == ord(char))
            cut[found] = True
            cut[found + 1] = True
        cut[at] = True
        cuts = np.flatnonzero(cut)
        ids, lengths = self.parts.ids(raw, cuts[:-1], cuts[1:])
        upto = np.concatenate([[0], np.cumsum(lengths)])
        return ids, upto[np.searchsorted(cuts, at)]

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts end to end, and where each starts."""
        lengths = self.piece_lengths[ids]
        raw = self.piece_bytes[ranges(self.piece_starts[ids], lengths)]
        at = np.concatenate([[0], np.cumsum(lengths)])[starts]
        if self.model.dummy_prefix:
            first = at[:-1][np.diff(at) > 0]
            first = first[raw[first] == 0x20]
            gone = np.zeros(len(raw) + 1, np.int64)
            gone[first + 1] = 1
            raw, at = np.delete(raw, first), at - np.cumsum(gone)[at]
        return raw, at


_CODECS: dict[tuple[int, bool], Codec] = {}


def _codec(data: bytes, verify: bool) -> Codec:
    """One codec per worker and model, kept between tasks with its cache."""
    key = (zlib.crc32(data), verify)
    if key not in _CODECS:
        _CODECS[key] = Codec(data, verify)
    return _CODECS[key]


def encode(docs: DataFrame, model: bytes, verify: bool = True) -> DataFrame:
    """``docs`` with ``sp_ids`` (array<int>) for their ``text``; its other columns are kept.

    Null and empty texts have no ids. A column named ``sp_ids`` in the input is replaced.
    """
    docs = docs.drop("sp_ids")
    schema = T.StructType([*docs.schema.fields, T.StructField("sp_ids", T.ArrayType(T.IntegerType()))])

    def run(batches):
        codec = _codec(model, verify)
        for batch in pieces(batches):
            ids, starts = codec.encode(batch.column("text"))
            lists = pa.ListArray.from_arrays(starts.astype(np.int32), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "sp_ids"])

    return docs.mapInArrow(run, schema)


def decode(docs: DataFrame, model: bytes, ids: str = "sp_ids", text: str = "sp_text") -> DataFrame:
    """``docs`` with the text that the ids stand for; a null list is an empty text."""
    docs = docs.drop(text)
    schema = T.StructType([*docs.schema.fields, T.StructField(text, T.StringType())])

    def run(batches):
        codec = _codec(model, False)
        for batch in batches:
            lists = batch.column(ids)
            lists = lists.fill_null([]) if lists.null_count else lists
            starts = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]).astype(np.int64)
            raw, at = codec.decode(lists.flatten().to_numpy(), starts)
            body = raw.tobytes()
            texts = [body[a:b].decode("utf-8", "replace") for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, text]
            )

    return docs.mapInArrow(run, schema)


def digest(docs: DataFrame, model: bytes, verify: bool = True) -> DataFrame:
    """One row per document: its number of ids, their CRC-32 as little-endian unsigned 32-bit
    integers, the SHA-256 of the decoded text, and whether that is the text itself.

    Encodes and decodes batch by batch, so that no ids are stored. Null texts count as empty and
    come back as empty; equal rows give equal rows; columns other than ``doc_id`` and ``text``
    aren't read. A literal U+2581 decodes to a space, so such a text has ``round_trip`` false.
    """

    def run(batches):
        codec = _codec(model, verify)
        for batch in pieces(batches):
            ids, starts = codec.encode(batch.column("text"))
            raw, at = codec.decode(ids, starts)
            was, was_at = text_bytes(batch.column("text"))
            id_bytes, now, before = ids.astype("<u4").tobytes(), raw.tobytes(), was.tobytes()
            crc, sha, same = [], [], []
            for i in range(batch.num_rows):
                crc.append(zlib.crc32(id_bytes[4 * starts[i] : 4 * starts[i + 1]]))
                text = now[at[i] : at[i + 1]]
                sha.append(hashlib.sha256(text).hexdigest())
                same.append(text == before[was_at[i] : was_at[i + 1]])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(np.diff(starts)),
                    pa.array(crc, pa.int64()),
                    pa.array(sha),
                    pa.array(same),
                ],
                ["doc_id", "n_ids", "ids_crc32", "decoded_sha256", "round_trip"],
            )

    schema = "doc_id long, n_ids long, ids_crc32 long, decoded_sha256 string, round_trip boolean"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
