"""SentencePiece codec and token shards: parity with the libraries, exact round trips."""

import hashlib
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallybook.llm import queries, sentencepiece_codec, token_output
from tests.llm.conftest import odd_rows

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXT = st.text(alphabet=st.one_of(st.sampled_from("ab the<|>.,'!é ß\n\t▁  日\x00"), st.characters(codec="utf-8")), max_size=40)


@pytest.fixture(scope="module")
def codec():
    return sentencepiece_codec.Codec(queries.piece_model(), verify=True)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_proto=queries.piece_model())


@pytest.fixture(scope="module")
def whole_tokenizer():
    return Tokenizer.from_file(PATH)


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(TEXT, min_size=1, max_size=4))
def test_ids_are_those_of_the_library(codec, library, texts):
    ids, starts = codec.encode(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[starts[i] : starts[i + 1]].tolist() == library.encode(text)
    raw, at = codec.decode(ids, starts)
    body = raw.tobytes()
    assert [body[a:b].decode() for a, b in zip(at[:-1], at[1:], strict=True)] == [t.replace("▁", " ") for t in texts]


def test_documents_at_the_smallest_scale(spark, small, library):
    rows = {r["doc_id"]: r for r in queries.op5_sentencepiece(spark, "/root/testdata/sf0.001").collect()}
    for r in small("documents").collect():
        ids = np.array(library.encode(r["text"]), "<u4")
        row = rows[r["doc_id"]]
        assert (row["n_ids"], row["ids_crc32"], row["round_trip"]) == (len(ids), zlib.crc32(ids.tobytes()), True)
        assert row["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()


def message(*fields):
    """A protobuf message of (number, value) fields: bytes, float or int."""
    out = b""
    for number, value in fields:
        if isinstance(value, float):
            out += bytes([number << 3 | 5]) + struct.pack("<f", value)
        elif isinstance(value, int):
            head = number << 3
            out += (bytes([head]) if head < 128 else bytes([head & 127 | 128, head >> 7])) + bytes([value])
        else:
            out += bytes([number << 3 | 2, len(value)]) + value
    return out


def test_unigram_model_with_byte_fallback():
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    pieces += [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    pieces += [(p, s, 1) for p, s in (("▁", -3.0), ("▁the", -1.0), ("▁t", -2.5), ("he", -2.0), ("t", -4.0), ("h", -4.5), ("e", -3.5), ("▁he", -2.2))]
    data = b"".join(message((1, message((1, p.encode()), (2, s), (3, k)))) for p, s, k in pieces)
    data += message((2, message((3, 1), (35, 1))))
    data += message((3, message((1, b"identity"), (3, 1), (4, 0), (5, 1))))
    model = sentencepiece_codec.Model.parse(data)
    assert (model.model_type, model.byte_fallback, model.extra_spaces_removed) == (1, True, False)
    codec = sentencepiece_codec.Codec(data)
    library = sentencepiece.SentencePieceProcessor(model_proto=data)
    texts = ["the", "he the  the", "", "tehéx the", "ttt", " the "]
    ids, starts = codec.encode(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[starts[i] : starts[i + 1]].tolist() == library.encode(text)


def test_columns_and_odd_texts(odd, none):
    model = queries.piece_model()
    back = sentencepiece_codec.decode(sentencepiece_codec.encode(odd, model), model)
    rows = back.select("doc_id", "text", "sp_text", "score").collect()
    assert sorted((str(r["doc_id"]), r["sp_text"]) for r in rows) == sorted(
        (str(i), (t or "").replace("▁", " ")) for i, t in odd_rows()
    )
    found = sentencepiece_codec.digest(odd, model).collect()
    assert len(found) == len(odd_rows()) and [r["doc_id"] for r in found if not r["round_trip"]] == [13]
    assert sentencepiece_codec.digest(none, model).count() == 0


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(TEXT, min_size=1, max_size=4))
def test_word_parts_encode_like_whole_texts(whole_tokenizer, texts):
    ids, starts = token_output.word_bpe(PATH).encode(pa.array(texts))
    for i, text in enumerate(texts):
        want = whole_tokenizer.encode(text, add_special_tokens=False).ids
        assert ids[starts[i] : starts[i + 1]].tolist() == want, text


def test_special_tokens_and_case():
    whole, parts = Tokenizer.from_file(PATH), token_output.word_bpe(PATH)
    for text in ("x<|endoftext|>Y, <|startoftext|>.", "<|ENDOFTEXT|>", "DON'T. It's'S", "ÉA. É.. Σ. İ.", "A<B. a|b|"):
        assert parts.encode(pa.array([text]))[0].tolist() == whole.encode(text, add_special_tokens=False).ids


def test_punctuation_is_no_part_of_a_word():
    """A word is encoded once, whatever follows it, in the middle of a text as well as at its end."""
    words = token_output.WordBpe(PATH)
    texts = ["one, two. three### one two, three", "Éa! éa, one###", "#### a1, ,"]
    ids, starts = words.encode(pa.array(texts))
    whole = Tokenizer.from_file(PATH)
    for i, text in enumerate(texts):
        assert ids[starts[i] : starts[i + 1]].tolist() == whole.encode(text, add_special_tokens=False).ids
    assert len(words.parts.hashes) == len({"one", "two", "three", "éa", "Éa", ",", ".", "###", "!", "####", "a1,"})


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 5), max_size=60), max_size=6), st.integers(1, 4))
def test_grammar_gives_back_every_id(docs, least):
    ids = np.array([i for d in docs for i in d], np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
    symbols, places, rules, base = token_output.compress(ids, starts, rounds=5, per_round=3, least=least)
    assert token_output.expand(symbols, rules, base).tolist() == ids.tolist()
    for k, d in enumerate(docs):
        assert token_output.expand(symbols[places[k] : places[k + 1]], rules, base).tolist() == d
    shard = token_output.Shard(token_output.pack(np.arange(len(docs)), ids, starts))
    assert shard.all().tolist() == ids.tolist()
    for k, d in enumerate(docs):
        assert shard.document(k).tolist() == d
        assert shard.ids(k, len(d) // 3, len(d)).tolist() == d[len(d) // 3 :]


def test_grammar_gets_smaller_and_checks_itself():
    ids = np.tile(np.array([7, 8, 9, 7, 8], np.uint32), 5_000)
    payload = token_output.pack(np.array([1]), ids, np.array([0, len(ids)]))
    assert len(payload) < len(ids) and token_output.Shard(payload).lengths.max() > 2
    with pytest.raises(ValueError):
        token_output.Shard(payload[:-9] + bytes([payload[-9] ^ 1]) + payload[-8:])


def shards_of(spark, docs, tmp_path, **more):
    path = f"{tmp_path}/shards"
    token_output.write_shards(docs, path, lambda: token_output.word_bpe(PATH), **more)
    return spark.read.parquet(path)


@pytest.mark.parametrize("shard_tokens", [1, 300, 4_000_000])
def test_shards_hold_documents_in_order(spark, odd, tmp_path, shard_tokens):
    shards = shards_of(spark, odd, tmp_path, shard_tokens=shard_tokens)
    got = [tuple(r) for r in token_output.read_shards(shards).collect()]
    whole = Tokenizer.from_file(PATH)
    rows = sorted(((i, t or "") for i, t in odd_rows()), key=lambda r: (r[0] is not None, r))
    want = []
    for doc_id, text in rows:
        ids = np.array([*whole.encode(text, add_special_tokens=False).ids, 2], "<u4")
        want.append((doc_id, len(ids), zlib.crc32(ids.tobytes())))
    assert sorted(((d, n, c) for d, _, n, c in got), key=repr) == sorted(want, key=repr)
    by_start = sorted(got, key=lambda r: r[1])
    assert [r[0] for r in by_start] == [r[0] for r in rows]
    assert [r[1] for r in by_start] == np.concatenate([[0], np.cumsum([r[2] for r in by_start])[:-1]]).tolist()
    texts = {r["doc_id"]: r["ids"] for r in token_output.read_documents(shards).collect()}
    assert texts[5] == [2] and len(texts[10]) > 12_000


def test_registered_shards(spark, small):
    whole, start = Tokenizer.from_file(PATH), 0
    rows = {r["doc_id"]: r for r in queries.op8_token_output(spark, "/root/testdata/sf0.001").collect()}
    for r in small("documents").orderBy("doc_id").collect():
        ids = np.array([*whole.encode(r["text"], add_special_tokens=False).ids, 2], "<u4")
        assert tuple(rows[r["doc_id"]]) == (r["doc_id"], start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_empty_table(spark, none, tmp_path):
    assert token_output.read_shards(shards_of(spark, none, tmp_path)).count() == 0


def test_grammar_folds_until_no_pair_is_worth_a_rule():
    """Copies of a passage become a few symbols, and no number of pairs is too many."""
    passage = np.random.default_rng(3).permutation(20_000).astype(np.uint32)
    ids = np.tile(passage, 8)
    symbols, _, rules, base = token_output.compress(ids, np.array([0, len(ids)]))
    assert token_output.expand(symbols, rules, base).tolist() == ids.tolist()
    assert len(symbols) < 40 and len(rules) > 6_144
    pairs = np.unique(np.stack([symbols[:-1], symbols[1:]]), axis=1, return_counts=True)[1]
    assert pairs.max() < 2 * token_output.LEAST_SAVED
