import collections
import hashlib

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tallybook.llm import queries, token_alignment
from tallybook.llm.token_alignment import digest

PATH = public_tokenizers.path("byte_bpe_50k.json")
MARKS = {c: b for c, b in token_alignment._byte_marks().items()}


@pytest.fixture(scope="module")
def tools():
    a = Tokenizer.from_file(PATH)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_proto=queries.piece_model())


def tokens(tools, text):
    """Ids and bytes of A's and of B's tokens."""
    a, b = tools
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    bytes_a = [bytes(MARKS[c] for c in a.id_to_token(i)) for i in ids_a]
    piece = b.id_to_piece
    bytes_b = [bytes([int(piece(i)[3:5], 16)]) if b.is_byte(i) else piece(i).replace("▁", " ").encode() for i in ids_b]
    return ids_a, bytes_a, ids_b, bytes_b


def ranges(parts):
    at, found = 0, []
    for p in parts:
        found.append((at, at + len(p)))
        at += len(p)
    return found


def brute(tools, rows):
    links, groups = [], []
    for _, text in rows:
        own, text_groups, n_a, n_b = [], [], 0, 0
        if text:
            ids_a, bytes_a, ids_b, bytes_b = tokens(tools, text)
            whole = (" " + text).encode()
            if b"".join(bytes_a) == whole == b"".join(bytes_b):
                n_a, n_b = len(ids_a), len(ids_b)
                spans_a, spans_b = ranges(bytes_a), ranges(bytes_b)
                first = 0
                for i, (a0, a1) in enumerate(spans_a):
                    while first < n_b and spans_b[first][1] <= a0:
                        first += 1
                    j = first
                    while j < n_b and spans_b[j][0] < a1:
                        own.append((ids_a[i], ids_b[j]))
                        j += 1
                ends = sorted({e for _, e in spans_a} & {e for _, e in spans_b})
                left, right = iter(zip(spans_a, ids_a)), iter(zip(spans_b, ids_b))
                for end in ends:
                    sides = []
                    for side in (left, right):
                        taken = []
                        for (_, e), i in side:
                            taken.append(str(i))
                            if e == end:
                                break
                        sides.append(",".join(taken))
                    text_groups.append("|".join(sides))
        links.append(own)
        groups.append((n_a, n_b, text_groups))
    count = collections.Counter(x for own in links for x in own)
    top = collections.Counter()
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    return [
        (
            d, n_a, n_b, len(g), len(own),
            sum(count[x] == top[x[1]] for x in own),
            sum(count[x] for x in own),
            hashlib.sha256(";".join(g).encode()).hexdigest() if n_a else "",
        )
        for (d, _), own, (n_a, n_b, g) in zip(rows, links, groups, strict=True)
    ]


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def check(tools, df, most_pairs=token_alignment.MOST_PAIRS):
    got = digest(df, PATH, queries.piece_model(), most_pairs).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(tools, pairs(df)), key=str)


@pytest.fixture(scope="module")
def strange(spark):
    texts = [
        "<|endoftext|> is plain here, </s> <s> <unk> <0x0A> too",
        "  two  spaces   and a tab\there\r\n\nlines   end ",
        "日本語 テキスト 🙂🙂 zero​width é \U0001f9d1‍\U0001f4bb",
        "under▁score",
        "▁",
        " ",
        "\x00\x01 nul",
        "x" * 5000,
        "a \u00a0b  \u3000 c\u0085 d\n  e \n f\t g \th  ",
        " lead", "end ", "\n", "é é ñ  ñ", "it's  it 's 'll 've", "\x7f \x1f x",
        "don't can't we'll 1234567890 http://a.b/c?d=e&f",
        "the cat sat on the mat " * 40,
    ]
    return spark.createDataFrame(list(enumerate(texts * 2)), "doc_id long, text string").repartition(3)


def test_strange_texts(tools, strange):
    check(tools, strange)


def test_pairs_beyond_the_table_meet_their_counts(tools, strange):
    check(tools, strange, 40)
    check(tools, strange, 0)


def test_odd_texts(tools, odd, none, monkeypatch):
    check(tools, odd)
    monkeypatch.setattr(token_alignment, "MOST_WINDOWS", 50)
    check(tools, odd)
    assert digest(none, PATH, queries.piece_model()).count() == 0
    empty = odd.filter("text IS NULL OR text = ''")
    assert {tuple(r)[1:] for r in digest(empty, PATH, queries.piece_model()).collect()} == {(0, 0, 0, 0, 0, 0, "")}


def test_registered_query(tools, spark, small):
    got = queries.op13_token_alignment(spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, got)) == sorted(brute(tools, pairs(small("documents"))))
