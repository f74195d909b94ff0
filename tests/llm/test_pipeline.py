"""The pipeline against a version that does each stage by brute force."""

import hashlib
import zlib

import numpy as np
import sentencepiece

import __spark_entry__ as contract
import corpus_pipeline
from tallybook.llm import decontamination, quality_classifier, queries
from tests.llm.test_jaccard_join import brute as linked
from tests.llm.test_substring_dedup import brute as cut

SF = "/root/testdata/sf0.001"


def test_stages_are_registered():
    assert contract.queries()["pipeline"].args == (corpus_pipeline.run,)
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "ngram_jaccard_join", "substring_dedup", "benchmark_decontamination", "sentencepiece",
    ]
    assert set(queries.QUERIES) <= set(contract.queries())


def test_rows_of_run(spark, small):
    got = sorted(map(tuple, corpus_pipeline.run(spark, SF).collect()))
    docs = small("documents")
    model = quality_classifier.fit(docs, small("labels"), "quality")
    scores = quality_classifier.with_scores(docs, model).collect()
    rows = [(r["doc_id"], r["text"]) for r in scores if r["quality_score"] >= 0.5]
    assert 0 < len(rows) < docs.count()
    first = {d for d, _, component in linked(rows) if d == component}
    rows = [(d, t) for d, t in rows if d in first]
    rows = [(d, kept.decode() if gone else t) for (d, t), (_, _, gone, kept) in zip(rows, cut(rows), strict=True)
            if not gone or kept]
    left = spark.createDataFrame(rows, "doc_id long, text string")
    leaking = {r["doc_id"] for r in decontamination.hits(left, small("benchmark")).collect()}
    library = sentencepiece.SentencePieceProcessor(model_proto=queries.piece_model())
    want = []
    for doc, text in rows:
        if doc not in leaking:
            ids = np.array(library.encode(text), "<u4")
            want.append((doc, len(ids), zlib.crc32(ids.tobytes()), hashlib.sha256(text.encode()).hexdigest(), True))
    assert got == sorted(want)


def test_inner_stages_return_the_columns_of_documents(spark, odd):
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, SF)
        assert found.columns == docs.columns
        rows = {r["doc_id"]: r for r in found.collect()}
        assert all(r["n_chars"] == len(r["text"] or "") for r in rows.values())
        assert 10 in rows and stage(spark, docs.filter("false"), SF).count() == 0
