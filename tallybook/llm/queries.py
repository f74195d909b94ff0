"""The registered queries of this subpackage: each operator with production settings over whole tables."""

from __future__ import annotations

import functools
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallybook.llm import (
    collocations,
    decontamination,
    jaccard_join,
    language_id,
    lm_scoring,
    quality_classifier,
    quality_rules,
    sentencepiece_codec,
    substring_dedup,
    suffix_dedup,
    token_alignment,
    token_output,
    toxicity,
)
from tallybook.session import scratch_path


_ROOT = str(Path(__file__).resolve().parents[2])
ROWS_PER_BATCH = 1_000
"""Rows that Spark hands to Python at once: long texts would make much larger batches of its 10,000."""


def prepare(spark: SparkSession) -> None:
    """Lets local Python workers find this package from any folder, and hands them small batches."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def piece_model() -> bytes:
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        return file.read()


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return quality_rules.judged(docs, labels).select("doc_id", *quality_rules.COUNTS, "base_failed", "kept")


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.classes(_table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predicted(_table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return quality_classifier.predicted(docs, labels)


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.digest(_table(spark, sf_dir, "documents"), piece_model())


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return toxicity.predicted(docs, labels)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(_table(spark, sf_dir, "documents"))


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-shards")
    encoder = functools.partial(token_output.word_bpe, public_tokenizers.path("word_bpe_49k.json"))
    token_output.write_shards(_table(spark, sf_dir, "documents"), path, encoder)
    return token_output.read_shards(spark.read.schema(token_output.SHARD_SCHEMA).parquet(path))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.hits(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.scored(_table(spark, sf_dir, "documents"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(_table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.best(_table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_alignment.digest(_table(spark, sf_dir, "documents"), path, piece_model())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_language_id": op3_language_id,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_toxicity": op6_toxicity,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_token_output": op8_token_output,
    "op9_decontamination": op9_decontamination,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_collocations": op12_collocations,
    "op13_token_alignment": op13_token_alignment,
}
_WORD = r"'[^\x20\x09-\x0D]+'"
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_JACCARD = f"""
WITH RECURSIVE
words AS (SELECT doc_id, regexp_extract_all(coalesce({_LOWERED}, ''), {_WORD}) AS ws FROM documents),
grams AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(ws) >= 5 THEN list_transform(range(len(ws) - 4), lambda i: array_to_string(ws[i + 1 : i + 5], ' '))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id),
links AS (
  SELECT a, b FROM shared JOIN sizes p ON a = p.doc_id JOIN sizes q ON b = q.doc_id
  WHERE 100 * c >= 75 * (p.n + q.n - c)),
reached(doc_id, r) AS (
  SELECT doc_id, doc_id FROM words
  UNION SELECT reached.doc_id, links.b FROM reached JOIN links ON reached.r = links.a)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(r) AS component_id
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""

_DEDUP = f"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) AS ws FROM documents),
windows AS (
  SELECT doc_id, p, array_to_string(ws[p + 1 : p + 13], ' ') AS k
  FROM (SELECT doc_id, ws, unnest(range(len(ws) - 12)) AS p FROM words WHERE len(ws) >= 13)),
firsts AS (SELECT k, min(doc_id) AS first_doc FROM windows GROUP BY k),
gone AS (
  SELECT DISTINCT doc_id, p + j AS p
  FROM windows JOIN firsts USING (k), (SELECT unnest(range(13)) AS j) WHERE doc_id > first_doc),
single AS (SELECT doc_id, unnest(range(len(ws))) AS p, unnest(ws) AS word FROM words),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text
  FROM single ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""

ORACLES: dict[str, str] = {
    "op2_jaccard_join": _JACCARD,
    "op7_substring_dedup": _DEDUP,
    "op9_decontamination": decontamination.oracle(),
    "op11_suffix_dedup": suffix_dedup.oracle(),
    "op12_collocations": collocations.oracle(),
}
