"""A corpus pipeline over ``documents``, built from the operators of ``tallybook.llm``.

Each stage works on all that the one before it kept, as a written table; all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm import (
    decontamination,
    jaccard_join,
    quality_classifier,
    queries,
    sentencepiece_codec,
    substring_dedup,
)
from tallybook.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the attention classifier, fitted on all labels, scores under one half."""
    queries.prepare(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_classifier.fit(docs, labels, "quality")
    scored = quality_classifier.with_scores(docs, model, "_quality")
    return scored.filter("_quality >= 0.5").drop("_quality")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of least ``doc_id`` of each group of linked documents."""
    queries.prepare(spark)
    return jaccard_join.first_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes runs of 13 words out that an earlier document has; a text left without words goes."""
    queries.prepare(spark)
    cut = substring_dedup.dedup(docs)
    changed = F.col("n_removed_words") > 0
    n_chars = F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    left = cut.filter(~changed | (F.col("text") != "")).withColumn("n_chars", n_chars)
    return left.select(*docs.columns)


def benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold an item of the benchmark."""
    queries.prepare(spark)
    return decontamination.without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes every document and decodes it again: number and checksum of ids, hash of the decoded text."""
    queries.prepare(spark)
    return sentencepiece_codec.digest(docs, queries.piece_model())


STAGES = [
    ("quality_classifier", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("benchmark_decontamination", benchmark_items),
    ("sentencepiece", sentencepiece),
]
ORACLE_SQL = None
"""The first stage learns, which SQL cannot say; tests hold ``run`` against a brute-force version."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written as Parquet to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
