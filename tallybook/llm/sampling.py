"""Bounded samples of labelled rows for fitting on the driver, the same in every run."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.session import materialise

_STEPS = 1 << 30
ROWS_PER_FILE = 1_000_000
LEAST_FILES = 8


def crc_is(modulus: int, remainder: int) -> Column:
    """Whether the CRC-32 of ``doc_id`` as text leaves ``remainder``; a null id counts as not."""
    crc = F.crc32(F.col("doc_id").cast("string"))
    return F.coalesce(F.pmod(crc, F.lit(modulus)) == remainder, F.lit(False))


def bounded(rows: DataFrame, label: str, most: int, *keys: str) -> DataFrame:
    """About ``most`` rows at most, as many of each label as there are, up to equal shares.

    Rows are chosen by a hash of ``keys`` (``doc_id`` without any) below a limit that follows from the label's count, so
    only ids and labels are read to choose and no row is moved. Null labels are left out.
    """
    rows = rows.filter(F.col(label).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(label).agg(F.count(F.lit(1))).collect()}
    if not counts:
        return rows
    share = most // len(counts)
    place = F.pmod(F.xxhash64(F.lit("sample"), *(keys or ("doc_id",))), F.lit(_STEPS))
    limits = [
        (F.col(label) == value) & (place < min(_STEPS, int(_STEPS * share / count)))
        for value, count in counts.items()
    ]
    return rows.filter(functools.reduce(operator.or_, limits))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, most: int, held_out: Column | None = None
) -> tuple[DataFrame, dict[int, int]]:
    """``doc_id, text, goal`` of at most about ``most`` labelled documents, and how many documents have each label.

    Documents are told apart by id and text together, and chosen by a hash of both, so that an id
    with very many rows gives no more than its share; copies of one row count once. Only labels of
    documents that are there count. Ids and hashes are joined with the labels; the few chosen are
    then broadcast to the texts, so that no text is moved. Labels other than 0 and 1 and those of
    held-out ids are left out; without any that match, the sample is empty.
    """
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("goal"))
    rows = rows.filter("goal IN (0, 1) AND doc_id IS NOT NULL")
    if held_out is not None:
        rows = rows.filter(~held_out)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tag"))
    known = texts.select("doc_id", "tag").join(rows, "doc_id").distinct()
    # rows of 20 bytes, dealt evenly: a file for each of the join's tasks would cost more than the rows, in memory too
    files = max(LEAST_FILES, labels.count() // ROWS_PER_FILE)
    known, _ = materialise(known.repartition(files), "labelled")
    counts = {r[0]: r[1] for r in known.groupBy("goal").count().collect()}
    chosen = bounded(known, "goal", most, "doc_id", "tag")
    found = texts.join(F.broadcast(chosen), ["doc_id", "tag"]).dropDuplicates(["doc_id", "tag", "goal"])
    return found.select("doc_id", "text", "goal"), counts
