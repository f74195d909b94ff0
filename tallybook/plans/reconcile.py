"""Reconciliation: do the sources add up to what was written, in number and in content?"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions import KEY, row_key
from tallybook.operators.aggregates import source_counts
from tallybook.operators.rows import conform, reject_key_name, union_sources, widened_schema
from tallybook.operators.types import keeps_text
from tallybook.session import materialise

PREFIX_BYTES = 2
"""Rows are first summed up by this many bytes of their keys: at most 65,536 groups, whatever the tables."""


def reconcile(
    sources: Mapping[str, Mapping[str, DataFrame]], targets: Mapping[str, DataFrame]
) -> DataFrame:
    """Per table: rows of all sources, rows of the written target, and whether they agree.

    ``sources`` maps table -> catalog -> rows, ``targets`` table -> rows. All counts of all
    tables come from one job. A table without a target, or without sources, counts 0 there.
    """
    numbered = [("source", table, df) for table, group in sources.items() for df in group.values()]
    numbered += [("target", table, df) for table, df in targets.items()]
    spark = numbered[0][2].sparkSession if numbered else None
    if spark is None:
        raise ValueError("nothing to reconcile")
    counts = source_counts({str(i): df for i, (_, _, df) in enumerate(numbered)})
    named = [(str(i), side, table) for i, (side, table, _) in enumerate(numbered)]
    counts = counts.join(F.broadcast(spark.createDataFrame(named, "source string, side string, table string")), "source")

    def total(side: str):
        return F.sum(F.when(F.col("side") == side, F.col("row_count")).otherwise(0))

    return (
        counts.groupBy("table")
        .agg(total("source").alias("source_rows"), total("target").alias("target_rows"))
        .withColumn("ok", F.col("source_rows") == F.col("target_rows"))
    )


def _keys(df: DataFrame, side: str) -> DataFrame:
    mine = F.lit(1 if side == "source" else 0).cast("long")
    return df.select(KEY, mine.alias("s"), (1 - mine).alias("t"))


def _prefix():
    return F.substring(F.col(KEY), 1, PREFIX_BYTES)


def differing_prefixes(keys: DataFrame) -> DataFrame:
    """Key prefixes whose rows don't agree: ``prefix``.

    ``keys`` has a row key and how often it stands in the sources (``s``) and in the target (``t``). A
    multiset is summed up as its count, the sum and the xor of its hashes; both sides go in one
    aggregate, in which equal ones cancel out. The groups are few and combine map-side.
    """
    hashed = F.xxhash64(KEY).cast("decimal(38, 0)")
    signed = (F.col("s") - F.col("t")).cast("decimal(38, 0)")
    parts = keys.groupBy(_prefix().alias("prefix")).agg(
        F.sum(F.col("s") - F.col("t")).alias("n"),
        F.sum((hashed * signed).cast("decimal(38, 0)")).alias("sum"),
        F.bit_xor(F.when((F.col("s") + F.col("t")) % 2 == 1, F.xxhash64(F.lit("x"), KEY)).otherwise(0)).alias("xor"),
    )
    return parts.filter("n <> 0 OR sum <> 0 OR xor <> 0").select("prefix")


def reconcile_content(sources: Mapping[str, DataFrame], target: DataFrame) -> DataFrame:
    """The rows that don't stand as often in the target as in all sources together.

    Gives the columns (of sources and target, in their common types) with ``source_rows`` and
    ``target_rows``, one row for each content that differs; none when all is well. A target read
    ``with_key`` lends its stored keys.

    Three steps, each of which reads less than the one before: keys of all rows are summed up by prefix;
    keys of differing prefixes alone are counted; rows of differing keys alone are fetched. A row
    that is there a million times is one row of the shuffles.
    """
    union = union_sources(sources.values())
    if union is None:
        union = target.drop(KEY).filter("false")
    reject_key_name(union)
    plain = target.drop(KEY)
    schema = widened_schema(plain.schema, union.schema, types=True)
    stored = KEY in target.columns and keeps_text(plain.schema, schema)
    ours = conform(union, schema)
    ours = ours.withColumn(KEY, row_key(ours.schema))
    theirs = conform(plain, schema)
    theirs = theirs.withColumn(KEY, row_key(theirs.schema))
    their_keys = target.select(KEY) if stored else theirs

    keys = _keys(ours, "source").unionByName(_keys(their_keys, "target"))
    prefixes, n = materialise(differing_prefixes(keys), "differing-prefixes")
    empty = ours.drop(KEY).filter("false").withColumns({c: F.lit(0).cast("long") for c in ("source_rows", "target_rows")})
    if not n:
        return empty
    near = keys.join(F.broadcast(prefixes), _prefix() == F.col("prefix"), "left_semi")
    counted = near.groupBy(KEY).agg(F.sum("s").alias("source_rows"), F.sum("t").alias("target_rows"))
    differing, n = materialise(counted.filter("source_rows <> target_rows"), "differing-keys")
    if not n:
        return empty
    if stored:
        theirs = conform(target.select(*plain.columns, KEY), _with_key(schema, target))
    found = ours.unionByName(theirs).join(differing.select(KEY), KEY, "left_semi").dropDuplicates([KEY])
    return found.join(differing, KEY).drop(KEY)


def _with_key(schema, target: DataFrame):
    return type(schema)([*schema.fields, target.schema[KEY]])
