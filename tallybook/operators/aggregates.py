"""Distinct values and counts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.operators.rows import union_sources


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """One row with the sorted distinct values; duplicates are gone before they are gathered."""
    values = df.select(F.col(column).alias("value")).distinct()
    return values.agg(F.sort_array(F.collect_set("value")).alias("values"))


def distinct_values_csv(df: DataFrame, column: str) -> DataFrame:
    joined = F.array_join(F.col("values").cast("array<string>"), ",")
    return distinct_values(df, column).select(joined.alias("values"))


def source_counts(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per source in one job; a source without rows counts 0.

    Each source adds one marker row that is not counted, and reads none of its columns.
    """
    spark = next(iter(sources.values())).sparkSession
    markers = spark.createDataFrame([(name, 0) for name in sources], "source string, one int")
    tagged = [df.select(F.lit(n).alias("source"), F.lit(1).alias("one")) for n, df in sources.items()]
    rows = union_sources([markers, *tagged])
    return rows.groupBy("source").agg(F.sum("one").alias("row_count"))
