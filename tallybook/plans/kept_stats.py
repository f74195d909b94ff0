"""Statistics of tables kept between runs: only files that came since the last one are counted.

The kept table has a row per file, ``file, format, length, modified, row_count``. Every run lists the
tables, which reads names, lengths and times alone, counts the rows of files that are new or whose
length or time differs, and drops those that have gone. A file that is replaced by one of the same
length within the same millisecond looks the same and is not counted again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.operators.joins import sized_join
from tallybook.plans.stats import (
    Placed,
    file_address,
    listed_files,
    placed_tables,
    rows_per_file,
    stats_of_files,
)
from tallybook.session import materialise
from tallybook.sources.tables import TableRef, read_table, replace_table, table_exists

FILE = ["file", "format", "length", "modified"]
FILES_BY_NAME = 20_000
"""As many changed files are opened by their names, which the driver hands out; beyond that the folders
that hold changed files are counted whole and the unchanged ones left out of the result."""


def _listed(spark: SparkSession, placed: Placed) -> DataFrame:
    """``FILE`` and the file's own ``path`` of all files of the tables."""
    parts = [
        listed_files(spark, folders).withColumn("format", F.lit(format))
        for format, folders in placed.formats.items()
    ]
    return reduce(DataFrame.unionAll, parts).select(*FILE, "path")


def _counted(spark: SparkSession, fresh: DataFrame, n_fresh: int, placed: Placed) -> DataFrame:
    """``file, format, row_count`` of the changed files that have rows."""
    empty = spark.createDataFrame([], "file string, format string, row_count long")
    if n_fresh == 0:
        return empty
    if n_fresh <= FILES_BY_NAME:
        named: dict[str, list[str]] = {}
        for row in fresh.select("format", "path").collect():
            named.setdefault(row["format"], []).append(row["path"])
    else:
        named = _folders_of(spark, fresh, placed)
    parts = [rows_per_file(spark, f, paths).withColumn("format", F.lit(f)) for f, paths in named.items()]
    counted = reduce(DataFrame.unionAll, parts).select("file", "format", "row_count")
    if n_fresh <= FILES_BY_NAME:
        return counted
    return counted.join(fresh.select("file", "format"), ["file", "format"], "left_semi")


def _folders_of(spark: SparkSession, fresh: DataFrame, placed: Placed) -> dict[str, list[str]]:
    """The tables' folders that hold changed files; as many names as the tables have folders."""
    folders = [(format, f, file_address(spark, f)) for format, found in placed.formats.items() for f in found]
    known = spark.createDataFrame(folders, "format string, name string, folder string")
    under = F.startswith(F.col("file"), F.concat("folder", F.lit("/"))) | (F.col("file") == F.col("folder"))
    changed = F.broadcast(known).join(fresh.select("file", F.col("format").alias("_f")), under & (F.col("_f") == F.col("format")))
    named: dict[str, list[str]] = {}
    for row in changed.select("format", "name").distinct().collect():
        named.setdefault(row["format"], []).append(row["name"])
    return named


def refreshed_files(spark: SparkSession, placed: Placed, kept: TableRef) -> tuple[DataFrame, int]:
    """The kept table brought up to date, and how many files had to be counted."""
    listed, _ = materialise(_listed(spark, placed), "listed")
    if not table_exists(spark, kept):
        known = spark.createDataFrame([], listed.select(*FILE).schema.add("row_count", "long"))
    else:
        known = read_table(spark, kept).select(*FILE, "row_count")
    fresh, n_fresh = materialise(listed.join(known.select(*FILE), FILE, "left_anti"), "fresh")
    counted = sized_join(fresh.select(*FILE), _counted(spark, fresh, n_fresh, placed), ["file", "format"])
    added = counted.withColumn("row_count", F.coalesce("row_count", F.lit(0)))
    unchanged = known.join(listed.select(*FILE), FILE, "left_semi")
    replace_table(unchanged.unionByName(added.select(*FILE, "row_count")), kept)
    return read_table(spark, kept), n_fresh


def kept_table_stats(spark: SparkSession, registry: DataFrame, kept: TableRef) -> tuple[DataFrame, int]:
    """``plans.stats.table_stats`` of the registry, and the number of files that were opened for it.

    ``kept`` names the table that one run leaves for the next; one per registry, as files of tables that the
    registry doesn't have are dropped from it. It is replaced only when it is whole: a run that dies
    leaves the one before. Catalog objects without files, such as views, are counted each time.
    """
    placed = placed_tables(spark, registry)
    if not placed.owners:
        return stats_of_files(spark, placed, None), 0
    files, n_fresh = refreshed_files(spark, placed, kept)
    return stats_of_files(spark, placed, files.select("file", "length", "row_count")), n_fresh
