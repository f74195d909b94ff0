"""A bucketed table of a ledger's row keys, so that looking for unseen rows moves the source alone.

The keys of every committed batch stand in a table of the session's catalog, in as many buckets as it
was made with, by the key's hash. A join on the key then reads bucket by bucket; the ledger's side is
never shuffled, however long it grows. Each batch is one partition, marked when it is whole: a run that
dies leaves its batch unmarked, and the next one writes that again from the ledger, which decides what
is there. Keys of different generations of types stand in tables of their own.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.functions import KEY, row_key
from tallybook.operators.rows import conform
from tallybook.sources.paths import delete_folder, list_names, make_mark
from tallybook.sources.tables import (
    TableRef,
    batch_generation,
    is_ledger,
    ledger_batches,
    quoted_name,
    without_key,
)

BUCKETS = 64
CATALOG = "spark_catalog"
_WHOLE = "_whole"


@dataclass(frozen=True)
class KeyIndex:
    """Names the table of keys in the session's catalog, and its number of buckets.

    A bucket should hold what a task can sort: 32 bytes a row. The number is fixed with the table.
    """

    schema: str
    table: str
    buckets: int = BUCKETS

    def name(self, generation: int) -> str:
        return quoted_name(CATALOG, self.schema, f"{self.table}_g{generation}")


def _location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"].rstrip("/")


def _batch_name(folder: str) -> str:
    return folder.rpartition("/")[2]


def _keys_of(spark: SparkSession, ref: TableRef, folders: list[str]) -> DataFrame:
    """``KEY, batch`` of some batches, in the types that the ledger has now."""
    latest = ledger_batches(spark, ref.path)[-1]
    now = spark.read.parquet(latest).schema
    parts = []
    for folder in folders:
        if batch_generation(folder) == batch_generation(latest):
            keys = spark.read.schema(now).parquet(folder).select(KEY)
        else:
            schema = without_key(now)
            keys = conform(spark.read.parquet(folder).drop(KEY), schema).select(row_key(schema).alias(KEY))
        parts.append(keys.withColumn("batch", F.lit(_batch_name(folder))))
    return reduce(DataFrame.unionByName, parts)


def synced_keys(spark: SparkSession, ref: TableRef, index: KeyIndex) -> DataFrame:
    """The keys of all committed batches of the ledger ``ref``, bucketed; those that the table lacks are added first."""
    if not is_ledger(ref):
        raise ValueError("only a ledger stores row keys")
    folders = ledger_batches(spark, ref.path)
    if not folders:
        raise FileNotFoundError(f"{ref.name} has no committed batch")
    name = index.name(batch_generation(folders[-1]))
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted_name(CATALOG, index.schema)}")
    whole: set[str] = set()
    if spark.catalog.tableExists(name):
        place = _location(spark, name)
        whole = set(list_names(spark, f"{place}/{_WHOLE}"))
        for left in list_names(spark, place):
            if left.startswith("batch=") and left.removeprefix("batch=") not in whole:
                delete_folder(spark, f"{place}/{left}")
    missing = [f for f in folders if _batch_name(f) not in whole]
    if missing:
        rows = _keys_of(spark, ref, missing).repartition(index.buckets, KEY)
        writer = rows.write.mode("append").partitionBy("batch").bucketBy(index.buckets, KEY).sortBy(KEY)
        writer.saveAsTable(name)
        place = _location(spark, name)
        for folder in missing:
            make_mark(spark, f"{place}/{_WHOLE}/{_batch_name(folder)}")
    spark.catalog.refreshTable(name)
    return spark.table(name).select(KEY)


def drop_keys(spark: SparkSession, index: KeyIndex) -> None:
    """Drop the tables of keys of all generations; the next run makes the one it needs anew."""
    if not spark.catalog.databaseExists(f"{CATALOG}.{index.schema}"):
        return
    prefix = f"{index.table}_g"
    for found in spark.catalog.listTables(f"{CATALOG}.{index.schema}"):
        if not found.isTemporary and found.name.startswith(prefix) and found.name.removeprefix(prefix).isdigit():
            spark.sql(f"DROP TABLE {quoted_name(CATALOG, index.schema, found.name)}")
