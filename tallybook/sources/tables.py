"""Named tables: read, create, append with widening, replace.

A *ledger* table is a folder of batches, each an ordinary parquet folder written by one
Spark job. A batch counts once its job has committed (``_SUCCESS``), so a run that dies
half-way leaves nothing behind for readers. Every batch is written with all columns known
so far; the newest batch therefore holds the table's schema, and older files simply lack
the later columns, which the parquet reader fills with NULL. One footer is read per table and
generation, whatever its number of files. One writer per table at a time is assumed.

Each ledger row carries its strict row key in a hidden column, so that later runs find
known rows by reading 32 bytes a row.

Columns may widen in type as well. Whole numbers read wider as they are. A widening that changes what
values look like (a whole number that becomes a double, a date that becomes a timestamp) starts a new
*generation*, marked in the names of its batches: those of older ones are cast when they are read, and
their row keys are made from the cast content instead of being read.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.functions import KEY, row_key
from tallybook.operators.rows import conform, widened_schema
from tallybook.operators.types import keeps_text
from tallybook.sources.paths import folder_for_writing, list_folders, path_exists, restore_folder, swap_folder

LEDGER = "ledger"
BATCH = "batch-"
PACKED_ROWS = 100_000
"""Rows a task of the session beyond which a batch makes files of a sensible size without being packed."""
GENERATION = "-g"


@dataclass(frozen=True)
class TableRef:
    """``catalog.schema.table``, with the place of its files when it is not a catalog table."""

    catalog: str
    schema: str
    table: str
    path: str | None = None
    format: str = "parquet"

    @property
    def name(self) -> str:
        return f"{self.catalog}.{self.schema}.{self.table}"

    @classmethod
    def under(cls, root: str, catalog: str, schema: str, table: str, format: str = LEDGER):
        return cls(catalog, schema, table, f"{root.rstrip('/')}/{catalog}/{schema}/{table}", format)


def ledger_batches(spark: SparkSession, path: str) -> list[str]:
    """Paths of the committed batches, oldest first."""
    folders = [f"{path}/{n}" for n in list_folders(spark, path) if n.startswith(BATCH)]
    return [f for f in folders if path_exists(spark, f"{f}/_SUCCESS")]


def batch_generation(folder: str) -> int:
    """How often the table's types had changed when a batch was written."""
    return int(folder.rpartition("/")[2].removeprefix(BATCH).partition(GENERATION)[2] or 0)


def is_ledger(ref: TableRef) -> bool:
    return ref.path is not None and ref.format == LEDGER


def table_exists(spark: SparkSession, ref: TableRef) -> bool:
    if ref.path is None:
        return spark.catalog.tableExists(ref.name)
    if ref.format == LEDGER:
        return bool(ledger_batches(spark, ref.path))
    restore_folder(spark, ref.path)
    return path_exists(spark, ref.path)


def read_table(spark: SparkSession, ref: TableRef, with_key: bool = False) -> DataFrame:
    """The whole table; ``with_key`` keeps the row key of a ledger table."""
    if ref.path is None:
        return spark.table(ref.name)
    if ref.format != LEDGER:
        restore_folder(spark, ref.path)
        return spark.read.format(ref.format).load(ref.path)
    batches = ledger_batches(spark, ref.path)
    if not batches:
        raise FileNotFoundError(f"{ref.name} has no committed batch")
    *older, latest = _by_generation(spark, batches)
    parts = [latest if with_key else latest.drop(KEY)]
    schema = without_key(latest.schema)
    for df in older:
        cast = conform(df.drop(KEY), schema)
        parts.append(cast.withColumn(KEY, row_key(schema)) if with_key else cast)
    return reduce(DataFrame.unionByName, parts)


def _by_generation(spark: SparkSession, batches: list[str]) -> list[DataFrame]:
    """The batches of each generation, oldest first, in the types of its newest batch."""
    groups: dict[int, list[str]] = {}
    for folder in batches:
        groups.setdefault(batch_generation(folder), []).append(folder)
    newest = [spark.read.parquet(folders[-1]).schema for folders in groups.values()]
    return [spark.read.schema(s).parquet(*folders) for s, folders in zip(newest, groups.values(), strict=True)]


def load_view(
    spark: SparkSession, ref: TableRef, prefix: str | None = None, required: bool = False
) -> DataFrame | None:
    """A table that may be missing: ``None`` unless ``required``; columns prefixed on request."""
    if not required and not table_exists(spark, ref):
        return None
    df = read_table(spark, ref)
    return df if prefix is None else df.withColumnsRenamed({c: f"{prefix}_{c}" for c in df.columns})


def without_key(schema: T.StructType) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name != KEY])


def _write_batch(df: DataFrame, ref: TableRef, generation: int = 0) -> int:
    """Write one batch and return its row count, counted by the write itself."""
    spark = df.sparkSession
    number = len(list_folders(spark, ref.path)) + 1
    mark = f"{GENERATION}{generation:04d}" if generation else ""
    keyed = df if KEY in df.columns else df.withColumn(KEY, row_key(df.schema))
    written = Observation(f"{ref.name} batch {number}")
    (
        keyed.observe(written, F.count(F.lit(1)).alias("rows"))
        .write.mode("errorifexists")
        .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
        .parquet(f"{ref.path}/{BATCH}{number:08d}{mark}")
    )
    return written.get["rows"]


def quoted_name(*parts: str) -> str:
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def ensure_schema(spark: SparkSession, ref: TableRef) -> None:
    """Create the schema of a catalog table where it is missing; tables under a path need none."""
    if ref.path is None:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted_name(ref.catalog, ref.schema)}")


def _counted(df: DataFrame, ref: TableRef) -> tuple[DataFrame, Observation]:
    written = Observation(f"rows of {ref.name}")
    return df.observe(written, F.count(F.lit(1)).alias("rows")), written


def create_table(df: DataFrame, ref: TableRef) -> int:
    """Write a new table, with its schema if need be, and return its row count; fails when it is there.

    Only a ledger stores row keys; other tables hold the columns of ``df`` and nothing else.
    """
    if ref.path is not None and ref.format == LEDGER:
        if table_exists(df.sparkSession, ref):
            raise FileExistsError(f"{ref.name} exists")
        return _write_batch(df, ref)
    ensure_schema(df.sparkSession, ref)
    plain, written = _counted(df.drop(KEY), ref)
    if ref.path is None:
        plain.write.mode("errorifexists").saveAsTable(quoted_name(ref.catalog, ref.schema, ref.table))
    else:
        plain.write.mode("errorifexists").format(ref.format).save(ref.path)
    return written.get["rows"]


def append_table(
    df: DataFrame, ref: TableRef, evolve: bool = True, as_text: bool = False, row_count: int | None = None
) -> int:
    """Append and return the row count.

    New columns widen ledger and catalog tables unless ``evolve`` is off; then, and for plain
    folders of files, which keep no schema of their own, they are an error. Columns of another type
    widen ledgers to the least common type (text only ``as_text``); other tables keep their types, and a
    value that doesn't fit is an error. Keys that ``df`` carries must be those of the widened types.
    Small inputs spread over many tasks are packed into files of a sensible size on the way. Where
    ``row_count`` says that there are many rows for every task, they are not shuffled for that.
    """
    spark = df.sparkSession
    current = read_table(spark, ref).schema
    ledger = is_ledger(ref)
    many = row_count is not None and row_count >= PACKED_ROWS * spark.sparkContext.defaultParallelism
    packed = (lambda rows: rows) if many else (lambda rows: rows.hint("rebalance"))
    merged = widened_schema(current, without_key(df.schema), types=ledger and evolve, as_text=as_text)
    more = merged.fields[len(current) :]
    if more and (not evolve or not (ledger or ref.path is None)):
        raise ValueError(f"{ref.name} lacks columns {[f.name for f in more]}")
    if ledger:
        key = [T.StructField(KEY, T.BinaryType())] if KEY in df.columns else []
        generation = batch_generation(ledger_batches(spark, ref.path)[-1]) + (not keeps_text(current, merged))
        return _write_batch(packed(conform(df, T.StructType(merged.fields + key))), ref, generation)
    plain, written = _counted(packed(conform(df.drop(KEY), merged)), ref)
    if ref.path is not None:
        plain.write.mode("append").format(ref.format).save(ref.path)
        return written.get["rows"]
    name = quoted_name(ref.catalog, ref.schema, ref.table)
    if more:
        added = ", ".join(f"{quoted_name(f.name)} {f.dataType.simpleString()}" for f in more)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({added})")
    plain.write.insertInto(name)
    return written.get["rows"]


def replace_table(df: DataFrame, ref: TableRef) -> int:
    """Full overwrite of a result table; returns its row count.

    The new rows are written beside the old ones and take their place when they are whole, so a run that
    fails leaves the table as it was, and ``df`` may read the table that it replaces. A catalog
    table becomes a managed one, whatever it was.
    """
    if is_ledger(ref):
        raise ValueError("a ledger table is append-only")
    spark = df.sparkSession
    ensure_schema(spark, ref)
    plain, written = _counted(df, ref)
    if ref.path is None:
        _replace_named(plain, ref)
    else:
        fresh = folder_for_writing(ref.path)
        plain.write.format(ref.format).save(fresh)
        swap_folder(spark, ref.path, fresh)
        spark.catalog.refreshByPath(ref.path)
    return written.get["rows"]


def _replace_named(df: DataFrame, ref: TableRef) -> None:
    """Write a table beside the named one, then rename both; the old one comes back if that fails."""
    spark, mark = df.sparkSession, uuid.uuid4().hex[:12]
    name = quoted_name(ref.catalog, ref.schema, ref.table)
    if not table_exists(spark, ref):
        df.write.mode("errorifexists").saveAsTable(name)
        return
    fresh, old = f"{ref.table}__writing_{mark}", f"{ref.table}__replaced_{mark}"
    full = lambda table: quoted_name(ref.catalog, ref.schema, table)
    df.write.mode("errorifexists").saveAsTable(full(fresh))
    spark.sql(f"ALTER TABLE {name} RENAME TO {quoted_name(ref.schema, old)}")
    try:
        spark.sql(f"ALTER TABLE {full(fresh)} RENAME TO {quoted_name(ref.schema, ref.table)}")
    except Exception:
        spark.sql(f"ALTER TABLE {full(old)} RENAME TO {quoted_name(ref.schema, ref.table)}")
        raise
    spark.sql(f"DROP TABLE {full(old)}")
