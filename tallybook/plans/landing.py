"""Incremental landing: copy tables, adding only rows whose content is not there yet."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, Row, SparkSession

from tallybook.functions import KEY
from tallybook.operators.rows import conform, find_unseen, reject_key_name, widened_schema, with_row_key
from tallybook.operators.types import keeps_text
from tallybook.plans.guarded import run_guarded
from tallybook.sources.keys import KeyIndex, synced_keys
from tallybook.sources.registry import EXCLUDED_TABLES, apply_name_exclusions, to_refs
from tallybook.sources.tables import (
    TableRef,
    append_table,
    create_table,
    is_ledger,
    read_table,
    table_exists,
)

STATUS_SCHEMA = "table string, action string, row_count long, error string"
CREATED, APPENDED, UNCHANGED, FAILED, SKIPPED = (
    "created",
    "appended",
    "unchanged",
    "failed",
    "skipped",
)


def status(ref: TableRef, action: str, row_count: int = 0, error: str | None = None) -> Row:
    return Row(table=ref.name, action=action, row_count=row_count, error=error)


def append_new(
    df: DataFrame,
    ref: TableRef,
    mode: str = "strict",
    dedupe: bool = False,
    prune_on: str | None = None,
    keyed: bool = False,
    as_text: bool = False,
    index: KeyIndex | None = None,
) -> Row:
    """Create the table from ``df``, or append the rows of ``df`` it lacks; nothing else.

    The target may be a ledger, which stores strict row keys, a catalog table, whose schema is
    created where it is missing, or a folder of files; of the latter two the keys are made when
    they are needed and never stored. Copies within ``df`` are kept unless ``dedupe``.
    ``keyed`` says that ``df`` carries compat keys of its own; a user's column may not have
    the key's name. Where types differ a ledger's columns widen to the common ones (``as_text``: to text
    where there are no others), and rows are known by their content in those. ``index`` names a bucketed
    table of a ledger's keys (see ``sources.keys``), kept up to date here, with which only ``df`` is shuffled;
    a run that changes how values look does without it.
    """
    spark = df.sparkSession
    if not keyed:
        reject_key_name(df)
    stored = mode == "strict" and is_ledger(ref)
    if not table_exists(spark, ref):
        new = df if keyed else with_row_key(df, mode)
        new = new.dropDuplicates([KEY]) if dedupe else new
        return status(ref, CREATED, create_table(new if stored else new.drop(KEY), ref))

    target = read_table(spark, ref, with_key=stored)
    bucketed = index if stored else None
    if mode == "strict":
        plain, known = df.drop(KEY), target.drop(KEY)
        schema = widened_schema(known.schema, plain.schema, types=stored, as_text=as_text)
        df = conform(plain, schema)
        if stored and not keeps_text(known.schema, schema):
            target = with_row_key(conform(known, schema), mode)
            bucketed = None
    keys = synced_keys(spark, ref, bucketed) if bucketed is not None else None
    unseen = find_unseen(df, target, mode, prune_on, keys, bucketed.buckets if bucketed is not None else 0)
    if unseen.row_count == 0:
        return status(ref, UNCHANGED)
    new = unseen.rows.dropDuplicates([KEY]) if dedupe else unseen.rows
    rows = unseen.key_count if dedupe else unseen.row_count
    added = append_table(new if stored else new.drop(KEY), ref, as_text=as_text, row_count=rows)
    return status(ref, APPENDED, added)


def land_table(
    spark: SparkSession,
    source: TableRef,
    target: TableRef,
    mode: str = "strict",
    dedupe: bool = False,
    prune_on: str | None = None,
    as_text: bool = False,
    index: KeyIndex | None = None,
) -> Row:
    """Land one table: created when absent, else only unseen rows are appended."""
    return append_new(read_table(spark, source), target, mode, dedupe, prune_on, as_text=as_text, index=index)


def target_of(root: str | None, catalog: str, schema: str, table: str) -> TableRef:
    """A ledger under ``root``, or without one the catalog table of that name."""
    return TableRef(catalog, schema, table) if root is None else TableRef.under(root, catalog, schema, table)


def each_table(
    spark: SparkSession,
    work: Iterable[tuple[TableRef, Callable[[], Row]]],
    fail_fast: bool,
    workers: int,
    time_limit: float | None = None,
) -> DataFrame:
    """Run one landing per table, several at a time so that small tables do not queue up
    behind each other, and return a status row each. A failed table does not stop the
    others unless ``fail_fast``: then their jobs are ended and the failure is raised. A table that
    takes more than ``time_limit`` seconds is ended, which its row says; what it had not committed
    does not count."""
    items = list(work)
    found = run_guarded(spark, [(ref.name, task) for ref, task in items], workers, time_limit, fail_fast)
    rows = [
        status(ref, FAILED, error=f"{type(got).__name__}: {got}") if isinstance(got, Exception) else got
        for (ref, _), got in zip(items, found, strict=True)
    ]
    return spark.createDataFrame(rows, STATUS_SCHEMA)


def land_catalog(
    spark: SparkSession,
    registry: DataFrame,
    source: str,
    target: str,
    target_root: str | None,
    exclude_schemas: Iterable[str] = ("ai",),
    exclude_tables: Iterable[str] = EXCLUDED_TABLES,
    rename: Mapping[str, str] | None = None,
    mode: str = "strict",
    fail_fast: bool = False,
    workers: int = 8,
    dedupe: bool = False,
    prune_on: Mapping[str, str] | None = None,
    as_text: bool = False,
    time_limit: float | None = None,
) -> DataFrame:
    """Land every table of a catalog; ``rename`` maps schema names, such as that of the
    information schema, which the target catalog has of its own.

    Targets are ledgers under ``target_root``, or tables of the catalog ``target`` without one.
    ``prune_on`` names, by ``schema.table`` of the source, the column that bounds what is read of
    the target. ``time_limit`` is the seconds that a table may take.
    """
    rename = rename or {}
    prune_on = prune_on or {}
    of_source = registry.filter(registry["catalog"] == source)
    refs = to_refs(apply_name_exclusions(of_source, exclude_schemas, exclude_tables))

    def landing(ref: TableRef) -> tuple[TableRef, Callable[[], Row]]:
        schema = rename.get(ref.schema, ref.schema)
        goal = target_of(target_root, target, schema, ref.table)
        bound = prune_on.get(f"{ref.schema}.{ref.table}")
        return goal, lambda: land_table(spark, ref, goal, mode, dedupe, bound, as_text)

    return each_table(spark, map(landing, refs), fail_fast, workers, time_limit)
