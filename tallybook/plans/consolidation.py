"""Consolidation: one table out of the same-named tables of many catalogs."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, Row, SparkSession

from tallybook.operators.rows import union_sources, with_row_key
from tallybook.plans.landing import SKIPPED, append_new, each_table, status, target_of
from tallybook.sources.registry import (
    EXCLUDED_SCHEMAS,
    EXCLUDED_TABLES,
    SOURCE_EXCLUDE,
    SOURCE_INCLUDE,
    apply_name_exclusions,
    discover_sources,
    to_refs,
)
from tallybook.sources.tables import TableRef, load_view


def consolidate_table(
    spark: SparkSession,
    sources: Sequence[TableRef],
    target: TableRef,
    mode: str = "strict",
    dedupe: bool = False,
    prune_on: str | None = None,
    as_text: bool = False,
) -> Row:
    """Union the sources that exist and append what the target lacks.

    The union has every column of any source before a strict key is made, so a row keeps
    its key when another source later brings more columns. Compat keys cover the columns a
    source has of its own and are made before the union. Columns that differ in type take the least
    common one, in the union and in a ledger that is there already; text only ``as_text``.
    """
    present = [df for df in (load_view(spark, ref) for ref in sources) if df is not None]
    if not present:
        return status(target, SKIPPED)
    if mode == "compat":
        present = [with_row_key(df, mode) for df in present]
    return append_new(
        union_sources(present, as_text), target, mode, dedupe, prune_on, keyed=mode == "compat", as_text=as_text
    )


def consolidate_all(
    spark: SparkSession,
    registry: DataFrame,
    target: str,
    target_root: str | None,
    include: str = SOURCE_INCLUDE,
    exclude: str = SOURCE_EXCLUDE,
    exclude_schemas: Iterable[str] = EXCLUDED_SCHEMAS,
    exclude_tables: Iterable[str] = EXCLUDED_TABLES,
    mode: str = "strict",
    fail_fast: bool = False,
    workers: int = 8,
    dedupe: bool = False,
    prune_on: Mapping[str, str] | None = None,
    as_text: bool = False,
    time_limit: float | None = None,
) -> DataFrame:
    """Find the source catalogs and consolidate each of their tables; the target itself is
    never a source. Without a ``target_root`` the targets are tables of the catalog ``target``.
    ``prune_on`` names a column by ``schema.table``; ``time_limit`` is the seconds that a table may take."""
    prune_on = prune_on or {}
    sources = discover_sources(registry, include, exclude, targets=[target])
    wanted = registry.join(sources, "catalog", "left_semi")
    groups: dict[tuple[str, str], list[TableRef]] = {}
    for ref in to_refs(apply_name_exclusions(wanted, exclude_schemas, exclude_tables)):
        groups.setdefault((ref.schema, ref.table), []).append(ref)

    def merging(item) -> tuple[TableRef, Callable[[], Row]]:
        (schema, table), refs = item
        goal = target_of(target_root, target, schema, table)
        bound = prune_on.get(f"{schema}.{table}")
        return goal, lambda: consolidate_table(spark, refs, goal, mode, dedupe, bound, as_text)

    return each_table(spark, map(merging, sorted(groups.items())), fail_fast, workers, time_limit)
