"""Set operations on whole rows: tolerant union, rows not yet known."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.sql import types as T

from tallybook.functions import KEY, quoted, row_key
from tallybook.operators.types import common_type, exact, keeps_text, loses
from tallybook.session import materialise


def union_sources(sources: Iterable[DataFrame | None], as_text: bool = False) -> DataFrame | None:
    """Bag union by column name; columns a source lacks are NULL, absent sources are skipped.

    A column whose type differs takes the least common type (see ``operators.types``), with ``as_text``
    text where there is no other; without it such a column is an error that names it.
    """
    present = [s for s in sources if s is not None]
    if not present:
        return None
    schemas = [s.schema for s in present]
    if any(differ_in_type(schemas[0], s) for s in schemas[1:]) or _disagree(schemas):
        schema = reduce(lambda a, b: widened_schema(a, b, types=True, as_text=as_text), schemas)
        present = [conform(s, schema) for s in present]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), present)


def differ_in_type(a: T.StructType, b: T.StructType) -> bool:
    """Whether a column that both have differs in more than the fields of structs."""
    types = {f.name.lower(): f.dataType for f in a.fields}
    return any(f.name.lower() in types and _differs(types[f.name.lower()], f.dataType) for f in b.fields)


def _disagree(schemas: list[T.StructType]) -> bool:
    """The same for columns that the first schema lacks."""
    merged = schemas[0]
    for schema in schemas[1:]:
        if differ_in_type(merged, schema):
            return True
        merged = widened_schema(merged, schema)
    return False


def _differs(a: T.DataType, b: T.DataType) -> bool:
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return differ_in_type(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return _differs(a.elementType, b.elementType)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return _differs(a.keyType, b.keyType) or _differs(a.valueType, b.valueType)
    return a != b


def reject_key_name(df: DataFrame) -> None:
    """A user's column cannot have the name of the hidden key: it would be taken for one."""
    if KEY.lower() in (c.lower() for c in df.columns):
        raise ValueError(f"column name {KEY} is reserved for the row key; rename it in the source")


def with_row_key(df: DataFrame, mode: str) -> DataFrame:
    reject_key_name(df)
    return df.withColumn(KEY, row_key(df.schema, mode))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the columns, order and types of ``schema``; a type or value that cannot be stored fails."""
    renamed = {f.name.lower(): f.name for f in schema.fields}
    named = df.withColumnsRenamed({c: renamed[c.lower()] for c in df.columns if c.lower() in renamed})
    goal = {f.name: f.dataType for f in schema.fields}
    checked = {
        f.name: exact(quoted(f.name), f.dataType, goal[f.name])
        for f in named.schema.fields
        if f.name in goal and loses(f.dataType, goal[f.name])
    }
    return (named.withColumns(checked) if checked else named).to(schema)


def widened_type(old: T.DataType, new: T.DataType, types: bool = False, as_text: bool = False) -> T.DataType:
    """The old type, with struct fields that only the new one has added at any depth; with ``types`` the least
    common type where they differ, and the old one where there is none."""
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return widened_schema(old, new, types, as_text)
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(widened_type(old.elementType, new.elementType, types, as_text))
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        key = widened_type(old.keyType, new.keyType, types, as_text)
        return T.MapType(key, widened_type(old.valueType, new.valueType, types, as_text))
    return (common_type(old, new, as_text) or old) if types else old


def widened_schema(
    old: T.StructType, new: T.StructType, types: bool = False, as_text: bool = False
) -> T.StructType:
    """Columns of ``old`` in place, those only in ``new`` at the end, all nullable."""
    incoming = {f.name.lower(): f.dataType for f in new.fields}
    known = {f.name.lower() for f in old.fields}
    fields = [
        T.StructField(f.name, widened_type(f.dataType, incoming.get(f.name.lower(), f.dataType), types, as_text))
        for f in old.fields
    ]
    fields += [T.StructField(f.name, f.dataType) for f in new.fields if f.name.lower() not in known]
    return T.StructType(fields)


def within_range_of(target: DataFrame, source: DataFrame, column: str) -> DataFrame:
    """Target rows whose ``column`` lies in the range the source spans.

    Equal rows agree in every column, so a target row outside the range cannot be a known
    copy of a source row: the bound prunes files and row groups and loses nothing. The bounds
    of timestamps travel as microseconds since the epoch, so that no time zone comes between.
    """
    is_instant = isinstance(source.schema[column].dataType, T.TimestampType)
    out = F.unix_micros if is_instant else (lambda c: c)
    back: Column = F.timestamp_micros if is_instant else (lambda c: c)
    low, high = source.agg(out(F.min(column)), out(F.max(column))).first()
    inside = F.col(column).isNull()
    if low is not None:
        inside = inside | F.col(column).between(back(F.lit(low)), back(F.lit(high)))
    return target.filter(inside)


@dataclass(frozen=True)
class Unseen:
    """Rows of a source that a target lacks, with their keys, and the numbers of rows and of keys."""

    rows: DataFrame
    row_count: int
    key_count: int


def find_unseen(
    source: DataFrame,
    target: DataFrame,
    mode: str = "strict",
    prune_on: str | None = None,
    bucketed: DataFrame | None = None,
    buckets: int = 0,
) -> Unseen:
    """Rows of ``source`` whose content ``target`` does not hold, copies included.

    Either side may carry row keys already (columns named ``KEY``), as ledger tables do. A strict
    source is brought to the target's names first, and where their types differ both to the common
    ones, so that equal content has equal keys. A target with keys has its types already.

    One plan for any size. Keys of both sides are made unique before they are shuffled (copies
    combine map-side), so a row that fills a third of a table is one key, and 32 bytes a distinct
    row cross the network. The unseen keys are written; then the source's rows of those keys are
    fetched by a semi-join, which Spark broadcasts when it sees that few keys were written, and
    whose overlong partitions of one key it splits when it did not.

    ``bucketed`` are the target's keys in a table of so many ``buckets`` by key: then the source's keys
    alone are shuffled, to those buckets, and the target is read where it lies.
    """
    if mode == "strict" and KEY not in source.columns:
        plain = target.drop(KEY).schema
        schema = widened_schema(plain, source.schema, types=KEY not in target.columns)
        source = conform(source, schema)
        if KEY not in target.columns and not keeps_text(plain, schema):
            target = conform(target, schema)
    if prune_on is not None and bucketed is None:
        target = within_range_of(target, source, prune_on)
    keyed = source if KEY in source.columns else with_row_key(source, mode)
    copies = keyed.groupBy(KEY).agg(F.count(F.lit(1)).alias("_rows"))
    if bucketed is None:
        known = (target if KEY in target.columns else with_row_key(target, mode)).select(KEY)
        unseen = copies.join(known.distinct(), KEY, "left_anti")
    else:
        unseen = keys_not_in_buckets(copies, bucketed, buckets)
    keys, key_count = materialise(unseen, "unseen-keys")
    row_count = keys.agg(F.sum("_rows")).first()[0] or 0
    return Unseen(keyed.join(keys.select(KEY), KEY, "left_semi"), row_count, key_count)


def keys_not_in_buckets(keys: DataFrame, bucketed: DataFrame, buckets: int) -> DataFrame:
    """The rows of ``keys`` (unique) that a bucketed table of keys lacks; that table isn't moved.

    The bucket of each row comes along as ``_bucket``: a value that depends on the partition keeps the
    join above the partitioning, under which Spark would push it otherwise.
    """
    dealt = keys.repartition(buckets, KEY).withColumn("_bucket", F.spark_partition_id())
    return dealt.join(bucketed.hint("merge"), KEY, "left_anti")


def new_rows(
    source: DataFrame, target: DataFrame, mode: str = "strict", prune_on: str | None = None
) -> DataFrame:
    """Rows of ``source`` whose content ``target`` does not hold, copies included.

    They come in the target's names and the common types (in strict mode), with columns that only the
    source has at the end. ``prune_on`` names a column (an event time, say) by whose range the target is pruned.
    """
    reject_key_name(source)
    reject_key_name(target)
    found = find_unseen(source, target, mode, prune_on).rows.drop(KEY)
    return found.select(*source.columns) if set(source.columns) == set(found.columns) else found
