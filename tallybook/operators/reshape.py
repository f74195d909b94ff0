"""Projections whose columns depend on the data or on what a table happens to have."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions import quoted

MAX_COLUMNS = 500
"""As many columns as keys found in the data may become, unless the caller says otherwise."""


def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[quoted(c).alias(f"{prefix}_{c}") for c in df.columns])


def select_available(
    df: DataFrame, expected: Iterable[str], fill_missing: bool = False
) -> DataFrame:
    """The expected columns that exist, in expected order; missing ones as NULL on request."""
    present = set(df.columns)
    wanted = [name for name in expected if fill_missing or name in present]
    return df.selectExpr(
        *[f"`{n}`" if n in present else f"CAST(NULL AS STRING) AS `{n}`" for n in wanted]
    )


def map_key_set(df: DataFrame, map_col: str) -> DataFrame:
    """Distinct keys of a map column; duplicates go map-side, before the shuffle."""
    return df.select(F.explode(F.map_keys(quoted(map_col))).alias("key")).distinct()


def names_within(names: Sequence[str], others: Sequence[str], max_columns: int) -> list[str]:
    """The names without repeats; an error if they are too many, or clash with each other or with ``others``."""
    distinct = list(dict.fromkeys(names))
    if len(distinct) > max_columns:
        raise ValueError(f"more than {max_columns} keys, such as {distinct[:5]}: raise max_columns or name them")
    taken = {c.lower() for c in others}
    for name in distinct:
        if name.lower() in taken:
            raise ValueError(f"the key {name!r} clashes with another column or key")
        taken.add(name.lower())
    return distinct


def map_to_columns(
    df: DataFrame,
    map_col: str,
    keys: Sequence[str] | None = None,
    keep: Sequence[str] = (),
    required: Sequence[str] = (),
    max_columns: int = MAX_COLUMNS,
) -> DataFrame:
    """One string column per map key, replacing a column of the same name unless in ``keep``.

    Without ``keys`` all keys that occur are taken, sorted, found by one pass that shuffles distinct keys
    only; those that differ in case alone, or more than ``max_columns``, are an error. ``required``
    keys are there at any rate. ``map_entries_long`` gives the content of maps with any number of keys.
    """
    if keys is None:
        seen = map_key_set(df, map_col).sort("key").limit(max_columns + 1).collect()
        keys = names_within([*[r["key"] for r in seen], *required], (), max_columns)
    else:
        keys = [*keys, *required]
    names = [k for k in dict.fromkeys(keys) if k not in keep]
    kept = [quoted(c) for c in df.columns if c not in names]
    values = [F.try_element_at(quoted(map_col), F.lit(k)).alias(k) for k in names]
    return df.select(*kept, *values)


def map_entries_long(df: DataFrame, map_col: str) -> DataFrame:
    """One row per entry, as ``key`` and ``value`` beside the other columns, whatever the keys are.

    Rows without a map or with an empty one stay once, with NULL for both.
    """
    others = [quoted(c) for c in df.columns if c != map_col]
    return df.select(*others, F.explode_outer(quoted(map_col)).alias("key", "value"))


def keys_present(df: DataFrame, map_col: str, wanted: Sequence[str]) -> list[str]:
    """Those of the wanted keys that any row's map has, by one aggregate of one row."""
    found = [F.max(F.map_contains_key(quoted(map_col), k)).alias(k) for k in wanted]
    row = df.agg(*found).first()
    return [k for k in wanted if row[k]]


def flatten_arrays(
    df: DataFrame, arrays: Mapping[str, Sequence[str]], style: str = "wide"
) -> DataFrame:
    """Arrays of structs to scalar columns.

    ``wide``  per array and field: ``<singular>_<field>`` for a row with exactly one element,
              ``<singular>_<field>_1 … _n`` for rows with more. The longest array, found by
              one aggregate, sets n; columns that no row would fill are left out.
    ``long``  one row per element with its position; rows without elements stay once. Needs
              no pass ahead and suits arrays of any length. Takes one array.
    """
    scalars = [quoted(c) for c in df.columns if c not in arrays]
    if style == "long":
        ((name, fields),) = arrays.items()
        stem = singular(name)
        exploded = df.select(*scalars, F.posexplode_outer(quoted(name)).alias("_pos", "_item"))
        items = [F.col("_item")[f].alias(f"{stem}_{f}") for f in fields]
        position = (F.col("_pos") + 1).alias(f"{stem}_position")
        return exploded.select(*[c for c in scalars], position, *items)
    if style != "wide":
        raise ValueError(f"unknown style: {style}")

    sizes = {name: F.coalesce(F.size(quoted(name)), F.lit(0)) for name in arrays}
    seen = df.agg(
        *[F.max(size).alias(f"longest_{name}") for name, size in sizes.items()],
        *[F.max(size == 1).alias(f"single_{name}") for name, size in sizes.items()],
    ).first()
    columns = []
    for name, fields in arrays.items():
        stem, size = singular(name), sizes[name]
        longest = seen[f"longest_{name}"] or 0
        if seen[f"single_{name}"]:
            columns += [
                F.when(size == 1, F.get(quoted(name), 0)[f]).alias(f"{stem}_{f}") for f in fields
            ]
        if longest > 1:
            columns += [
                F.when(size > 1, F.get(quoted(name), i)[f]).alias(f"{stem}_{f}_{i + 1}")
                for i in range(longest)
                for f in fields
            ]
    return df.select(*scalars, *columns)


def singular(name: str) -> str:
    return name.removesuffix("s")
