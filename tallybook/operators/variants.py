"""Payloads as VARIANT: keys and types found by one aggregate, nested values kept as values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.functions import quoted
from tallybook.operators.reshape import MAX_COLUMNS, names_within

SCALARS = ("BIGINT", "DOUBLE", "DECIMAL", "BOOLEAN", "STRING", "DATE", "TIMESTAMP")


def with_variant(df: DataFrame, payload: str, strict: bool = False) -> DataFrame:
    """The text column ``payload`` parsed in place; a VARIANT column stays as it is.

    Text that is no JSON, or names a key twice in one object, is NULL, and an error if ``strict``.
    """
    if isinstance(df.schema[payload].dataType, T.VariantType):
        return df
    parse = F.parse_json if strict else F.try_parse_json
    return df.withColumn(payload, parse(quoted(payload)))


def payload_keys(df: DataFrame, payload: str) -> DataFrame:
    """``key, type, n_rows``: every top-level key of the objects, its common type, and how many have it.

    One aggregate that combines map-side, so what is shuffled are keys, not rows. Values that
    disagree have type ``VARIANT``, keys that are never anything but null ``VOID``.
    """
    parsed = with_variant(df, payload).select(quoted(payload).alias("_payload"))
    entries = parsed.lateralJoin(
        parsed.sparkSession.tvf.variant_explode(F.col("_payload").outer()).select("key", "value")
    )
    found = entries.filter("key IS NOT NULL").groupBy("key")
    return found.agg(F.schema_of_variant_agg("value").alias("type"), F.count(F.lit(1)).alias("n_rows"))


def _path(key: str) -> str:
    if '"' not in key:
        return f'$["{key}"]'
    if "'" not in key:
        return f"$['{key}']"
    raise ValueError(f"a key with both kinds of quotes has no path: {key}")


def _value(payload: str, key: str, found: str) -> Column:
    """A scalar in its type; objects, lists and values of several types as VARIANT."""
    if found == "VOID":
        return F.lit(None).cast("string")
    scalar = found.startswith(SCALARS)
    return F.variant_get(quoted(payload), _path(key), found.lower() if scalar else "variant")


def variant_columns(
    df: DataFrame,
    payload: str,
    keys: Sequence[str] | None = None,
    required: Sequence[str] = (),
    max_columns: int = MAX_COLUMNS,
    strict: bool = False,
) -> DataFrame:
    """One column per top-level key of the JSON objects in ``payload``, in place of it.

    Without ``keys`` all that occur, sorted; more than ``max_columns`` are an error, none is dropped.
    ``required`` keys are there at any rate, as NULL where no object has them. Scalars come in the
    common type of all rows, nested and mixed values as VARIANT. A row whose payload is NULL, no
    object or (unless ``strict``) no JSON has NULL in all of them. A key that is named like another
    column, or like another key but for case, is an error.
    """
    parsed = with_variant(df, payload, strict)
    found = payload_keys(parsed, payload)
    if keys is not None:
        found = found.filter(F.col("key").isin(list(keys)))
    types = {r["key"]: r["type"] for r in found.sort("key").limit(max_columns + 1).collect()}
    others = [c for c in df.columns if c != payload]
    names = names_within([*(types if keys is None else keys), *required], others, max_columns)
    values = [_value(payload, k, types.get(k, "VOID")).alias(k) for k in names]
    return parsed.select(*[quoted(c) for c in others], *values)
