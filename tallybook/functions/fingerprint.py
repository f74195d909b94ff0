"""Row identity as a SHA-256 of the row's content.

``strict``   JSON of all non-NULL columns in name order. NULL and empty text differ, no
             delimiter can collide, maps count regardless of their entry order, and a
             column that is added later (hence NULL in old rows) leaves the value as it was.
``compat``   columns in their own order as text, NULL as empty text, joined by ``|``, and
             top-level maps left out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.functions.scalars import quoted

KEY = "_row_key"

# Full microseconds and a fixed zone: the same instant gives the same text in any session.
JSON_OPTIONS = {
    "timeZone": "UTC",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def holds_map(dtype: T.DataType) -> bool:
    """Whether a type is, or holds at any depth, a map."""
    if isinstance(dtype, T.MapType):
        return True
    if isinstance(dtype, T.ArrayType):
        return holds_map(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(holds_map(f.dataType) for f in dtype.fields)
    return False


def _ordered(value: Column, dtype: T.DataType) -> Column:
    """``value`` with every map, at any depth, turned into entries sorted by key."""
    if not holds_map(dtype):
        return value
    if isinstance(dtype, T.MapType):
        entries = F.transform(
            F.map_entries(value),
            lambda e: F.struct(
                _ordered(e["key"], dtype.keyType).alias("key"),
                _ordered(e["value"], dtype.valueType).alias("value"),
            ),
        )
        return F.array_sort(entries)
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda item: _ordered(item, dtype.elementType))
    fields = [_ordered(value[f.name], f.dataType).alias(f.name) for f in dtype.fields]
    return F.when(value.isNotNull(), F.struct(*fields))


def row_fingerprint(schema: T.StructType, mode: str = "strict") -> Column:
    """SHA-256 in hex over the columns of ``schema``."""
    fields = [f for f in schema.fields if f.name != KEY]
    if mode == "strict":
        ordered = [
            _ordered(quoted(f.name), f.dataType).alias(f.name)
            for f in sorted(fields, key=lambda f: f.name)
        ]
        return F.sha2(F.to_json(F.struct(*ordered), JSON_OPTIONS), 256)
    if mode == "compat":
        texts = [
            quoted(f.name).cast("string") for f in fields if not isinstance(f.dataType, T.MapType)
        ]
        # array_join with a NULL replacement keeps the place of a NULL as empty text.
        return F.sha2(F.array_join(F.array(*texts).cast("array<string>"), "|", ""), 256)
    raise ValueError(f"unknown fingerprint mode: {mode}")


def row_key(schema: T.StructType, mode: str = "strict") -> Column:
    """The fingerprint as 32 bytes, half of what its hex text would shuffle and store."""
    return F.unhex(row_fingerprint(schema, mode))
