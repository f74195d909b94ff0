"""Least common types: what a column becomes when tables disagree about its type.

Whole numbers widen among themselves, then to decimals, then to double; dates widen to either kind of
timestamp. Text is the common type of anything else, but only where it is asked for. A value that the
wider type cannot hold exactly (a long of more than 53 bits as a double, say) ends the job rather
than changing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Decimal digits that hold every value of each whole-number type.
DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
MOST_DIGITS = 38


def common_type(a: T.DataType, b: T.DataType, as_text: bool = False) -> T.DataType | None:
    """The least type that holds the values of both; None where there is none."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return _common_struct(a, b, as_text)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        item = common_type(a.elementType, b.elementType, as_text)
        return None if item is None else T.ArrayType(item)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        key, value = (common_type(x, y, as_text) for x, y in ((a.keyType, b.keyType), (a.valueType, b.valueType)))
        return None if key is None or value is None else T.MapType(key, value)
    found = _common_number(a, b) or _common_time(a, b)
    if found is None and as_text and _has_text(a) and _has_text(b):
        return T.StringType()
    return found


def _common_struct(a: T.StructType, b: T.StructType, as_text: bool) -> T.StructType | None:
    other = {f.name.lower(): f.dataType for f in b.fields}
    fields = []
    for f in a.fields:
        dtype = common_type(f.dataType, other.pop(f.name.lower(), f.dataType), as_text)
        if dtype is None:
            return None
        fields.append(T.StructField(f.name, dtype))
    return T.StructType([*fields, *(T.StructField(f.name, f.dataType) for f in b.fields if f.name.lower() in other)])


def _common_number(a: T.DataType, b: T.DataType) -> T.DataType | None:
    if not isinstance(a, T.NumericType) or not isinstance(b, T.NumericType):
        return None
    if any(isinstance(x, (T.DoubleType, T.FloatType)) for x in (a, b)):
        return T.DoubleType()
    if type(a) in DIGITS and type(b) in DIGITS:
        return max(a, b, key=lambda x: DIGITS[type(x)])
    (whole_a, scale_a), (whole_b, scale_b) = _digits(a), _digits(b)
    whole, scale = max(whole_a, whole_b), max(scale_a, scale_b)
    return T.DecimalType(whole + scale, scale) if whole + scale <= MOST_DIGITS else None


def _digits(dtype: T.DataType) -> tuple[int, int]:
    """Digits before and after the point."""
    if isinstance(dtype, T.DecimalType):
        return dtype.precision - dtype.scale, dtype.scale
    return DIGITS[type(dtype)], 0


def _common_time(a: T.DataType, b: T.DataType) -> T.DataType | None:
    for date, other in ((a, b), (b, a)):
        if isinstance(date, T.DateType) and isinstance(other, (T.TimestampType, T.TimestampNTZType)):
            return other
    return None


def _has_text(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.AtomicType) and not isinstance(dtype, T.BinaryType)


def keeps_text(old: T.DataType, new: T.DataType) -> bool:
    """Whether values look the same as text in both types, so that row keys made under the old one still hold."""
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        types = {f.name.lower(): f.dataType for f in new.fields}
        return all(f.name.lower() in types and keeps_text(f.dataType, types[f.name.lower()]) for f in old.fields)
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return keeps_text(old.elementType, new.elementType)
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        return keeps_text(old.keyType, new.keyType) and keeps_text(old.valueType, new.valueType)
    whole = type(old) in DIGITS and type(new) in DIGITS and DIGITS[type(old)] <= DIGITS[type(new)]
    return old == new or whole or isinstance(old, T.NullType)


def exact(value: Column, old: T.DataType, new: T.DataType) -> Column:
    """``value``, of type ``old``, which ends the job where ``new`` can't hold it exactly.

    Only turning longs and decimals into doubles can lose anything; the check reads the double back.
    """
    if isinstance(old, T.StructType) and isinstance(new, T.StructType) and loses(old, new):
        types = {f.name.lower(): f.dataType for f in new.fields}
        fields = [exact(value[f.name], f.dataType, types.get(f.name.lower(), f.dataType)).alias(f.name) for f in old.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType) and loses(old, new):
        return F.transform(value, lambda x: exact(x, old.elementType, new.elementType))
    if isinstance(old, T.MapType) and isinstance(new, T.MapType) and loses(old, new):
        return F.transform_values(value, lambda _, x: exact(x, old.valueType, new.valueType))
    if not loses(old, new):
        return value
    back = value.cast(new).try_cast(old)
    message = F.concat(F.lit(f"{old.simpleString()} doesn't fit {new.simpleString()}: "), value.cast("string"))
    return F.when(value.isNull() | (back == value), value).otherwise(F.raise_error(message).cast(old))


def loses(old: T.DataType, new: T.DataType) -> bool:
    """Whether some value of the old type isn't exact in the new, wider one."""
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        types = {f.name.lower(): f.dataType for f in new.fields}
        return any(loses(f.dataType, types[f.name.lower()]) for f in old.fields if f.name.lower() in types)
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return loses(old.elementType, new.elementType)
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        return loses(old.valueType, new.valueType)
    return isinstance(new, T.DoubleType) and isinstance(old, (T.LongType, T.DecimalType))
