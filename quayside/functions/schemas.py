"""Schemas that hold the rows of several others."""

from __future__ import annotations

from pyspark.sql import types as T

_WHOLE = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 20}  # and their digits
_WHOLE_ORDER = list(_WHOLE)


class NotWidened(ValueError):
    """No type holds the values of both without loss."""


def widened(one: T.StructType, other: T.StructType, at: str = "") -> T.StructType:
    """Columns of both by name, each in the narrowest type that holds both and
    that the reader can widen to; those of ``one`` come first."""
    fields = {field.name: field for field in one}
    for field in other:
        known = fields.get(field.name)
        kind = field.dataType if known is None else _wider(known.dataType, field.dataType, at + field.name)
        fields[field.name] = T.StructField(field.name, kind, True)
    return T.StructType(list(fields.values()))


def fit(one: T.StructType, other: T.StructType) -> bool:
    try:
        widened(one, other)
    except NotWidened:
        return False
    return True


def _wider(a: T.DataType, b: T.DataType, at: str) -> T.DataType:
    if a == b:
        return a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return widened(a, b, f"{at}.")
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(_wider(a.elementType, b.elementType, f"{at}[]"))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(_wider(a.keyType, b.keyType, f"{at}{{}}"), _wider(a.valueType, b.valueType, f"{at}{{}}"))
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE_ORDER.index)
    for x, y in ((a, b), (b, a)):
        if x == T.DoubleType() and (y == T.FloatType() or (y in _WHOLE and y != T.LongType())):
            return x
        if x == T.TimestampNTZType() and y == T.DateType():
            return x
        if isinstance(x, T.DecimalType) and y in _WHOLE:
            b, a = x, T.DecimalType(_WHOLE[y], 0)
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        precision = max(a.precision - a.scale, b.precision - b.scale) + scale
        if precision <= 38:
            return T.DecimalType(precision, scale)
    raise NotWidened(f"column {at} is {a.simpleString()} and {b.simpleString()}")
