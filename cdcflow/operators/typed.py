"""Does a value fit its declared type?  Per row, without failing the job.

``fit`` compares a column's own type with the declared one at plan time: equal and
widening types cost nothing, all others get a ``try_cast`` and a condition that
says which non-NULL values are lost by it (text that is no number, numbers out of
range, fractions in a whole-number field, text over a declared length, flags other
than 0 and 1, and such values inside arrays, maps and structs).  A conversion that
no value can pass (a flag as a timestamp, text as a struct) is an error at plan time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]  # from narrow to wide
FRACTION = (T.FloatType, T.DoubleType, T.DecimalType)
SHOWN = 100  # characters of a value shown in a reason


def _any(parts: list[Column | None]) -> Column | None:
    found = [p for p in parts if p is not None]
    return reduce(lambda a, b: a | b, found) if found else None


def _inside(c: Column, have: T.DataType, want: T.DataType) -> Column | None:
    """The misfits inside a nested value; the shapes must agree."""
    if isinstance(want, T.ArrayType):
        return None if misfit(F.lit(None), have.elementType, want.elementType) is None else F.exists(c, lambda x: misfit(x, have.elementType, want.elementType))
    if isinstance(want, T.MapType):
        parts = []
        for values, a, b in ((F.map_keys(c), have.keyType, want.keyType), (F.map_values(c), have.valueType, want.valueType)):
            parts.append(_inside(values, T.ArrayType(a), T.ArrayType(b)))
        return _any(parts)
    return _any([misfit(c[a.name], a.dataType, b.dataType) for a, b in zip(have.fields, want.fields)])


def misfit(c: Column, have: T.DataType, want: T.DataType) -> Column | None:
    """The condition under which a non-NULL ``c`` of type ``have`` is lost in ``want``; ``None`` if it never is."""
    if isinstance(want, (T.VarcharType, T.CharType)):
        return F.coalesce(F.length(c.cast("string")) > want.length, F.lit(False))
    if have == want or isinstance(have, T.NullType) or isinstance(want, T.StringType):
        return None
    if type(have) is type(want) and isinstance(want, (T.ArrayType, T.MapType, T.StructType)):
        if not isinstance(want, T.StructType) or len(have.fields) == len(want.fields):
            inner = _inside(c, have, want)
            return None if inner is None else F.coalesce(inner, F.lit(False))
    if type(have) in WHOLE and type(want) in WHOLE and WHOLE.index(type(have)) <= WHOLE.index(type(want)):
        return None
    if (type(have) in WHOLE or isinstance(have, T.FloatType)) and isinstance(want, T.DoubleType):
        return None
    if isinstance(want, T.BooleanType) and (type(have) in WHOLE or isinstance(have, FRACTION)):
        return c.isNotNull() & ~c.isin(0, 1)
    made = c.try_cast(want)
    lost = made.isNull()
    if isinstance(have, FRACTION) and type(want) in WHOLE:
        lost = lost | (made.try_cast(have) != c)
    return c.isNotNull() & F.coalesce(lost, F.lit(True))


def converted(c: Column, have: T.DataType, want: T.DataType) -> Column:
    """``c`` in type ``want``; what does not fit is NULL or, nested, holds NULL."""
    if isinstance(want, (T.VarcharType, T.CharType)):
        return F.when(F.length(c.cast("string")) <= want.length, c.cast("string"))
    if have == want:
        return c
    return c.cast(want) if isinstance(have, T.NullType) or isinstance(want, T.StringType) else c.try_cast(want)


def reason(field: str, c: Column, have: T.DataType, want: T.DataType) -> Column:
    """``Failed to apply mapping rule for field 'x': value 'x1' does not fit bigint``."""
    shown = F.to_json(c) if isinstance(have, (T.StructType, T.ArrayType, T.MapType)) else c.cast("string")
    # one format call: a NULL anywhere in a concat would hide the reason
    return F.format_string(f"Failed to apply mapping rule for field '{field}': value '%s' does not fit {want.simpleString()}".replace("%s", "%1$s"),
                           F.substring(shown, 1, SHOWN))
