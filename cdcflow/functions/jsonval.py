"""Field access on schemaless JSON records held as VARIANT.

A record is parsed once (``try_parse_json``) and every rule reads single
top-level fields from it.  A field argument is always one field name, never a
nested path, so names containing dots work (``$['a.b']``).

Value-to-text rule (what every text rule sees):

* missing field or JSON ``null``   -> NULL
* string                           -> the string as is
* number / boolean                 -> its text (``123``, ``1.5``, ``true``);
                                     fractions print as doubles (``100.50`` -> ``100.5``)
* object / array                   -> ``''`` (the empty string, not the JSON)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcflow.functions._util import as_col

_NUMERIC_KINDS = "^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL)"


def variant_path(field: str) -> str:
    """JSON path selecting exactly one top-level field by name."""
    return "$['" + field.replace("\\", "\\\\").replace("'", "\\'") + "']"


def json_value(data: Column | str, field: str) -> Column:
    """The field as VARIANT: SQL NULL when missing, variant null for JSON null."""
    return F.try_variant_get(as_col(data), variant_path(field), "variant")


def json_text(data: Column | str, field: str) -> Column:
    """Text of one field under the value-to-text rule (see module doc)."""
    data = as_col(data)
    return _ruled(_raw_text(data, field), data, field)


def _raw_text(data: Column, field: str) -> Column:
    return F.try_variant_get(data, variant_path(field), "string")


def _ruled(text: Column, data: Column, field: str) -> Column:
    """The value-to-text rule over a field's plain text."""
    # Only values whose text starts like a container pay for the type probe.
    v = json_value(data, field)
    is_container = F.when(text.startswith("{"), json_is_object(v)).when(text.startswith("["), _is_array(v))
    # A JSON number with a fraction is a double to the original reader, so it
    # prints like Java's Double.toString ("100.50" -> "100.5"); VARIANT keeps it
    # as a DECIMAL.  Only text with a dot that starts like a number pays for the type check.
    numeric = text.contains(".") & F.substring(text, 1, 1).between("-", "9")
    is_decimal = F.when(numeric, F.schema_of_variant(v).startswith("DECIMAL"))
    as_double_text = F.try_variant_get(v, "$", "double").cast("string")
    return (
        F.when(F.coalesce(is_container, F.lit(False)), F.lit(""))
        .when(F.coalesce(is_decimal, F.lit(False)), as_double_text)
        .otherwise(text)
    )


def with_texts(df: DataFrame, data: Column, names: dict[str, str]) -> DataFrame:
    """``df`` with the text of each field under its name (``field -> column``).

    The plain texts are read in a projection of their own: the rule looks at a text
    several times, in branches where Spark shares no subexpressions.
    """
    raw = df.select("*", *[_raw_text(data, f).alias(f"{a}_raw") for f, a in names.items()])
    return raw.select(*[F.col(f"`{c}`") for c in df.columns], *[_ruled(F.col(f"`{a}_raw`"), data, f).alias(a) for f, a in names.items()])


def json_is_number(data: Column | str, field: str) -> Column:
    """True when the field holds a JSON number (not a numeric string)."""
    return F.coalesce(
        F.schema_of_variant(json_value(data, field)).rlike(_NUMERIC_KINDS), F.lit(False)
    )


def json_is_null_or_missing(data: Column | str, field: str) -> Column:
    v = json_value(data, field)
    return v.isNull() | F.is_variant_null(v)


# Casting a VARIANT to a one-field struct succeeds for any JSON object (the
# field is simply absent) and fails for every other value; the ``try_`` form
# turns the failure into NULL.  This avoids walking the whole value the way
# ``schema_of_variant`` does.
_OBJECT_PROBE = "struct<__cdcflow_probe:int>"
_ARRAY_PROBE = "array<variant>"


def json_is_object(v: Column) -> Column:
    """True when a VARIANT value is a JSON object."""
    return F.try_variant_get(v, "$", _OBJECT_PROBE).isNotNull()


def _is_array(v: Column) -> Column:
    return F.try_variant_get(v, "$", _ARRAY_PROBE).isNotNull()
