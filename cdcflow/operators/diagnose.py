"""Why a value did not decode: not JSON, cut short, no object, or the wrong type at which field.

Meant for the few rows that a decoder refused: the text is parsed again without a
schema, and every declared field alone with the decoder that refused the whole.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NO_DECODE = "could not decode the record value"
SHOWN = 100  # characters of a value that are shown
# a whole JSON string; possessive, so that long texts need no deep recursion
_STRING = r'"(?:[^"\\]++|\\.)*+"'
_CORRUPT = "_corrupt_value"


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def cut_short(text: Column) -> Column:
    """The text begins an object, array or string that it does not end."""
    bare = F.regexp_replace(text, _STRING, "")
    opened = (_count(bare, "{") > _count(bare, "}")) | (_count(bare, "[") > _count(bare, "]")) | bare.contains('"')
    return text.rlike(r'^\s*[{\["]') & opened


def _wrong(text: Column, f: T.StructField) -> Column:
    """The decoder refuses ``text`` for the sake of field ``f`` alone."""
    alone = T.StructType([T.StructField(f.name, f.dataType), T.StructField(_CORRUPT, T.StringType())])
    read = F.from_json(text, alone, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    return read[_CORRUPT].isNotNull()


def json_failure(text: Column, schema: T.StructType) -> Column:
    """The reason why JSON ``text`` does not decode into ``schema``."""
    v = F.try_parse_json(text)
    kind = F.schema_of_variant(v)
    out = F.when(text.rlike(r"^\s*$"), F.lit("the value is empty"))
    out = out.when(v.isNull() & cut_short(text), F.concat(F.lit("the JSON text is cut short after "), F.length(text).cast("string"), F.lit(" characters")))
    out = out.when(v.isNull(), F.lit("the text is not JSON"))
    out = out.when(~kind.startswith("OBJECT"), F.concat(F.lit("the value is no object but "), F.regexp_extract(kind, "^[A-Z]+", 0)))
    for f in schema.fields:
        got = F.substring(F.get_json_object(text, f"$['{f.name}']"), 1, SHOWN)
        why = F.concat(F.lit(f"field '{f.name}' is no {f.dataType.simpleString()}: "), F.coalesce(got, F.lit("null")))
        out = out.when(_wrong(text, f), why)
    return F.concat(F.lit(NO_DECODE + ": "), out.otherwise(F.lit("it does not fit the declared fields")))
