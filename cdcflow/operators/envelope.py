"""Change-envelope operators: unwrap, op default, image choice, tombstones.

Input rows carry a ``key`` and a ``value``.  For the JSON form the value is
text ``{"schema":..., "payload": {"op", "before", "after"}}``; for the struct
form (decoded Avro) it is ``struct<op, before: struct, after: struct>``.  The
output adds ``data`` (the chosen row image as VARIANT), ``__op`` and, for rows
that cannot be unwrapped, a ``_reject`` struct.

Semantics:

* NULL value (a tombstone) -> row dropped.
* JSON that does not parse -> reject, context ``json_parsing``.
* no ``payload`` (or JSON null) -> the whole document is the row image; no
  ``__op`` is added (an ``__op`` already in the document is kept).
* ``op`` absent -> ``c``.  Deviation: a JSON ``null`` op is also ``c``.
* ``op == 'd'`` -> the ``before`` image, every other op -> ``after``.
* chosen image absent -> reject ``missing <image> image`` (no context);
  image JSON null or not an object -> reject, context ``json_parsing``.
  Deviation: both keep the whole input as payload.
* a struct value without a ``before`` and an ``after`` field -> reject, context
  ``avro_processing``.
* an object with a repeated member name keeps the last one where the session
  allows it (``spark.sql.variant.allowDuplicateKeys``, set by ``build_session``);
  otherwise it does not parse.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcflow.functions.jsonval import json_is_object, json_text, json_value
from cdcflow.functions.timefn import ntz_epoch_micros
from cdcflow.operators.rejects import CTX_JSON, CTX_STRUCT, add_reject, reject

DEFAULT_OP = "c"
DELETE_OP = "d"
PARSE_FAILED = "JSON parsing failed: malformed JSON text"


def drop_tombstones(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Null values (tombstones) carry no row image and are dropped."""
    return df.where(F.col(value_col).isNotNull())


def unwrap_json(
    df: DataFrame,
    value_col: str = "value",
    now: Column | _dt.datetime | None = None,
    keep_value: bool = True,
) -> DataFrame:
    """Unwrap JSON change envelopes (text) into ``data`` VARIANT + ``__op``."""
    src = drop_tombstones(df, value_col)
    raw = F.col(value_col)
    # Each derived value (document, payload, op, chosen image, its kind) is produced once
    # per row as the output of a one-element ``explode``.  Catalyst cannot push
    # a filter on a generator's output below the generator, so the success /
    # reject split is evaluated on these attributes instead of being inlined
    # down to the text (filters get no common-subexpression elimination: each
    # inlined copy would re-parse the JSON or re-walk the document).
    def once(df_: DataFrame, col: Column, name: str) -> DataFrame:
        return df_.select("*", F.explode(F.array(col)).alias(name))

    src = once(src, F.try_parse_json(raw), "_root")
    root = F.col("_root")
    src = once(src, json_value(root, "payload"), "_payload")
    payload = F.col("_payload")
    has_payload = F.coalesce(payload.isNotNull() & ~F.is_variant_null(payload), F.lit(False))
    op = F.when(has_payload, F.coalesce(json_text(payload, "op"), F.lit(DEFAULT_OP))).otherwise(json_text(root, "__op"))
    src = once(src, op, "_op")
    image = F.when(F.col("_op") == DELETE_OP, json_value(payload, "before")).otherwise(json_value(payload, "after"))
    src = once(src, F.when(has_payload, image), "_image")
    src = once(src, json_is_object(F.col("_image")), "_is_object")
    out = (
        src.withColumn("_has_payload", has_payload)
        .withColumn("__op", F.col("_op"))
        .withColumn("data", F.when(F.col("_has_payload"), F.col("_image")).otherwise(root))
    )
    image_name = F.when(F.col("__op") == DELETE_OP, F.lit("before")).otherwise(F.lit("after"))
    out = add_reject(out, root.isNull(), reject(raw, PARSE_FAILED, CTX_JSON, now))
    out = add_reject(
        out,
        F.col("_has_payload") & F.col("_image").isNull(),
        reject(raw, F.concat(F.lit("missing "), image_name, F.lit(" image")), None, now),
    )
    out = add_reject(
        out,
        F.col("_has_payload") & F.col("_image").isNotNull() & ~F.col("_is_object"),
        reject(raw, F.concat(F.lit("JSON parsing failed: "), image_name, F.lit(" image is not an object")), CTX_JSON, now),
    )
    out = out.drop("_root", "_payload", "_has_payload", "_op", "_image", "_is_object")
    return out if keep_value else out.drop(value_col)


def plain(c: Column, kind: T.DataType) -> Column:
    """A decoded value with times as the record had them: TIMESTAMP as epoch
    millis, DATE as epoch days, BINARY as text; structs and arrays inside too."""
    if isinstance(kind, T.TimestampType):
        return F.unix_millis(c)
    if isinstance(kind, T.TimestampNTZType):
        return F.floor(ntz_epoch_micros(c) / F.lit(1000)).cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(c)
    if isinstance(kind, T.BinaryType):
        return c.cast("string")
    if isinstance(kind, T.StructType):
        return F.when(c.isNotNull(), F.struct(*[plain(c[f.name], f.dataType).alias(f.name) for f in kind.fields]))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: plain(x, kind.elementType))
    return c


def unwrap_struct(
    df: DataFrame,
    value_col: str = "value",
    now: Column | _dt.datetime | None = None,
) -> DataFrame:
    """Unwrap decoded (struct) envelopes; the image becomes a VARIANT ``data``.

    ``op`` NULL or absent -> ``c``.  Missing image -> reject.  Converting the
    image to VARIANT lets the same JSON field rules apply to both forms.
    """
    src = drop_tombstones(df, value_col)
    v = F.col(value_col)
    kind = src.schema[value_col].dataType
    if not isinstance(kind, T.StructType):
        raise ValueError(f"struct envelopes need a decoded value, not {kind.simpleString()}: bind the topic with value_schema or avro_schema")
    fields = set(kind.fieldNames())
    if not fields & {"before", "after"}:
        bare = src.withColumn("__op", F.lit(None).cast("string")).withColumn("data", F.lit(None).cast("variant"))
        return add_reject(bare, F.lit(True), reject(F.to_json(v), "Avro processing failed: no before or after image in the record", CTX_STRUCT, now))
    op = F.coalesce(v["op"].cast("string"), F.lit(DEFAULT_OP)) if "op" in fields else F.lit(DEFAULT_OP)
    images = [plain(v[n], kind[n].dataType) if n in fields else F.lit(None) for n in ("before", "after")]
    before, after = (F.when(v[n].isNotNull(), i) if n in fields else i for n, i in zip(("before", "after"), images))
    out = src.withColumn("__op", op)
    image = F.when(F.col("__op") == DELETE_OP, before).otherwise(after)
    out = out.withColumn("data", F.when(image.isNotNull(), F.to_variant_object(image)))
    image_name = F.when(F.col("__op") == DELETE_OP, F.lit("before")).otherwise(F.lit("after"))
    return add_reject(
        out,
        F.col("data").isNull(),
        reject(F.to_json(v), F.concat(F.lit("missing "), image_name, F.lit(" image")), None, now),
    )


def tombstone_on_delete(df: DataFrame, value_col: str = "value", op_col: str = "__op") -> DataFrame:
    """Deletes become tombstones: ``value`` NULL when ``__op`` is ``d`` (any case).

    Key, topic, partition and timestamp columns pass through unchanged.
    """
    op = F.col(op_col).cast("string")
    is_delete = op.isNotNull() & (F.lower(op) == DELETE_OP)
    return df.withColumn(value_col, F.when(~is_delete, F.col(value_col)))
