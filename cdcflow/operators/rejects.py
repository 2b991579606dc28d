"""Reject records, success/reject routing and the processed-at stamp.

A row that cannot be refined carries a ``_reject`` struct instead of being
dropped.  It flows through every later stage untouched (stages only fill
``_reject`` when it is still NULL), and ``successes`` and ``rejects`` finally part them.

Reject struct: ``payload`` (text of the input), ``error_context``
(``json_parsing``, ``avro_processing``, ``field_mapping`` or NULL),
``reason`` and ``failed_at`` (TIMESTAMP).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcflow.functions._util import lit_or_col
from cdcflow.functions.timefn import processed_at as _processed_at

REJECT_COL = "_reject"

REJECT_TYPE = T.StructType(
    [
        T.StructField("payload", T.StringType()),
        T.StructField("error_context", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("failed_at", T.TimestampType()),
    ]
)

# Error contexts (fixed values).
CTX_JSON = "json_parsing"
CTX_STRUCT = "avro_processing"
CTX_MAPPING = "field_mapping"


def reject(
    payload: Column,
    reason: Column | str,
    context: str | None,
    now: Column | _dt.datetime | None = None,
) -> Column:
    """Build one reject struct."""
    failed_at = F.current_timestamp() if now is None else lit_or_col(now).cast("timestamp")
    return F.struct(
        payload.cast("string").alias("payload"),
        F.lit(context).cast("string").alias("error_context"),
        lit_or_col(reason).cast("string").alias("reason"),
        failed_at.alias("failed_at"),
    )


def no_reject() -> Column:
    return F.lit(None).cast(REJECT_TYPE)


def add_reject(df: DataFrame, condition: Column, rej: Column) -> DataFrame:
    """Fill ``_reject`` for rows matching ``condition`` that are not rejected yet."""
    # ``coalesce`` references the earlier value once; a ``when(...).otherwise``
    # form would reference it twice and double the expression per stage once
    # Catalyst inlines the projections.
    new = F.when(condition, rej)
    if REJECT_COL not in df.columns:
        return df.withColumn(REJECT_COL, new)
    return df.withColumn(REJECT_COL, F.coalesce(F.col(REJECT_COL), new))


def successes(df: DataFrame) -> DataFrame:
    """Rows without a reject, minus the routing column."""
    if REJECT_COL not in df.columns:
        return df
    return df.where(F.col(REJECT_COL).isNull()).drop(REJECT_COL)


def rejects(df: DataFrame, key_col: str | None = "key") -> DataFrame:
    """Reject records, keyed by the source key as text (NULL stays NULL)."""
    if REJECT_COL not in df.columns:
        raise ValueError("no reject column; nothing routed")
    key = F.col(key_col).cast("string") if key_col and key_col in df.columns else F.lit(None).cast("string")
    return df.where(F.col(REJECT_COL).isNotNull()).select(key.alias("key"), F.col(REJECT_COL + ".*"))


def stamp_processed_at(
    df: DataFrame,
    declared: bool,
    now: Column | _dt.datetime | None = None,
    column: str = "__processed_at",
) -> DataFrame:
    """Set ``__processed_at`` on non-rejected rows when the target declares it."""
    if not declared:
        return df
    stamp = _processed_at(now)
    if REJECT_COL in df.columns:
        stamp = F.when(F.col(REJECT_COL).isNull(), stamp)
    return df.withColumn(column, stamp)


# Header names added to dead letters (fixed values).
HEADER_TOPIC = "original.topic"
HEADER_MESSAGE = "exception.message"
HEADER_TYPE = "array<struct<key:string,value:binary>>"


def dead_letters(
    df: DataFrame,
    value_col: str,
    decoded_col: str,
    topic: str,
    message: Column | str = "could not decode the record value",
    headers_col: str | None = "headers",
) -> DataFrame:
    """Rows whose value did not decode, kept raw for a dead-letter sink.

    ``decoded_col`` is the result of a PERMISSIVE decoder (``try_parse_json``,
    ``from_avro`` with ``mode=PERMISSIVE``): NULL for a non-NULL value means
    the bytes were undecodable.  Key, value and the original headers pass
    through unchanged, with ``original.topic`` and ``exception.message``
    headers appended.  Processing of the other rows is unaffected.
    """
    bad = df.where(F.col(value_col).isNotNull() & F.col(decoded_col).isNull())
    extra = F.array(
        F.struct(F.lit(HEADER_TOPIC).alias("key"), F.encode(F.lit(topic), "UTF-8").alias("value")),
        F.struct(F.lit(HEADER_MESSAGE).alias("key"), F.encode(lit_or_col(message), "UTF-8").alias("value")),
    )
    if headers_col and headers_col in df.columns:
        current = F.coalesce(F.col(headers_col).cast(HEADER_TYPE), F.array().cast(HEADER_TYPE))
    else:
        current = F.array().cast(HEADER_TYPE)
    return bad.withColumn("headers", F.concat(current, extra)).drop(decoded_col)
