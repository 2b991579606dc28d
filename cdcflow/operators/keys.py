"""Record keys: struct keys from primary-key fields and formatted string keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcflow.functions.text import format_template


def _check(df: DataFrame, fields: Sequence[str]) -> None:
    missing = [f for f in fields if f not in df.columns]
    if missing:
        raise ValueError(f"Primary key field(s) {missing} not found in mapped schema")
    if not fields:
        raise ValueError("no primary key fields")


def struct_key(df: DataFrame, pk_fields: Sequence[str], out: str = "key") -> DataFrame:
    """``key`` = ``struct(pk...)`` in declared order; unknown fields fail at plan time."""
    _check(df, pk_fields)
    return df.withColumn(out, F.struct(*[F.col(f"`{f}`") for f in pk_fields]))


def json_key(pk_fields: Sequence[str]) -> Column:
    """JSON object text of the key fields; NULL values are written as ``null``.

    Deviation: the original's key order is a hash map's; we fix declared order.
    """
    return F.to_json(F.struct(*[F.col(f"`{f}`") for f in pk_fields]), {"ignoreNullFields": "false"})


def string_key(
    df: DataFrame, pk_fields: Sequence[str] = (), key_format: str | None = None, out: str = "key"
) -> DataFrame:
    """String key: ``key_format`` (``{field}`` placeholders) when set, else JSON of the PK."""
    if key_format:
        fields = {c: F.col(f"`{c}`") for c in df.columns if c != out}
        return df.withColumn(out, format_template(key_format, fields))
    _check(df, pk_fields)
    return df.withColumn(out, json_key(pk_fields))
