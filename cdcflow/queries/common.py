"""Pinned clock, sample key and context shared by the registered queries."""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcflow.plans import spec
from cdcflow.plans.context import Context
from cdcflow.queries import fixtures
from cdcflow.session import ensure_checkpoint_dir

# Fixed values for reproducible checks.
NOW_MS = 1735689600000                      # 2025-01-01T00:00:00Z
AS_OF = _dt.date(2025, 1, 1)
AS_OF_SQL = "DATE '2025-01-01'"
PROCESSED_AT_MS = NOW_MS + 9 * 3_600_000    # the stamp written for NOW_MS
SAMPLE_KEY = "cdcflow-sample-protect-key-32byt"  # 32 bytes, AES-256


def now_col() -> Column:
    """The pinned "now" as a TIMESTAMP (session time zone free)."""
    return F.timestamp_millis(F.lit(NOW_MS))


_CONTEXTS: dict[tuple, Context] = {}


def context(spark: SparkSession, sf_dir: str) -> Context:
    """One context per application and table set, so prepared reference
    tables are shared by all queries.  Tables are bound lazily."""
    from cdcflow.queries.mappings import address_reference

    k = (spark.sparkContext.applicationId, sf_dir)
    if k not in _CONTEXTS:
        tables = {"USERS": lambda: fixtures.users_table(spark, sf_dir), "ADDRESSES": lambda: address_reference(spark, sf_dir)}
        _CONTEXTS[k] = Context(spark=spark, tables=tables, protect_key=SAMPLE_KEY, now=now_col(), as_of=AS_OF)
    return _CONTEXTS[k]


def definition(group: str, name: str) -> dict:
    for d in spec.load()[group]:
        if d["name"] == name:
            return d
    raise KeyError(name)


def folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a topic on disk, as between the levels of a running job: later steps read it instead of deriving it again."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
