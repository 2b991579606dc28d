"""Keyed lookup enrichment (the per-row "fetch one column by primary key").

The original issues one point query per record.  Here the reference table is
reduced to one row per key and joined once: a left equi-join, single or
compound key, no match -> NULL.  Join strategy is Spark's: the planner
broadcasts the reference side only when its size estimate is under
``spark.sql.autoBroadcastJoinThreshold`` (and AQE re-checks at runtime).

For the sort-merge case both sides must come out of an exchange of their own,
or AQE will not split a skewed key: the reduced reference is rebalanced first,
so its grouping is not reused as the join's partitioning.  Rows without a key,
and rows to be skipped, are spread by a salt and match nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def dedupe_reference(
    ref: DataFrame, key_cols: Sequence[str], value_col: str, order_col: str | None = None
) -> DataFrame:
    """One row per key.  "First match" is made deterministic: the value, NULL
    included, of the row with the smallest ``order_col`` (ties: the smallest
    value); without an order, the smallest value.

    This is a hash aggregate with map-side partial aggregation, so a hot key
    is collapsed before the shuffle.
    """
    if order_col:
        picked = F.min_by(F.col(value_col), F.struct(F.col(order_col), F.col(value_col)))
    else:
        picked = F.min(F.col(value_col))
    return ref.groupBy(*key_cols).agg(picked.alias(value_col))


def prepare_reference(ref: DataFrame, ref_keys: Sequence[str], value_col: str, order_col: str | None = None) -> DataFrame:
    """Reference side of ``lookup``: one row per key, keys in their own type."""
    cols = [F.col(k) for k in ref_keys] + [F.col(value_col)] + ([F.col(order_col)] if order_col else [])
    return dedupe_reference(ref.select(*cols), ref_keys, value_col, order_col).hint("rebalance")


def comparable(name: str, have: T.DataType, want: T.DataType) -> Column:
    """A key as the reference compares it: text by text, anything else in the reference's type."""
    c = F.col(name)
    if isinstance(want, T.StringType):
        return c.cast("string")
    return c.try_cast(want) if isinstance(have, (T.StringType, T.NullType)) else c


def lookup(
    df: DataFrame,
    keys: Sequence[Column],
    ref: DataFrame,
    ref_keys: Sequence[str],
    value_col: str,
    output: str,
    order_col: str | None = None,
    prepared: bool = False,
    skip: Column | None = None,
) -> DataFrame:
    """Add ``output`` = ``ref.value_col`` of the row whose ``ref_keys`` equal ``keys``.

    Keys compare in the reference column's type, like a database's parameter.
    A NULL key, or a row where ``skip`` holds, never matches.  ``prepared=True``
    means ``ref`` already is the output of ``prepare_reference`` (e.g. cached
    once by a ``Context``).
    """
    if len(keys) != len(ref_keys):
        raise ValueError("keys and ref_keys differ in length")
    small = ref if prepared else prepare_reference(ref, ref_keys, value_col, order_col)
    tmp = [f"_lk_{output}_{i}" for i in range(len(keys))]
    salt = f"_lk_{output}_salt"
    right = small.select(
        *[F.col(k).alias(t) for k, t in zip(ref_keys, tmp)],
        F.col(value_col).alias(output),
        F.when(F.col(ref_keys[0]).isNotNull(), F.lit(0)).alias(salt),  # depends on a column: not folded away
    )
    left = df.select("*", *[k.alias(t) for k, t in zip(keys, tmp)])
    left = left.withColumns({t: comparable(t, left.schema[t].dataType, right.schema[t].dataType) for t in tmp})
    known = F.lit(True)
    for t in tmp:
        known = known & F.col(t).isNotNull()
    if skip is not None:
        known = known & ~F.coalesce(skip, F.lit(False))
    spread = F.pmod(F.monotonically_increasing_id(), F.lit(1000)).cast("int") + 1
    left = left.withColumn(salt, F.when(known, F.lit(0)).otherwise(spread))
    return left.join(right, on=[*tmp, salt], how="left").drop(*tmp, salt)
