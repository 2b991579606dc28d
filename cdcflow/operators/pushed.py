"""Lookups that cost as much as the batch: its keys decide what is read of the reference.

``asked`` finds the distinct keys of a batch.  Up to ``AT_MOST`` of them are listed,
for more the range of each key column is taken; either way one small row set
reaches the driver.  A ``Reference`` then reads only what those keys need:

* files: the list (or range) is a filter on the scan, so row groups and rows are
  skipped where they are and only matching rows enter a shuffle;
* JDBC: lists become ``IN`` predicates of ``CHUNK`` keys, one query each, read in
  parallel; a range becomes a bounded parallel read;
* a ``StateReference`` keeps the reference current by its change column in bucketed
  state: a refresh reads the rows changed since the last, a lookup the buckets of
  its keys.

The rows read may be more than asked for, never fewer: the join on the key decides
(``lookup.lookup``), so results are those of a lookup over the whole table.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcflow.operators.lookup import comparable, lookup

AT_MOST = 10_000  # keys listed one by one
CHUNK = 500       # keys of one JDBC query
_PLAIN = re.compile(r"[A-Za-z0-9 _.:@-]*")


def _among(name: str, c: Column, kind: T.DataType, values: list) -> Column:
    """``c IN (values)`` as literals of the column's own type: a cast would keep the filter from the scan."""
    if isinstance(kind, T.StringType):
        # anything but plain text by its bytes, which folds to a literal: no escaping rules to get wrong
        texts = [f"'{v}'" if _PLAIN.fullmatch(v) else f"CAST(X'{v.encode().hex()}' AS STRING)" for v in values]
    elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        texts = [str(v) + {"bigint": "L", "smallint": "S", "tinyint": "Y"}.get(kind.simpleString(), "") for v in values]
    else:
        return c.isin(*[F.lit(v).cast(kind) for v in values])
    return F.expr(f"`{name}` IN ({', '.join(texts)})")  # one SQL text: thousands of literal calls take seconds


@dataclass
class Keys:
    """What a batch asks for: listed keys, or the least and greatest value of each key column."""

    columns: list[str]
    types: list[T.DataType]
    listed: list[tuple] | None = None
    ranges: list[tuple] | None = None
    frame: DataFrame | None = field(default=None, repr=False)

    @property
    def none(self) -> bool:
        return not self.listed if self.ranges is None else any(lo is None for lo, _ in self.ranges)

    def condition(self) -> Column:
        """A filter that holds for every row asked for (and maybe for others, with several key columns)."""
        if self.none:
            return F.lit(False)
        out = None
        for k, (name, kind) in enumerate(zip(self.columns, self.types)):
            c = F.col(f"`{name}`")
            if self.listed is not None:
                part = _among(name, c, kind, sorted({row[k] for row in self.listed}))
            else:
                lo, hi = (F.lit(v).cast(kind) for v in self.ranges[k])
                part = c.between(lo, hi)
            out = part if out is None else out & part
        return out


def asked(df: DataFrame, keys: Sequence[Column], ref_schema: T.StructType, ref_keys: Sequence[str], skip: Column | None = None, at_most: int = AT_MOST) -> Keys:
    """The distinct non-NULL keys of ``df``, in the reference's types."""
    types = [ref_schema[k].dataType for k in ref_keys]
    given = df.where(~F.coalesce(skip, F.lit(False))) if skip is not None else df
    given = given.select(*[k.alias(f"_k{i}") for i, k in enumerate(keys)])
    typed = given.select(*[comparable(f"_k{i}", given.schema[i].dataType, t).cast(t).alias(n) if not isinstance(t, T.StringType) else
                           F.col(f"_k{i}").cast("string").alias(n) for i, (t, n) in enumerate(zip(types, ref_keys))]).dropna()
    some = typed.distinct().limit(at_most + 1).collect()
    if len(some) <= at_most:
        return Keys(list(ref_keys), types, listed=[tuple(r) for r in some], frame=typed)
    ends = typed.agg(*[f(n).alias(f"{f.__name__}{i}") for i, n in enumerate(ref_keys) for f in (F.min, F.max)]).first()
    return Keys(list(ref_keys), types, ranges=[(ends[2 * i], ends[2 * i + 1]) for i in range(len(ref_keys))], frame=typed)


class Reference(Protocol):
    """A reference table that reads what some keys need."""

    def schema(self) -> T.StructType: ...

    def rows(self, keys: Keys, columns: Sequence[str]) -> DataFrame: ...


@dataclass
class FileReference:
    """A reference in files: ``read`` gives it as it then is."""

    read: Callable[[], DataFrame]

    def schema(self) -> T.StructType:
        return self.read().schema

    def rows(self, keys: Keys, columns: Sequence[str]) -> DataFrame:
        return self.read().where(keys.condition()).select(*columns)


def quoted(value) -> str:
    """A key as an SQL literal."""
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    return str(value) if isinstance(value, (int, float)) else "'" + str(value).replace("'", "''") + "'"


def predicates(keys: Keys, chunk: int = CHUNK) -> list[str]:
    """Disjoint SQL conditions that together hold for the listed keys: one query each."""
    rows = sorted(set(keys.listed or []), key=lambda r: tuple(map(str, r)))
    out = []
    for a in range(0, len(rows), chunk):
        part = rows[a : a + chunk]
        if len(keys.columns) == 1:
            out.append(f"{keys.columns[0]} IN ({', '.join(quoted(r[0]) for r in part)})")
        else:
            out.append(" OR ".join("(" + " AND ".join(f"{c} = {quoted(v)}" for c, v in zip(keys.columns, r)) + ")" for r in part))
    return out


@dataclass
class JdbcReference:
    """A reference behind JDBC."""

    spark: SparkSession
    url: str
    table: str
    properties: dict = field(default_factory=dict)
    partition_column: str | None = None
    num_partitions: int | None = None
    chunk: int = CHUNK

    def schema(self) -> T.StructType:
        return self.spark.read.jdbc(self.url, self.table, properties=self.properties).schema  # reads no rows

    def rows(self, keys: Keys, columns: Sequence[str]) -> DataFrame:
        if keys.none:
            return self.spark.createDataFrame([], self.schema()).select(*columns)
        if keys.listed is not None:
            return self.spark.read.jdbc(self.url, self.table, predicates=predicates(keys, self.chunk), properties=self.properties).select(*columns)
        ranges = {}
        if self.partition_column in keys.columns:
            lo, hi = keys.ranges[keys.columns.index(self.partition_column)]
            ranges = {"column": self.partition_column, "lowerBound": lo, "upperBound": hi,
                      "numPartitions": self.num_partitions or self.spark.sparkContext.defaultParallelism}
        read = self.spark.read.jdbc(self.url, self.table, properties=self.properties, **ranges)
        return read.where(keys.condition()).select(*columns)


class StateReference:
    """A reference kept current by its change column (a BIGINT or TIMESTAMP that grows with every change).

    Deletes are not seen by a change column; a flag column named ``__op`` with ``d`` is one.
    """

    def __init__(self, table, read: Callable[[], DataFrame], change_col: str):
        self.table, self.read, self.change_col = table, read, change_col

    def _mark(self) -> Column:
        kind = self.read().schema[self.change_col].dataType
        c = F.col(f"`{self.change_col}`")
        if isinstance(kind, T.TimestampNTZType):  # a wall clock has no zone: read it as UTC's
            c = F.to_utc_timestamp(c.cast("timestamp"), "UTC")
        return F.unix_micros(c.cast("timestamp")) if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else c.cast("long")

    def refresh(self) -> int | None:
        """Merge the rows changed since the last refresh; returns the new mark."""
        m = self.table.manifest()
        last = m.writers.get("reference") if m else None
        source = self.read()
        if last is not None:
            kind = source.schema[self.change_col].dataType
            since = F.timestamp_micros(F.lit(last)) if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else F.lit(last)
            source = source.where(F.col(f"`{self.change_col}`") >= since.cast(kind))  # on the scan
            # of the last instant's rows, as more of them may have come, those that the state lacks
            again = source.where(F.col(f"`{self.change_col}`") == since.cast(kind))
            have = self.table.lookup(again)
            new = source.where(F.col(f"`{self.change_col}`") > since.cast(kind))
            source = new.unionByName(again if have is None else again.join(have, [*self.table.key_cols, self.change_col], "left_anti").select(*source.columns))
        if self.table.op_col not in source.columns:
            source = source.withColumn(self.table.op_col, F.lit(None).cast("string"))
        top = source.agg(F.max(self._mark()).alias("m")).first()["m"]
        if top is None:
            return last
        self.table.merge(source, int(top), "reference") if last is None or top > last else self.table.merge(source)
        return int(top)

    def schema(self) -> T.StructType:
        return self.read().schema

    def rows(self, keys: Keys, columns: Sequence[str]) -> DataFrame:
        if self.table.manifest() is None:
            self.refresh()
        if keys.frame is None:
            found = self.table.read()
        else:
            found = self.table.lookup(keys.frame)
        return self.table.spark.createDataFrame([], self.schema()).select(*columns) if found is None else found.select(*columns)


def lookup_pushed(
    df: DataFrame, keys: Sequence[Column], reference: Reference, ref_keys: Sequence[str], value_col: str, output: str,
    order_col: str | None = None, skip: Column | None = None, at_most: int = AT_MOST,
) -> DataFrame:
    """``lookup.lookup`` over the part of ``reference`` that the keys of ``df`` need.

    ``df`` is read once more, for its keys; a micro-batch should be persisted.
    """
    want = asked(df, keys, reference.schema(), ref_keys, skip, at_most)
    part = reference.rows(want, list(dict.fromkeys([*ref_keys, value_col, *([order_col] if order_col else [])])))
    return lookup(df, keys, part, ref_keys, value_col, output, order_col, skip=skip)
