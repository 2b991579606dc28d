"""Run context handed to mapping factories."""

from __future__ import annotations

import datetime as _dt
import threading
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from cdcflow.operators.protect import redact_plans


@dataclass(eq=False)
class _Prepared:
    """A prepared table and the batches that use it."""

    df: DataFrame | None = None
    since: float = 0.0
    users: int = 0
    retired: bool = False
    lock: threading.Lock = field(default_factory=threading.Lock, repr=False)

    def drop(self) -> None:
        if self.retired and self.users == 0 and self.df is not None:
            self.df.unpersist()


@dataclass
class Context:
    """What a mapping may need besides the row: reference tables, keys, clock.

    ``tables``: reference DataFrames by name (keyed lookups, address sets).
    A table may be a function that reads it, so that every preparation sees the
    source as it then is, or a ``pushed.Reference`` that reads what a batch's keys need.
    ``protect_key``: AES key for protect/reveal rules.
    ``now`` / ``as_of``: pinned clock for reproducible runs (None = real time).
    ``refresh_seconds``: age from which ``refresh`` prepares a table anew; 0 means
    for every micro-batch, None never.
    """

    spark: SparkSession | None = None
    tables: dict = field(default_factory=dict)
    protect_key: str | None = field(default=None, repr=False)
    now: _dt.datetime | None = None
    as_of: _dt.date | None = None

    refresh_seconds: float | None = 0

    prepared: dict[str, _Prepared] = field(default_factory=dict)
    _lock: threading.RLock = field(default_factory=threading.RLock, repr=False)
    _mine: threading.local = field(default_factory=threading.local, repr=False)

    def __post_init__(self) -> None:
        if self.protect_key and self.spark is not None:
            redact_plans(self.spark)

    def bound(self, name: str):
        """What a reference name is bound to: a DataFrame, a function that reads one, or a ``pushed.Reference``."""
        if name not in self.tables:
            raise KeyError(f"reference table {name!r} is not bound in the context")
        return self.tables[name]

    def table(self, name: str) -> DataFrame:
        t = self.bound(name)
        return t() if callable(t) else t

    def reference(self, key: str, name: str, prepare: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """A reference table prepared once per context (deduplicated, summarised) and persisted.

        A streaming run reuses it until it is older than ``refresh_seconds``.  It is
        materialised here, so the planner sees its real size: it is broadcast only
        when under ``spark.sql.autoBroadcastJoinThreshold``, joined by shuffle
        otherwise.  Lost cache blocks are recomputed from the source.  Queries that
        need different tables do not wait for each other.  For tables that are large
        beside a batch, bind a ``pushed.Reference`` instead: it is not read whole.
        """
        with self._lock:
            p = self.prepared.setdefault(key, _Prepared())
            held = getattr(self._mine, "held", None)
            if held is not None and p not in held:
                held.append(p)
                p.users += 1
        with p.lock:  # one thread prepares, others that need this table wait
            if p.df is None:
                df = prepare(self.table(name)).persist(StorageLevel.MEMORY_AND_DISK)
                df.count()
                p.df = df
                p.since = time.monotonic()
            return p.df

    def refresh(self) -> None:
        """Retire prepared tables older than ``refresh_seconds``: the next use prepares them anew.

        A batch that is using a table keeps it; the table is let go when the last
        such batch ends.
        """
        if self.refresh_seconds is None:
            return
        with self._lock:
            for key, p in list(self.prepared.items()):
                if p.df is not None and time.monotonic() - p.since >= self.refresh_seconds:
                    del self.prepared[key]
                    p.retired = True
                    p.drop()

    @contextmanager
    def batch(self) -> Iterator[Context]:
        """A micro-batch: begins with ``refresh``, keeps the tables it uses until it ends."""
        self.refresh()
        outer, self._mine.held = getattr(self._mine, "held", None), []
        try:
            yield self
        finally:
            with self._lock:
                for p in self._mine.held:
                    p.users -= 1
                    p.drop()
            self._mine.held = outer

    def release(self) -> None:
        with self._lock:
            for p in self.prepared.values():
                p.retired = True
                p.drop()
            self.prepared.clear()
