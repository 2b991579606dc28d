"""Name -> mapping / schema registry, per pipeline group.

Groups: ``lv1`` (change envelopes -> silver), ``api`` (silver -> enriched
silver), ``lv2`` (silver -> gold / cache).  A mapping factory takes the
pipeline definition (a dict) and returns a ``Mapping`` or, for operators that
are joins rather than projections, a callable ``(df, ctx) -> DataFrame``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import types as T

GROUPS = ("lv1", "api", "lv2")

_MAPPERS: dict[tuple[str, str], Callable] = {}
_SCHEMAS: dict[tuple[str | None, str], T.StructType | str] = {}


def mapping(group: str, name: str):
    """Decorator registering a mapping factory under ``(group, name)``."""
    if group not in GROUPS:
        raise ValueError(f"unknown group type {group!r}")

    def deco(fn):
        _MAPPERS[(group, name)] = fn
        return fn

    return deco


def register_schema(name: str, schema: T.StructType | str, group: str | None = None) -> None:
    """Register a StructType or a DDL string (parsed on first use, when a
    session exists)."""
    _SCHEMAS[(group, name)] = schema


def get_mapper(group: str, name: str) -> Callable:
    try:
        return _MAPPERS[(group, name)]
    except KeyError:
        raise KeyError(f"no mapper {name!r} registered for group {group!r}") from None


def get_schema(name: str, group: str | None = None) -> T.StructType:
    """Group-specific schema first, then the shared one."""
    for k in ((group, name), (None, name)):
        if k in _SCHEMAS:
            st = _SCHEMAS[k]
            if isinstance(st, str):
                st = _SCHEMAS[k] = T.StructType.fromDDL(st)
            return st
    raise KeyError(f"schema {name!r} not found (group {group!r})")
