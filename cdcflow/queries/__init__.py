"""Registered queries (``(spark, sf_dir) -> DataFrame``) and their DuckDB oracles."""

from __future__ import annotations

from cdcflow.queries import checks, envelopes, lv1, mappings, scalars, states, topics

_MODULES = [lv1, scalars, envelopes, mappings, states, checks, topics]


def all_queries() -> dict:
    out: dict = {}
    for m in _MODULES:
        out.update(m.QUERIES)
    return out


def all_oracles() -> dict:
    out: dict = {}
    for m in _MODULES:
        out.update(m.ORACLE)
    return out
