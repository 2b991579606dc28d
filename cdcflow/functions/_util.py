"""Small shared helpers for Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_or_col(c) -> Column:
    if isinstance(c, Column):
        return c
    return F.lit(c)
