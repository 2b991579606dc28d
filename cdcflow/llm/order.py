"""Places of rows in a global order, without gathering a group in one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cdcflow.llm.store import stage

ROWS = 100_000  # rows of a range, about


def numbered(df: DataFrame, group: list[str], order: list[Column], name: str = "numbered") -> DataFrame:
    """``df`` plus ``pos`` (from 0, by ``order`` within equal ``group`` columns) and ``total`` (rows of the group).

    Rows are dealt by ranges of (group, order), so a group of any size spreads
    over as many ranges as its rows fill.  Only a row per range and group is
    summed up.  Null groups are a group; rows that tie keep any order.  ``df``
    is read three times and should be a written table of short rows.
    """
    parts = max(1, math.ceil(df.count() / ROWS))
    keys = [*[F.col(f"`{c}`") for c in group], *order]
    at = F.monotonically_increasing_id()
    placed = stage(df.repartitionByRange(max(parts, 2), *keys).sortWithinPartitions(*keys)
                   .withColumn("_at", at).withColumn("_part", F.shiftright(F.col("_at"), 33)), f"{name}-placed")
    runs = placed.groupBy(*group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    mine = Window.partitionBy(*[F.col(f"`{c}`") for c in group])
    runs = runs.select(*[F.col(f"`{c}`").alias(f"_g{k}") for k, c in enumerate(group)], F.col("_part").alias("_p"), "_first",
                       (F.sum("_n").over(mine.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_before"),
                       F.sum("_n").over(mine).alias("total"))
    same = F.col("_part") == F.col("_p")
    for k, c in enumerate(group):
        same = same & F.col(f"`{c}`").eqNullSafe(F.col(f"_g{k}"))
    pos = (F.col("_at") - F.col("_first") + F.col("_before")).alias("pos")
    return placed.join(runs, same).select(*[f"`{c}`" for c in df.columns], pos, "total")
