"""Connected components of a link table by label spreading with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcflow.llm.store import stage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(v, label)``: every vertex of ``edges`` with the smallest vertex it reaches.

    Each round takes the least label of all neighbours (partially aggregated
    minima), then jumps to the label's own label; rounds grow with the logarithm
    of the longest chain.  Labels live in written tables between rounds.  Null
    ends are ignored; an empty table gives an empty result.
    """
    e = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x IS NOT NULL AND y IS NOT NULL")
    both = stage(e.union(e.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "links")
    labels = stage(both.groupBy(F.col("x").alias("v")).agg(F.least(F.min("y"), F.min("x")).alias("label")), "labels")
    while True:
        seen = both.join(labels, both.x == labels.v).select(F.col("y").alias("v"), "label", F.lit(None).cast("long").alias("old"))
        own = labels.select("v", "label", F.col("label").alias("old"))
        near = seen.unionByName(own).groupBy("v").agg(F.min("label").alias("label"), F.max("old").alias("old"))
        up = labels.select(F.col("v").alias("u"), F.col("label").alias("up"))
        jumped = near.join(up, near.label == up.u).select("v", F.least("label", "up").alias("label"), "old")
        labels = stage(jumped, "labels")
        if labels.where("label <> old").isEmpty():
            return labels.select("v", "label")
