"""Queries that run the written state: buckets, tombstones (event feed)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcflow.operators import envelope
from cdcflow.operators.changes import keyed_changes
from cdcflow.queries import envelopes
from cdcflow.queries.common import folder, written
from cdcflow.streaming.state import StateTable

BATCHES = 5
ORDER = (3, 0, 4, 1, 2)  # batches come out of order


def cdc_state_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes in five batches that overlap in time, one of them replayed, merged into bucketed state."""
    feed = written(envelopes._changes(spark, sf_dir), "changes")
    table = StateTable(spark, folder(spark, "state"), ["user_id"], ["event_id"], buckets=8)
    for n, k in enumerate(ORDER):
        batch = feed.where(F.col("event_id") % BATCHES == k)
        table.merge(batch, n, "feed")
        if n == 2:
            table.merge(batch, n, "feed")
    return table.read()


def cdc_state_tombstones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deletes arrive as records without a value: the state equals that of the changes themselves."""
    fields = ["user_id", "email", "__op"]
    rows = envelopes._changes(spark, sf_dir).select(F.col("user_id").alias("key"), F.struct(*fields).alias("value"), "event_id", F.col("__op"))
    topic = written(envelope.tombstone_on_delete(rows).drop("__op"), "topic")
    table = StateTable(spark, folder(spark, "state"), ["user_id"], ["event_id"], buckets=8)
    for n in range(2):
        table.merge(keyed_changes(topic.where(F.col("event_id") % 2 == n), ["user_id"], ["event_id"]), n, "topic")
    return table.read().select("user_id", "event_id", "__op", "email")


QUERIES = {"cdc_state_buckets": cdc_state_buckets, "cdc_state_tombstones": cdc_state_tombstones}
ORACLE = {"cdc_state_buckets": envelopes.LATEST_ORACLE, "cdc_state_tombstones": envelopes.LATEST_ORACLE}
