"""Queries that write and read topics on disk: commit log, shared-read fan-out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cdcflow.plans import build, spec
from cdcflow.queries import duck, fixtures
from cdcflow.queries.common import context, folder, written
from cdcflow.sources import frames
from cdcflow.sources.topics import DECODE_FAILURE, RAW_VALUE, TopicBinding, read_topic, write_topic
from cdcflow.streaming.runner import FanOut

REPLAYS = 3  # batches, the second of which is written twice


def topic_replay_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events through a topic with a commit log: a batch written twice and an attempt that
    died are read once and not at all, and each key's records keep their order."""
    path = folder(spark, "topic-log")
    bound = {"events": TopicBinding(path=path, log=True, partitions=6)}
    ev = fixtures.read(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("key"), F.struct("event_id", "event_type").alias("value"), F.col("event_id").alias("_seq"))
    for n in (0, 1, 1, 2):
        write_topic(ev.where(F.col("_seq") % REPLAYS == n), "events", bound, n, "feed")
    dead = ev.where(F.col("_seq") % REPLAYS == 0).select("key", "value", F.lit(0).cast("long").alias("_place"), F.lit(0).alias("partition"))
    dead.write.partitionBy("partition").parquet(f"{path}/data/writer=feed/batch_id={REPLAYS}")
    rows = read_topic(spark, "events", bound)
    nth = F.row_number().over(Window.partitionBy("key").orderBy("offset"))
    return rows.select("key", F.col("value.event_id").alias("event_id"), nth.cast("long").alias("nth"))


REPLAY_ORACLE = f"""
SELECT CAST(user_id AS VARCHAR) AS key, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id % {REPLAYS}, event_id) AS nth FROM events
"""


def fanout_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refined users read and decoded once for the three definitions that take them; two micro-batches, the first replayed."""
    from cdcflow.queries.lv1 import _refined_users

    ctx, root = context(spark, sf_dir), folder(spark, "fanout")
    defs = spec.load()
    mine = [d for g in ("api", "lv2") for d in defs[g] if d["sourceTopic"] == "refined.customer"]
    topics = {"refined.customer"} | {d[k] for d in mine for k in ("destinationTopic", "failTopic")}
    bound = {t: TopicBinding(path=f"{root}/{t}", log=not t.startswith("rejects")) for t in topics}
    users = written(_refined_users(spark, sf_dir).success, "users")
    fan = FanOut(spark, "refined.customer", mine, ctx, bound, f"{root}/fan")
    half = F.crc32(F.col("user_id").cast("binary")) % 2
    for n in (0, 0, 1):
        batch = users.where(half == n)
        fan.process(batch.select("key", F.struct(*[c for c in batch.columns if c != "key"]).alias("value")), n)
    out = None
    for topic, who in (("matched.address", "full_address"), ("contacts.by_channel", "user_id"), ("stamps.by_customer", "entity_id")):
        rows = read_topic(spark, topic, bound).select(F.lit(topic).alias("destination"), F.col(f"value.{who}").alias("who"))
        out = rows if out is None else out.unionByName(rows)
    return out.groupBy("destination").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("who").alias("n_who"))


def _fanout_oracle() -> str:
    image = "CASE WHEN op = 'd' THEN json_extract(value, '$.payload.before') ELSE json_extract(value, '$.payload.after') END"
    base = f"(SELECT op, id, {duck.address(duck.json_text('img', 'address'))} AS address FROM (SELECT *, {image} AS img FROM {fixtures.user_feed_sql()} f0) f1) f"
    parts = [f"SELECT 'matched.address' AS destination, count(*) AS n, count(DISTINCT address) AS n_who FROM {base} WHERE op <> 'd' AND coalesce(address, '') <> ''"]
    parts += [f"SELECT '{t}', count(*), count(DISTINCT id) FROM {base}" for t in ("contacts.by_channel", "stamps.by_customer")]
    return " UNION ALL ".join(parts)


# --- registry frames over orders -------------------------------------------------

# hex digits of what arrives: two known schemas, an unknown one, no frame, a frame cut short, a body that does not decode
_BODY = {
    5: "'{\"id\":' || CAST(o_orderkey AS STRING) || ',\"status\":\"' || o_orderstatus || '\"}'",
    300: "CAST(o_orderkey AS STRING) || ',' || o_orderstatus",
}
FRAME_HEX = (
    f"CASE o_orderkey % 9 WHEN 0 THEN '0000000005' || hex({_BODY[5]}) WHEN 1 THEN '0000000005' || hex({_BODY[5]}) WHEN 2 THEN '000000012C' || hex({_BODY[300]}) "
    f"WHEN 3 THEN '0000000007' || hex({_BODY[5]}) WHEN 4 THEN '0100000005' || hex({_BODY[5]}) WHEN 5 THEN '000000' "
    f"WHEN 6 THEN '0000000005' || hex('broken') WHEN 7 THEN NULL ELSE '007FFFFFFF' END"
)


def avro_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Framed values are routed to their schema's decoder; the rest are dead letters that say why.

    The bodies are text here (JSON and CSV), as the Avro package is not part of Spark's own."""
    o = fixtures.read(spark, sf_dir, "orders").selectExpr("CAST(o_orderkey AS STRING) AS key", f"unhex({FRAME_HEX}) AS value")
    decoders = {
        5: lambda c: F.when(F.try_parse_json(c.cast("string")).isNotNull(), F.from_json(c.cast("string"), "id bigint, status string")),
        300: lambda c: F.from_csv(c.cast("string"), "id bigint, status string"),
    }
    topic = frames.decode(o, decoders, RAW_VALUE, DECODE_FAILURE)
    good, dead = build.undecodable(topic, {"sourceTopic": "bronze.orders"})
    why = F.decode(F.element_at("headers", -1)["value"], "UTF-8")
    ok = good.select("key", F.col("value.id").alias("id"), F.col("value.status").alias("status"), F.lit(None).cast("string").alias("failure"), F.lit(None).cast("string").alias("raw"))
    again = F.hex(frames.framed(F.to_binary(F.lit("abc"), F.lit("utf-8")), 300))
    return ok.unionByName(dead.select("key", F.lit(None).cast("bigint").alias("id"), F.lit(None).cast("string").alias("status"), why.alias("failure"),
                                      F.hex("value").alias("raw"))).withColumn("sample_frame", again)


FRAMES_ORACLE = f"""
SELECT key, CASE WHEN kind IN (0, 1, 2) THEN o_orderkey END AS id, CASE WHEN kind IN (0, 1, 2) THEN o_orderstatus END AS status,
       CASE WHEN raw IS NULL THEN NULL WHEN length(raw) < 10 OR raw[1:2] <> '00' THEN 'the value has no schema-registry frame'
            WHEN sid NOT IN (5, 300) THEN 'schema id ' || sid || ' is not known'
            WHEN kind = 6 THEN 'the record does not decode with schema id ' || sid END AS failure,
       CASE WHEN kind NOT IN (0, 1, 2) THEN raw END AS raw, '000000012C616263' AS sample_frame
FROM (SELECT *, TRY_CAST('0x' || raw[3:10] AS BIGINT) AS sid FROM (
        SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderkey, o_orderstatus, o_orderkey % 9 AS kind, {FRAME_HEX} AS raw FROM orders) a) b
"""

QUERIES = {"avro_frames": avro_frames, "topic_replay_once": topic_replay_once, "fanout_routes": fanout_routes}
ORACLE = {"avro_frames": FRAMES_ORACLE, "topic_replay_once": REPLAY_ORACLE, "fanout_routes": _fanout_oracle()}
