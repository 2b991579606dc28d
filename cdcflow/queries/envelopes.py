"""Queries over change envelopes, routing and rejects (event feed, orders).

Oracles re-implement the envelope rules in DuckDB over the same envelope text
(DuckDB's own JSON parser), independent of the Spark VARIANT path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcflow.functions.jsonval import json_text
from cdcflow.functions.text import clean_email
from cdcflow.operators import changes, envelope, rejects
from cdcflow.plans import build
from cdcflow.queries import duck, fixtures
from cdcflow.queries.common import PROCESSED_AT_MS, context, definition, now_col, written

PARSE_FAILED = envelope.PARSE_FAILED


# --- Spark side -------------------------------------------------------------

def _unwrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = fixtures.event_feed(spark, sf_dir).select("key", "value", "event_id", "event_type")
    return envelope.unwrap_json(feed, now=now_col())


def _reject_cols() -> list:
    return [F.col("_reject.reason").alias("reason"), F.col("_reject.error_context").alias("error_context")]


def cdc_json_unwrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = _unwrapped(spark, sf_dir)
    return u.select(
        "event_id", "__op",
        json_text(F.col("data"), "id").alias("image_id"),
        json_text(F.col("data"), "name").alias("image_name"),
        *_reject_cols(),
    )


def cdc_op_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unwrapped(spark, sf_dir).select("event_id", "__op")


def cdc_image_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok = rejects.successes(_unwrapped(spark, sf_dir))
    side = F.when(F.col("__op") == "d", F.lit("before")).otherwise(F.lit("after"))
    return ok.select("event_id", "__op", side.alias("image_side"), json_text(F.col("data"), "id").alias("image_id"))


def cdc_op_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok = rejects.successes(_unwrapped(spark, sf_dir))
    return ok.groupBy("__op").agg(F.count(F.lit(1)).alias("n"))


def cdc_missing_image_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = rejects.rejects(_unwrapped(spark, sf_dir), "key")
    return bad.where(F.col("reason").like("missing %") | F.col("reason").like("% image is not an object")).select(
        "key", "reason", "error_context", "payload"
    )


def cdc_parse_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = rejects.rejects(_unwrapped(spark, sf_dir), "key")
    return bad.where(F.col("reason") == PARSE_FAILED).select("key", "reason", "error_context", "payload")


def cdc_drop_tombstones(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = fixtures.event_feed(spark, sf_dir)
    return feed.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_in"), F.count("value").alias("n_kept"))


def tombstone_on_delete_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok = rejects.successes(_unwrapped(spark, sf_dir)).select("event_id", "key", "value", "__op")
    t = envelope.tombstone_on_delete(ok)
    return t.select("event_id", "key", "__op", F.col("value").isNull().alias("is_tombstone"))


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Successful changes; those without an id share the NULL key."""
    ok = rejects.successes(_unwrapped(spark, sf_dir))
    return ok.select(
        json_text(F.col("data"), "id").alias("user_id"),
        "event_id", "__op",
        clean_email(json_text(F.col("data"), "email")).alias("email"),
    )


def cdc_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.latest_state(_changes(spark, sf_dir), ["user_id"], ["event_id"])


def cdc_apply_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same changes in three batches that overlap in time, the last batch's first."""
    feed = written(_changes(spark, sf_dir), "changes")  # unwrapped once
    state = None
    for k in (2, 0, 1):
        state = changes.apply_changes(state, feed.where(F.col("event_id") % 3 == k), ["user_id"], ["event_id"])
    return changes.live(state)


def _refined_events(spark: SparkSession, sf_dir: str):
    defn = definition("lv1", "RefineCustomers")
    feed = fixtures.event_feed(spark, sf_dir).select("key", "value")
    return build.route(build.refine(feed, defn, context(spark, sf_dir)), defn)


ROUTE_OUT = ["user_id", "user_name", "email", "phone", "is_active", "decrypted_ssn", "created_at", "__op", "__processed_at"]


def route_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refined_events(spark, sf_dir).success.select(*ROUTE_OUT)


def route_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refined_events(spark, sf_dir).rejects.select("key", "reason", "error_context", "payload")


def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refined_events(spark, sf_dir).rejects.groupBy("reason", "error_context").agg(F.count(F.lit(1)).alias("n"))


def required_field_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _refined_events(spark, sf_dir).rejects
    return r.where(F.col("error_context") == rejects.CTX_MAPPING).select("key", "reason", "payload")


PROPS_RAW = (
    "CASE WHEN event_id % 53 = 0 THEN substr(props, 1, length(props) - 1) "
    "WHEN event_id % 59 = 0 THEN NULL ELSE props END"
)
DLQ_TOPIC = "bronze.events"


def undecodable_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The route of the running job: decode as the topic is bound, part what did not decode."""
    from cdcflow.sources.topics import TopicBinding, decoded

    ev = fixtures.read(spark, sf_dir, "events").selectExpr(
        "event_id", "CAST(user_id AS STRING) AS key", f"{PROPS_RAW} AS value"
    )
    _, dlq = build.undecodable(decoded(ev, TopicBinding(value_schema="k string")), {"sourceTopic": DLQ_TOPIC})
    hdr = F.col("headers")
    return dlq.select(
        "event_id", "key", "value",
        F.size(hdr).alias("n_headers"),
        F.decode(F.element_at(hdr, -2)["value"], "UTF-8").alias("original_topic"),
        F.element_at(hdr, -1)["key"].alias("last_header"),
    )


# --- struct (decoded record) envelopes from orders ---------------------------

ORDER_OP = "CASE o_orderkey % 5 WHEN 0 THEN 'c' WHEN 1 THEN 'u' WHEN 2 THEN 'd' WHEN 3 THEN NULL ELSE 'd' END"
ORDER_TOMBSTONE = "o_orderkey % 13 = 0"  # which derived records carry a NULL value


def cdc_struct_unwrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = fixtures.read(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_custkey", "o_orderstatus", f"{ORDER_OP} AS op", "o_orderkey % 5 AS kind", f"{ORDER_TOMBSTONE} AS tomb"
    )
    image = F.struct("o_orderkey", "o_custkey", "o_orderstatus")
    before = F.when(F.col("kind") == 2, image)  # kind 4: a delete without its before image
    after = F.when(F.col("kind").isin(0, 1, 3), image)
    value = F.when(~F.col("tomb"), F.struct(F.col("op").alias("op"), before.alias("before"), after.alias("after")))
    src = o.select(F.col("o_orderkey").cast("string").alias("key"), value.alias("value"), "o_orderkey")
    u = envelope.unwrap_struct(src, now=now_col())
    return u.select(
        "o_orderkey", "__op",
        json_text(F.col("data"), "o_orderstatus").alias("status"),
        json_text(F.col("data"), "o_custkey").alias("custkey"),
        F.col("_reject.reason").alias("reason"),
    )


CDC_STRUCT_ORACLE = f"""
SELECT o_orderkey,
       CASE WHEN kind = 3 THEN 'c' ELSE op END AS __op,
       CASE WHEN kind = 4 THEN NULL ELSE o_orderstatus END AS status,
       CASE WHEN kind = 4 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS custkey,
       CASE WHEN kind = 4 THEN 'missing before image' END AS reason
FROM (SELECT *, {ORDER_OP} AS op, o_orderkey % 5 AS kind, {ORDER_TOMBSTONE} AS tombstone FROM orders) o
WHERE NOT tombstone  -- tombstones (NULL values) are dropped
"""


def cdc_struct_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded records that cannot be refined: no image in the record, or no image fields at all."""
    o = fixtures.read(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_orderstatus", f"{ORDER_OP} AS op")
    image = F.when(F.col("o_orderkey") % 2 == 0, F.struct("o_orderkey", "o_orderstatus"))
    whole = o.select("o_orderkey", F.col("o_orderkey").cast("string").alias("key"), F.struct("op", image.alias("before"), image.alias("after")).alias("value"))
    bare = o.select("o_orderkey", F.col("o_orderkey").cast("string").alias("key"), F.struct("op", F.col("o_orderstatus").alias("note")).alias("value"))
    out = None
    for kind, df in (("whole", whole), ("bare", bare)):
        bad = rejects.rejects(envelope.unwrap_struct(df, now=now_col()), "key").select(
            F.lit(kind).alias("kind"), "key", "reason", "error_context", "payload")
        out = bad if out is None else out.unionByName(bad)
    return out


STRUCT_REJECTS_ORACLE = f"""
SELECT 'whole' AS kind, CAST(o_orderkey AS VARCHAR) AS key,
       'missing ' || CASE WHEN op = 'd' THEN 'before' ELSE 'after' END || ' image' AS reason, CAST(NULL AS VARCHAR) AS error_context,
       CASE WHEN op IS NULL THEN '{{}}' ELSE '{{"op":"' || op || '"}}' END AS payload
FROM (SELECT *, {ORDER_OP} AS op FROM orders) o WHERE o_orderkey % 2 <> 0
UNION ALL
SELECT 'bare', CAST(o_orderkey AS VARCHAR), 'Avro processing failed: no before or after image in the record', 'avro_processing',
       '{{' || CASE WHEN op IS NULL THEN '' ELSE '"op":"' || op || '",' END || '"note":"' || o_orderstatus || '"}}'
FROM (SELECT *, {ORDER_OP} AS op FROM orders) o
"""


def struct_timestamp_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times of decoded records read like the raw numbers they stand for."""
    o = fixtures.read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp_ntz").alias("t"))
    image = F.struct("o_orderkey", F.col("t").alias("ordered_at"), F.col("t").cast("date").alias("ordered_on"), F.encode(F.lit("bytes"), "UTF-8").alias("raw"))
    src = o.select("o_orderkey", F.struct(F.lit("c").alias("op"), image.alias("after")).alias("value"))
    u = envelope.unwrap_struct(src, now=now_col())
    text = lambda f: json_text(F.col("data"), f)
    return u.select("o_orderkey", text("ordered_at").cast("bigint").alias("ordered_ms"), text("ordered_on").cast("int").alias("ordered_days"),
                    text("raw").alias("raw"))


STRUCT_TIMES_ORACLE = """
SELECT o_orderkey, epoch_ms(o_orderdate) AS ordered_ms, CAST(CAST(o_orderdate AS DATE) - DATE '1970-01-01' AS INTEGER) AS ordered_days,
       'bytes' AS raw
FROM orders
"""


CHAIN_FIELDS = "user_id string, user_name string, email string, phone string, address string, is_active boolean, created_at bigint, __op string, __processed_at bigint"
CHAIN_BROKEN = "CAST(substr(user_id, 2) AS BIGINT) % 17 = 0"  # which records arrive cut short


def chain_json_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refined users as a JSON text topic, written once, through the later levels: rows in = successes +
    rejects + dead letters + the rows that a mapping drops by its rule."""
    from cdcflow.queries.lv1 import _refined_users
    from cdcflow.sources.topics import RAW_VALUE, TopicBinding, decoded

    ctx = context(spark, sf_dir)
    names = [f.split(" ")[0] for f in CHAIN_FIELDS.split(", ")]
    text = F.to_json(F.struct(*names))
    topic = _refined_users(spark, sf_dir).success.select(
        F.col("user_id").alias("key"), F.when(F.expr(CHAIN_BROKEN), F.substring(text, 1, 40)).otherwise(text).alias("value"))
    read = decoded(written(topic, "topic"), TopicBinding(value_schema=CHAIN_FIELDS))
    stages = [("api", "MatchCustomerAddresses"), ("lv2", "ContactsCustomers"), ("lv2", "StampsCustomers")]
    good, _ = build.undecodable(read, definition(*stages[0]))
    lost = F.col("value").isNull() & F.col(RAW_VALUE).isNotNull()
    came = read.agg(F.count(F.lit(1)).alias("in"), F.count(F.when(lost, 1)).alias("dead"))
    pairs = lambda *names: F.inline(F.array(*[F.struct(F.lit(n).alias("what"), F.col(n).alias("n")) for n in names]))
    out = came.select("*", F.explode(F.array(*[F.lit(n) for _, n in stages])).alias("stage")).select("stage", pairs("in", "dead"))
    for group, name in stages:  # one pass a stage
        refined = build.refine(good, definition(group, name), ctx)
        counts = refined.agg(F.count(F.when(F.col(rejects.REJECT_COL).isNull(), 1)).alias("success"), F.count(rejects.REJECT_COL).alias("reject"))
        out = out.unionByName(counts.select(F.lit(name).alias("stage"), pairs("success", "reject")))
    return out


def _chain_oracle() -> str:
    image = "CASE WHEN op = 'd' THEN json_extract(value, '$.payload.before') ELSE json_extract(value, '$.payload.after') END"
    base = (f"(SELECT op, {duck.address(duck.json_text('img', 'address'))} AS address, c_custkey % 17 = 0 AS broken "
            f"FROM (SELECT *, {image} AS img FROM {fixtures.user_feed_sql()} f0) f1) f")
    parts = []
    for stage, ok in (("MatchCustomerAddresses", "NOT broken AND op <> 'd' AND coalesce(address, '') <> ''"), ("ContactsCustomers", "NOT broken"), ("StampsCustomers", "NOT broken")):
        for what, cond in (("in", "true"), ("success", ok), ("reject", "false"), ("dead", "broken")):
            parts.append(f"SELECT '{stage}' AS stage, '{what}' AS what, count(*) FILTER (WHERE {cond}) AS n FROM {base}")
    return " UNION ALL ".join(parts)


EVENT_TOMBSTONE = "event_id % 89 = 0"  # which derived records carry a NULL value


def flat_source_non_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = fixtures.read(spark, sf_dir, "events")
    rec = F.when(~F.expr(EVENT_TOMBSTONE), F.struct("event_id", "event_type", "value"))
    topic = ev.select(F.col("user_id").cast("string").alias("key"), rec.alias("value"))
    flat = build.normalize_source(topic, {"group": "lv2"}, context(spark, sf_dir))
    return flat.select("key", "event_id", "event_type")


FLAT_ORACLE = f"""
SELECT key, event_id, event_type FROM (
  SELECT CAST(user_id AS VARCHAR) AS key, event_id, event_type,
         CASE WHEN {EVENT_TOMBSTONE} THEN NULL ELSE struct_pack(event_id, event_type, value) END AS value
  FROM events) t
WHERE value IS NOT NULL
"""


# --- DuckDB oracle: the envelope rules over the same text --------------------

def duck_unwrapped() -> str:
    """event_id, key, value, event_type, __op, data (JSON), reason, error_context."""
    jt = duck.json_text
    return f"""
(SELECT *,
   CASE WHEN NOT ok THEN '{PARSE_FAILED}'
        WHEN has_payload AND image IS NULL THEN 'missing ' || side || ' image'
        WHEN has_payload AND json_type(image) <> 'OBJECT' THEN 'JSON parsing failed: ' || side || ' image is not an object'
   END AS reason,
   CASE WHEN NOT ok THEN 'json_parsing'
        WHEN has_payload AND image IS NULL THEN NULL
        WHEN has_payload AND json_type(image) <> 'OBJECT' THEN 'json_parsing'
   END AS error_context
 FROM (SELECT *,
         CASE WHEN has_payload THEN image ELSE CAST(v AS JSON) END AS data,
         CASE WHEN has_payload THEN op ELSE {jt('v', '__op')} END AS __op,
         CASE WHEN op = 'd' THEN 'before' ELSE 'after' END AS side
       FROM (SELECT *,
               CASE WHEN op = 'd' THEN json_extract(payload, '$.before') ELSE json_extract(payload, '$.after') END AS image
             FROM (SELECT *,
                     coalesce(json_type(v, '$.payload') NOT IN ('NULL'), false) AS has_payload,
                     json_extract(v, '$.payload') AS payload,
                     coalesce({jt("json_extract(v, '$.payload')", 'op')}, 'c') AS op
                   FROM (SELECT *, json_valid(value) AS ok, CASE WHEN json_valid(value) THEN value END AS v
                         FROM (SELECT event_id, key, value, event_type FROM {fixtures.event_feed_sql()} f00) f0
                         WHERE value IS NOT NULL) f1) f2) f3) f4) u
"""


def _duck_routed() -> str:
    """Full lv1 refinement over the event feed: unwrap + ContactProfile mapping + lookup."""
    jt = duck.json_text
    return f"""
(SELECT u.*, {jt('data', 'id')} AS r_user_id,
        CASE WHEN u.reason IS NULL AND {jt('data', 'id')} IS NULL
             THEN 'Failed to apply mapping rule for field ''user_id'': required value is null' ELSE u.reason END AS freason,
        CASE WHEN u.reason IS NULL AND {jt('data', 'id')} IS NULL THEN 'field_mapping' ELSE u.error_context END AS fcontext,
        {jt('data', 'name')} AS user_name,
        {duck.email(jt('data', 'email'))} AS email,
        {duck.phone(jt('data', 'phone_number'))} AS phone,
        {duck.yn(jt('data', 'active_yn'))} AS is_active,
        s.ssn AS decrypted_ssn,
        {duck.json_ts('data', 'created_at')} AS created_at
 FROM {duck_unwrapped()}
 LEFT JOIN (SELECT id AS uid, ssn FROM {fixtures.user_feed_sql()}) s ON s.uid = {jt('data', 'id')}) r
"""


UNWRAP_ORACLE = f"""
SELECT event_id, __op, {duck.json_text('data', 'id')} AS image_id, {duck.json_text('data', 'name')} AS image_name,
       reason, error_context FROM {duck_unwrapped()}
"""
OP_DEFAULT_ORACLE = f"SELECT event_id, __op FROM {duck_unwrapped()}"
IMAGE_CHOICE_ORACLE = f"""
SELECT event_id, __op, CASE WHEN __op = 'd' THEN 'before' ELSE 'after' END AS image_side,
       {duck.json_text('data', 'id')} AS image_id FROM {duck_unwrapped()} WHERE reason IS NULL
"""
OP_COUNTS_ORACLE = f"SELECT __op, count(*) AS n FROM {duck_unwrapped()} WHERE reason IS NULL GROUP BY __op"
MISSING_IMAGE_ORACLE = f"""
SELECT key, reason, error_context, value AS payload FROM {duck_unwrapped()}
WHERE reason LIKE 'missing %' OR reason LIKE '% image is not an object'
"""
PARSE_REJECTS_ORACLE = f"SELECT key, reason, error_context, value AS payload FROM {duck_unwrapped()} WHERE reason = '{PARSE_FAILED}'"
DROP_TOMBSTONES_ORACLE = f"""
SELECT event_type, count(*) AS n_in, count(value) AS n_kept FROM {fixtures.event_feed_sql()} f GROUP BY event_type
"""
TOMBSTONE_ORACLE = f"""
SELECT event_id, key, __op, coalesce(lower(__op) = 'd', false) AS is_tombstone FROM {duck_unwrapped()} WHERE reason IS NULL
"""
LATEST_ORACLE = f"""
SELECT user_id, event_id, __op, email FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM (
    SELECT {duck.json_text('data', 'id')} AS user_id, event_id, __op,
           {duck.email(duck.json_text('data', 'email'))} AS email
    FROM {duck_unwrapped()} WHERE reason IS NULL) a) b
WHERE rn = 1 AND (__op IS NULL OR lower(__op) <> 'd')
"""
ROUTE_SUCCESS_ORACLE = f"""
SELECT r_user_id AS user_id, user_name, email, phone, is_active, decrypted_ssn, created_at, __op,
       CAST({PROCESSED_AT_MS} AS BIGINT) AS __processed_at
FROM {_duck_routed()} WHERE freason IS NULL
"""
ROUTE_REJECTS_ORACLE = f"""
SELECT key, freason AS reason, fcontext AS error_context, value AS payload FROM {_duck_routed()} WHERE freason IS NOT NULL
"""
REJECT_REASONS_ORACLE = f"""
SELECT freason AS reason, fcontext AS error_context, count(*) AS n FROM {_duck_routed()}
WHERE freason IS NOT NULL GROUP BY freason, fcontext
"""
REQUIRED_ORACLE = f"""
SELECT key, freason AS reason, value AS payload FROM {_duck_routed()} WHERE fcontext = 'field_mapping'
"""
UNDECODABLE_ORACLE = f"""
SELECT event_id, key, value, 2 AS n_headers, '{DLQ_TOPIC}' AS original_topic, 'exception.message' AS last_header
FROM (SELECT event_id, CAST(user_id AS VARCHAR) AS key, {PROPS_RAW} AS value FROM events) e
WHERE value IS NOT NULL AND NOT json_valid(value)
"""

QUERIES = {
    "cdc_json_unwrap": cdc_json_unwrap,
    "cdc_struct_unwrap": cdc_struct_unwrap,
    "flat_source_non_null": flat_source_non_null,
    "cdc_op_default": cdc_op_default,
    "cdc_image_choice": cdc_image_choice,
    "cdc_op_counts": cdc_op_counts,
    "cdc_missing_image_rejects": cdc_missing_image_rejects,
    "cdc_parse_rejects": cdc_parse_rejects,
    "cdc_drop_tombstones": cdc_drop_tombstones,
    "tombstone_on_delete": tombstone_on_delete_q,
    "cdc_latest_state": cdc_latest_state,
    "cdc_apply_batches": cdc_apply_batches,
    "cdc_struct_rejects": cdc_struct_rejects,
    "struct_timestamp_fields": struct_timestamp_fields,
    "chain_json_topics": chain_json_topics,
    "route_success": route_success,
    "route_rejects": route_rejects,
    "reject_reasons": reject_reasons,
    "required_field_rejects": required_field_rejects,
    "undecodable_rows": undecodable_rows,
}

ORACLE = {
    "cdc_json_unwrap": UNWRAP_ORACLE,
    "cdc_struct_unwrap": CDC_STRUCT_ORACLE,
    "flat_source_non_null": FLAT_ORACLE,
    "cdc_op_default": OP_DEFAULT_ORACLE,
    "cdc_image_choice": IMAGE_CHOICE_ORACLE,
    "cdc_op_counts": OP_COUNTS_ORACLE,
    "cdc_missing_image_rejects": MISSING_IMAGE_ORACLE,
    "cdc_parse_rejects": PARSE_REJECTS_ORACLE,
    "cdc_drop_tombstones": DROP_TOMBSTONES_ORACLE,
    "tombstone_on_delete": TOMBSTONE_ORACLE,
    "cdc_latest_state": LATEST_ORACLE,
    "cdc_apply_batches": LATEST_ORACLE,
    "cdc_struct_rejects": STRUCT_REJECTS_ORACLE,
    "struct_timestamp_fields": STRUCT_TIMES_ORACLE,
    "chain_json_topics": _chain_oracle(),
    "route_success": ROUTE_SUCCESS_ORACLE,
    "route_rejects": ROUTE_REJECTS_ORACLE,
    "reject_reasons": REJECT_REASONS_ORACLE,
    "required_field_rejects": REQUIRED_ORACLE,
    "undecodable_rows": UNDECODABLE_ORACLE,
}
