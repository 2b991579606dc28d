"""Queries over the level-1 refinement (change envelopes -> silver users)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cdcflow.plans import build
from cdcflow.queries import duck, fixtures
from cdcflow.queries.common import PROCESSED_AT_MS, SAMPLE_KEY, context, definition

USER_OUT = [
    "user_id", "user_name", "email", "phone", "address", "is_active",
    "decrypted_phone", "decrypted_ssn", "created_at", "__op", "__processed_at",
]


def _refined_users(spark: SparkSession, sf_dir: str) -> build.Routed:
    defn = definition("lv1", "RefineCustomers")
    feed = fixtures.user_feed(spark, sf_dir, protect_key=SAMPLE_KEY).select("key", "value")
    return build.route(build.refine(feed, defn, context(spark, sf_dir)), defn)


def refine_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: user change envelopes -> unwrap -> map/cleanse/lookup/reveal ->
    stamp -> route -> keyed silver records (ciphertext column left out)."""
    return _refined_users(spark, sf_dir).success.select(*USER_OUT)


def _user_oracle() -> str:
    img = "img"
    return f"""
SELECT {duck.json_text(img, 'id')} AS user_id,
       {duck.json_text(img, 'name')} AS user_name,
       {duck.email(duck.json_text(img, 'email'))} AS email,
       {duck.phone(duck.json_text(img, 'phone_number'))} AS phone,
       {duck.address(duck.json_text(img, 'address'))} AS address,
       {duck.yn(duck.json_text(img, 'active_yn'))} AS is_active,
       {duck.json_text(img, 'phone_number')} AS decrypted_phone,
       u.ssn AS decrypted_ssn,
       {duck.json_ts(img, 'created_at')} AS created_at,
       f.op AS __op,
       CAST({PROCESSED_AT_MS} AS BIGINT) AS __processed_at
FROM (SELECT *, CASE WHEN op = 'd' THEN json_extract(value, '$.payload.before')
                     ELSE json_extract(value, '$.payload.after') END AS img
      FROM {fixtures.user_feed_sql()}) f
LEFT JOIN (SELECT id AS uid, ssn FROM {fixtures.user_feed_sql()}) u ON u.uid = {duck.json_text(img, 'id')}
"""


QUERIES = {"refine_users": refine_users}
ORACLE = {"refine_users": _user_oracle()}
