"""Queries over typed enforcement and decode diagnosis (orders, events)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcflow.operators import mapping as m
from cdcflow.operators.rejects import REJECT_COL
from cdcflow.plans import build
from cdcflow.queries import fixtures
from cdcflow.queries.common import now_col
from cdcflow.sources.topics import TopicBinding, decoded

# What arrives for each declared field; the same text for both engines.
TYPED_COLS = {
    "order_no": "CASE WHEN o_orderkey % 11 = 0 THEN 'x' || CAST(o_orderkey AS STRING) ELSE CAST(o_orderkey AS STRING) END",
    "small": "CASE WHEN o_orderkey % 13 = 0 THEN o_orderkey + 1099511627776 ELSE o_orderkey END",
    "is_open": "CASE WHEN o_orderkey % 7 = 0 THEN 'maybe' WHEN o_orderstatus = 'O' THEN 'true' WHEN o_orderstatus = 'F' THEN 'false' END",
    "cents": "CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_totalprice AS DECIMAL(14,2)) ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS DECIMAL(14,2)) END",
    "status": "CASE WHEN o_orderkey % 17 = 0 THEN o_orderstatus || '-long' ELSE o_orderstatus END",
}
TYPED_SCHEMA = "order_no bigint NOT NULL, small int, is_open boolean, cents bigint, status varchar(3)"


def typed_field_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that do not fit their declared type: the row is a reject that names field and value."""
    orders = fixtures.read(spark, sf_dir, "orders").selectExpr("o_orderkey AS key", *[f"{e} AS {n}" for n, e in TYPED_COLS.items()])
    mp = m.Mapping("TypedOrder", TYPED_SCHEMA, [m.struct_value(n, n) for n in TYPED_COLS])
    out = mp.apply(orders, data_col=None, payload=F.col("order_no"), now=now_col())
    ok = F.col(REJECT_COL).isNull()
    return out.select("key", *[F.when(ok, F.col(n)).alias(n) for n in TYPED_COLS],
                      F.col(f"{REJECT_COL}.reason").alias("reason"), F.col(f"{REJECT_COL}.payload").alias("payload"))


# field -> (misfit, value as text, declared type, DuckDB type)
_TYPED_DUCK = {
    "order_no": ("NOT regexp_full_match(order_no, '[0-9]+')", "order_no", "bigint", "BIGINT"),
    "small": ("small > 2147483647", "CAST(small AS VARCHAR)", "int", "INTEGER"),
    "is_open": ("is_open NOT IN ('true', 'false')", "is_open", "boolean", "BOOLEAN"),
    "cents": ("cents <> floor(cents)", "CAST(cents AS VARCHAR)", "bigint", "BIGINT"),
    "status": ("length(status) > 3", "status", "varchar(3)", "VARCHAR"),
}


def _typed_oracle() -> str:
    cols = ", ".join(f"{e} AS {n}" for n, e in TYPED_COLS.items())
    cases = []
    for n, (bad, text, kind, _) in _TYPED_DUCK.items():
        cases.append(f"WHEN {bad} THEN 'Failed to apply mapping rule for field ''{n}'': value ''' || {text} || ''' does not fit {kind}'")
    values = ", ".join(f"CASE WHEN reason IS NULL THEN TRY_CAST({n} AS {t}) END AS {n}" for n, (_, _, _, t) in _TYPED_DUCK.items())
    return (f"SELECT key, {values}, reason, CASE WHEN reason IS NOT NULL THEN order_no END AS payload "
            f"FROM (SELECT *, CASE {' '.join(cases)} END AS reason FROM (SELECT o_orderkey AS key, {cols} FROM orders) a) b")


# --- decode diagnosis over events ------------------------------------------------

DAMAGED = (
    "CASE WHEN event_id % 53 = 0 THEN substr(props, 1, length(props) - 1) WHEN event_id % 59 = 0 THEN NULL "
    "WHEN event_id % 61 = 0 THEN '{\"k\": \"text\"}' WHEN event_id % 67 = 0 THEN 'plain text' WHEN event_id % 71 = 0 THEN '{\"k\": 5000000000}' "
    "WHEN event_id % 73 = 0 THEN '[1, 2]' WHEN event_id % 79 = 0 THEN '{\"k\": 1, \"on\": \"maybe\"}' WHEN event_id % 83 = 0 THEN '{\"k\": 1, \"name\": \"cut' "
    "WHEN event_id % 89 = 0 THEN '' WHEN event_id % 97 = 0 THEN '{\"k\": null, \"on\": true, \"name\": 5}' ELSE props END"
)
DAMAGED_SCHEMA = "k int, on boolean, name string"


def undecodable_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters by why they did not decode, as their last header says."""
    ev = fixtures.read(spark, sf_dir, "events").selectExpr("CAST(user_id AS STRING) AS key", f"{DAMAGED} AS value")
    _, dead = build.undecodable(decoded(ev, TopicBinding(value_schema=DAMAGED_SCHEMA)), {"sourceTopic": "bronze.events"})
    why = F.decode(F.element_at("headers", -1)["value"], "UTF-8")
    return dead.groupBy(why.alias("reason")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("value")).alias("chars"))


def _reasons_oracle() -> str:
    whole = "json_valid(value)"
    k, on = "json_extract(value, '$.k')", "json_extract(value, '$.on')"
    bad_k = f"json_type({k}) NOT IN ('BIGINT', 'UBIGINT', 'NULL') OR TRY_CAST({k} AS INTEGER) IS NULL AND json_type({k}) <> 'NULL'"
    return f"""
SELECT reason, count(*) AS n, CAST(sum(length(value)) AS BIGINT) AS chars FROM (
  SELECT value, 'could not decode the record value: ' || CASE
    WHEN trim(value) = '' THEN 'the value is empty'
    WHEN NOT {whole} AND value[1] = '{{' THEN 'the JSON text is cut short after ' || length(value) || ' characters'
    WHEN NOT {whole} THEN 'the text is not JSON'
    WHEN json_type(value) <> 'OBJECT' THEN 'the value is no object but ' || json_type(value)
    WHEN {bad_k} THEN 'field ''k'' is no int: ' || json_extract_string(value, '$.k')
    WHEN json_type({on}) NOT IN ('BOOLEAN', 'NULL') THEN 'field ''on'' is no boolean: ' || json_extract_string(value, '$.on') END AS reason
  FROM (SELECT {DAMAGED} AS value FROM events) e WHERE value IS NOT NULL) r
WHERE reason IS NOT NULL GROUP BY reason
"""


QUERIES = {"typed_field_rejects": typed_field_rejects, "undecodable_reasons": undecodable_reasons}
ORACLE = {"typed_field_rejects": _typed_oracle(), "undecodable_reasons": _reasons_oracle()}
