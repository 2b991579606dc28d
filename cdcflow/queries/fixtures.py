"""Change feeds derived from the driver's tables.

Every derived column is an SQL expression that means the same in Spark SQL
and DuckDB, so the Spark query (``selectExpr``) and its oracle (plain SQL) see
byte-identical inputs; only the refinement logic differs between the two.
Derivations use the row's own key arithmetic (``% n`` picks a variant); no
row is ever filtered out.  One expression differs by engine: epoch micros of
a zone-less timestamp (``{ts_us}``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPARK_TS_US = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', {c})"
DUCK_TS_US = "epoch_us({c})"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores: a table in one small file has one task, however dear its rows are to derive."""
    return df.hint("rebalance")


def _j(name: str, expr: str) -> str:
    """One JSON member with a string value (our derived strings need no escaping)."""
    return f"'\"{name}\":\"' || {expr} || '\"'"


# ---------------------------------------------------------------------------
# User feed: customer x nation x region, one change per customer.
USER_BASE_SQL = (
    "customer c JOIN nation n ON c.c_nationkey = n.n_nationkey "
    "JOIN region r ON n.n_regionkey = r.r_regionkey"
)

USER_COLS: list[tuple[str, str]] = [
    ("c_custkey", "c.c_custkey"),
    ("op", "CASE c.c_custkey % 4 WHEN 0 THEN 'c' WHEN 1 THEN 'u' WHEN 2 THEN 'r' ELSE 'd' END"),
    ("id", "'U' || lpad(CAST(c.c_custkey AS STRING), 7, '0')"),
    ("name", "c.c_name"),
    (
        "email",
        "CASE c.c_custkey % 6 "
        "WHEN 0 THEN 'user' || CAST(c.c_custkey AS STRING) || '@example.com' "
        "WHEN 1 THEN 'User.' || CAST(c.c_custkey AS STRING) || '..Mail@Example.COM' "
        "WHEN 2 THEN 'user+' || CAST(c.c_custkey AS STRING) || '@mail.co.kr' "
        "WHEN 3 THEN 'broken-' || CAST(c.c_custkey AS STRING) "
        "WHEN 4 THEN ' u ' || CAST(c.c_custkey AS STRING) || '@x.io' "
        "ELSE lower(n.n_name) || '.' || CAST(c.c_custkey AS STRING) || '@nation-' || CAST(n.n_nationkey AS STRING) || '.net' END",
    ),
    ("d8", "lpad(CAST((c.c_custkey * 7919) % 100000000 AS STRING), 8, '0')"),
    ("active_yn", "CASE c.c_custkey % 4 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' WHEN 2 THEN ' true ' ELSE '1' END"),
    ("secs", "1600000000 + c.c_custkey * 3600"),
    (
        "iso",
        "CAST(2020 + c.c_custkey % 5 AS STRING) || '-' || lpad(CAST(1 + c.c_custkey % 12 AS STRING), 2, '0') || '-' "
        "|| lpad(CAST(1 + c.c_custkey % 28 AS STRING), 2, '0') || 'T' || lpad(CAST(c.c_custkey % 24 AS STRING), 2, '0') "
        "|| ':' || lpad(CAST(c.c_custkey % 60 AS STRING), 2, '0') || ':' || lpad(CAST((c.c_custkey * 7) % 60 AS STRING), 2, '0') "
        "|| CASE c.c_custkey % 3 WHEN 0 THEN 'Z' WHEN 1 THEN '+09:00' ELSE '.250z' END",
    ),
    (
        "address",
        "CASE c.c_custkey % 7 WHEN 0 THEN 'Unknown ' || c.c_name "
        "WHEN 1 THEN r.r_name || ' ' || n.n_name || ' ' || c.c_name || ' (' || c.c_mktsegment || ')' "
        "WHEN 2 THEN r.r_name || '  ' || n.n_name || chr(9) || c.c_name || ' -' "
        "ELSE r.r_name || ' ' || n.n_name || ' ' || c.c_name END",
    ),
    ("r_name", "r.r_name"),
    ("n_name", "n.n_name"),
]

# Second projection over the first (refers to the derived names above).
USER_COLS2: list[tuple[str, str]] = [
    (
        "phone_number",
        "CASE c_custkey % 5 WHEN 0 THEN '010' || d8 "
        "WHEN 1 THEN '010-' || substr(d8, 1, 4) || '-' || substr(d8, 5, 4) "
        "WHEN 2 THEN '02' || substr(d8, 1, 7) "
        "WHEN 3 THEN '(031) ' || substr(d8, 1, 3) || '.' || substr(d8, 4, 4) "
        "ELSE '011' || substr(d8, 1, 7) END",
    ),
    # created_at: a JSON number, a digit string, an ISO string or junk.
    (
        "created_num",
        "CASE c_custkey % 5 WHEN 0 THEN secs WHEN 1 THEN secs * 1000 "
        "WHEN 4 THEN (CASE WHEN c_custkey % 10 = 4 THEN secs END) END",
    ),
    (
        "created_tok",
        "CASE c_custkey % 5 WHEN 0 THEN CAST(secs AS STRING) WHEN 1 THEN CAST(secs * 1000 AS STRING) "
        "WHEN 2 THEN '\"' || CAST(secs * 1000000 AS STRING) || '\"' WHEN 3 THEN '\"' || iso || '\"' "
        "ELSE (CASE WHEN c_custkey % 10 = 4 THEN CAST(secs AS STRING) || '.75' ELSE '\"not-a-date\"' END) END",
    ),
    ("ssn", "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE lpad(CAST((c_custkey * 37) % 1000000 AS STRING), 6, '0') || '-' || CAST(1 + c_custkey % 4 AS STRING) || lpad(CAST(c_custkey % 1000000 AS STRING), 6, '0') END"),
]

USER_IMAGE = (
    "'{' || " + " || ',' || ".join(
        [_j("id", "id"), _j("name", "name"), _j("email", "email"), _j("phone_number", "phone_number"),
         _j("address", "replace(address, chr(9), chr(92) || 't')"), _j("active_yn", "active_yn")]
    ) + " || ',\"created_at\":' || created_tok || '}'"
)

USER_ENVELOPE = (
    "'{\"schema\":{},\"payload\":{\"op\":\"' || op || '\",\"before\":' || "
    "(CASE WHEN op = 'd' THEN image ELSE 'null' END) || ',\"after\":' || "
    "(CASE WHEN op = 'd' THEN 'null' ELSE image END) || '}}'"
)


def user_feed_sql() -> str:
    """DuckDB/ANSI text of the user feed (columns of both projections + image + value)."""
    c1 = ", ".join(f"{e} AS {n}" for n, e in USER_COLS)
    c2 = ", ".join(f"{e} AS {n}" for n, e in USER_COLS2)
    return (
        f"(SELECT *, {USER_ENVELOPE} AS value FROM (SELECT *, {USER_IMAGE} AS image FROM "
        f"(SELECT *, {c2} FROM (SELECT {c1} FROM {USER_BASE_SQL}) u1) u2) u3)"
    )


def user_feed(spark: SparkSession, sf_dir: str, protect_key: str | None = None) -> DataFrame:
    """Spark side of the user feed: key, value (envelope text) and the derived columns.

    With ``protect_key`` the image also carries ``phone_number_enc`` (the phone
    number protected with that key) for the reveal rule.
    """
    c = spread(read(spark, sf_dir, "customer")).alias("c")
    n = read(spark, sf_dir, "nation").alias("n")
    r = read(spark, sf_dir, "region").alias("r")
    base = c.join(n, F.col("c.c_nationkey") == F.col("n.n_nationkey")).join(
        r, F.col("n.n_regionkey") == F.col("r.r_regionkey")
    )
    u = base.selectExpr(*[f"{e} AS {n_}" for n_, e in USER_COLS])
    u = u.selectExpr("*", *[f"{e} AS {n_}" for n_, e in USER_COLS2])
    u = u.selectExpr("*", f"{USER_IMAGE} AS image")
    if protect_key:
        from cdcflow.operators.protect import protect

        u = u.withColumn(
            "image",
            F.concat(
                F.expr("substr(image, 1, length(image) - 1)"),
                F.lit(',"phone_number_enc":"'),
                protect(F.col("phone_number"), protect_key),
                F.lit('"}'),
            ),
        )
    u = u.selectExpr("*", f"{USER_ENVELOPE} AS value")
    return u.withColumn("key", F.col("id"))


def users_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed lookup source ``USERS(ID, SSN)``: one row per customer (SSN may be NULL)."""
    return user_feed(spark, sf_dir).select(F.col("id").alias("ID"), F.col("ssn").alias("SSN"))


# ---------------------------------------------------------------------------
# Event feed: one change per event, keyed by user, with damaged rows.
EVENT_COLS: list[tuple[str, str]] = [
    ("event_id", "event_id"),
    ("user_id", "user_id"),
    ("ts_us", "{ts_us}"),
    ("event_type", "event_type"),
    ("op", "CASE event_type WHEN 'signup' THEN 'c' WHEN 'purchase' THEN 'u' WHEN 'click' THEN 'u' WHEN 'view' THEN 'r' ELSE 'd' END"),
    (
        "image",
        "'{' || '\"id\":\"U' || lpad(CAST(user_id AS STRING), 7, '0') || '\",\"name\":\"User ' || CAST(user_id AS STRING) "
        "|| '\",\"email\":\"' || CASE event_id % 3 WHEN 0 THEN 'ev' || CAST(event_id AS STRING) || '@events.io' "
        "WHEN 1 THEN 'EV..' || CAST(user_id AS STRING) || '@Events.IO' ELSE 'no-mail' END "
        "|| '\",\"phone_number\":\"010' || lpad(CAST((event_id * 7919) % 100000000 AS STRING), 8, '0') "
        "|| '\",\"active_yn\":\"' || CASE event_id % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' ELSE 'true' END "
        "|| '\",\"amount\":' || CAST(CAST(round(value * 100) AS BIGINT) AS STRING) "
        "|| ',\"tags\":[\"' || event_type || '\"],\"created_at\":' || CAST(CAST(floor({ts_us} / 1000) AS BIGINT) AS STRING) || '}'",
    ),
]

EVENT_VALUE = (
    "CASE WHEN event_id % 89 = 0 THEN NULL "
    "WHEN event_id % 97 = 0 THEN '{\"schema\":{},\"payload\":{\"op\":\"' || op || '\",\"after\":{\"id\":' "
    "WHEN event_id % 83 = 0 THEN '{\"schema\":{},\"payload\":{\"op\":\"' || op || '\"}}' "
    "WHEN event_id % 79 = 0 THEN image "
    "WHEN event_id % 71 = 0 THEN '{\"schema\":{},\"payload\":null,\"note\":\"flat\"}' "
    "WHEN event_id % 67 = 0 THEN '{\"schema\":{},\"payload\":{\"op\":\"' || op || '\",\"before\":null,\"after\":null}}' "
    "WHEN event_id % 61 = 0 THEN '{\"payload\":{\"before\":null,\"after\":' || image || '}}' "
    "ELSE '{\"schema\":{},\"payload\":{\"op\":\"' || op || '\",\"before\":' || "
    "(CASE WHEN op = 'd' THEN image ELSE 'null' END) || ',\"after\":' || "
    "(CASE WHEN op = 'd' THEN 'null' ELSE image END) || '}}' END"
)


def event_feed_sql() -> str:
    c1 = ", ".join(f"{e.replace("{ts_us}", DUCK_TS_US.format(c="ts"))} AS {n}" for n, e in EVENT_COLS)
    return f"(SELECT *, {EVENT_VALUE} AS value, CAST(user_id AS STRING) AS key FROM (SELECT {c1} FROM events) e1)"


def event_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """key (user id text), value (envelope text or NULL), event_id, op, ts_us, ..."""
    ev = read(spark, sf_dir, "events")
    e = ev.selectExpr(*[f"{x.replace("{ts_us}", SPARK_TS_US.format(c="ts"))} AS {n}" for n, x in EVENT_COLS])
    return e.selectExpr("*", f"{EVENT_VALUE} AS value", "CAST(user_id AS STRING) AS key")
