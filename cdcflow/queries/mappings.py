"""Queries over mapping rules, level-2 mappers, lookups, protection, address
matching and keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcflow.operators import address, envelope, keys, lookup, mapping as m, protect, pushed
from cdcflow.plans import build
from cdcflow.queries import duck, fixtures
from cdcflow.queries.common import PROCESSED_AT_MS, SAMPLE_KEY, context, definition, now_col
from cdcflow.queries.envelopes import duck_unwrapped

jt = duck.json_text


def _user_unwrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = fixtures.user_feed(spark, sf_dir, protect_key=SAMPLE_KEY).select("key", "value", "c_custkey")
    return envelope.unwrap_json(feed, now=now_col())


def _duck_user_images() -> str:
    return f"""(SELECT c_custkey, CASE WHEN op = 'd' THEN json_extract(value, '$.payload.before')
                                    ELSE json_extract(value, '$.payload.after') END AS img
               FROM {fixtures.user_feed_sql()} f) u"""


def _map(df: DataFrame, schema: str, rules: list, keep: tuple, params: dict | None = None, data_col="data") -> DataFrame:
    mp = m.Mapping("q", schema, rules)
    out = mp.apply(df, data_col=data_col, keep=keep, params=params)
    return out.select(*keep, *mp.schema.fieldNames())


# --- JSON rules ----------------------------------------------------------------

def map_json_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = envelope.unwrap_json(fixtures.event_feed(spark, sf_dir).select("key", "value", "event_id"))
    ok = u.where(F.col("_reject").isNull()).drop("_reject")
    return _map(
        ok,
        "id string, amount string, tags string, created string, missing string",
        [
            m.json_string("id", "id"), m.json_string("amount", "amount"), m.json_string("tags", "tags"),
            m.json_string("created", "created_at"), m.json_string("missing", "no_such_field"),
        ],
        ("event_id",),
    )


MAP_JSON_STRING_ORACLE = f"""
SELECT event_id, {jt('data', 'id')} AS id, {jt('data', 'amount')} AS amount, {jt('data', 'tags')} AS tags,
       {jt('data', 'created_at')} AS created, {jt('data', 'no_such_field')} AS missing
FROM {duck_unwrapped()} WHERE reason IS NULL
"""


def map_cleansed_contact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _map(
        _user_unwrapped(spark, sf_dir),
        "name string, phone string, email string, address string",
        [
            m.json_cleansed_name("name", "name"), m.json_cleansed_phone("phone", "phone_number"),
            m.json_cleansed_email("email", "email"), m.json_cleansed_address("address", "address"),
        ],
        ("c_custkey",),
    )


CONTACT_ORACLE = f"""
SELECT c_custkey, {duck.name(jt('img', 'name'))} AS name, {duck.phone(jt('img', 'phone_number'))} AS phone,
       {duck.email(jt('img', 'email'))} AS email, {duck.address(jt('img', 'address'))} AS address
FROM {_duck_user_images()}
"""


def map_json_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _map(_user_unwrapped(spark, sf_dir), "created_at bigint", [m.json_timestamp("created_at", "created_at")], ("c_custkey",))


TIMESTAMP_ORACLE = f"SELECT c_custkey, {duck.json_ts('img', 'created_at')} AS created_at FROM {_duck_user_images()}"


def map_json_boolean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _map(
        _user_unwrapped(spark, sf_dir), "is_active boolean, missing_flag boolean",
        [m.json_boolean("is_active", "active_yn"), m.json_boolean("missing_flag", "no_flag")], ("c_custkey",),
    )


BOOLEAN_ORACLE = f"""
SELECT c_custkey, {duck.yn(jt('img', 'active_yn'))} AS is_active, false AS missing_flag FROM {_duck_user_images()}
"""


def map_json_boolean_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _map(
        _user_unwrapped(spark, sf_dir),
        "active_t boolean, active_f boolean, missing_t boolean, id_f boolean",
        [
            m.json_boolean_default("active_t", "active_yn", True), m.json_boolean_default("active_f", "active_yn", False),
            m.json_boolean_default("missing_t", "no_flag", True), m.json_boolean_default("id_f", "id", False),
        ],
        ("c_custkey",),
    )


BOOLEAN_DEFAULT_ORACLE = f"""
SELECT c_custkey, {duck.as_bool(jt('img', 'active_yn'), 'true')} AS active_t, {duck.as_bool(jt('img', 'active_yn'), 'false')} AS active_f,
       true AS missing_t, {duck.as_bool(jt('img', 'id'), 'false')} AS id_f
FROM {_duck_user_images()}
"""


def map_json_instant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _map(_user_unwrapped(spark, sf_dir), "created_at bigint", [m.json_instant("created_at", "created_at")], ("c_custkey",))


INSTANT_ORACLE = f"SELECT c_custkey, {duck.instant(jt('img', 'created_at'))} AS created_at FROM {_duck_user_images()}"


# --- struct (decoded record) rules ------------------------------------------------

def map_struct_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = fixtures.read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return _map(
        o,
        "status string, key_text string, missing string, custkey bigint, flag boolean",
        [
            m.struct_string("status", "o_orderstatus"), m.struct_string("key_text", "o_orderkey"),
            m.struct_string("missing", "no_such_field"), m.struct_long("custkey", "o_custkey"),
            m.struct_boolean("flag", "no_flag"),
        ],
        ("o_orderkey",),
        data_col=None,
    )


STRUCT_FIELDS_ORACLE = """
SELECT o_orderkey, o_orderstatus AS status, CAST(o_orderkey AS VARCHAR) AS key_text, CAST(NULL AS VARCHAR) AS missing,
       o_custkey AS custkey, CAST(NULL AS BOOLEAN) AS flag FROM orders
"""


def map_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = fixtures.read(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("channel"))
    schema = "configured string, record string, none string, definition string"
    bare, given = m.Record(columns=frozenset()), m.Record(columns=frozenset(), params={"channel": "CH-DEF"})
    rules = [
        m.channel("configured", "CH-CONF"),
        m.channel("record"),
        m.custom("none", lambda r: m.channel("none").build(bare)),
        m.custom("definition", lambda r: m.channel("definition").build(given)),
    ]
    wide = _map(c, schema, rules, ("c_custkey",), data_col=None)  # one scan, then a row per rule
    pairs = F.array(*[F.struct(F.lit(r.output).alias("rule"), F.col(r.output).alias("ch")) for r in rules])
    return wide.select("c_custkey", F.inline(pairs))


CHANNEL_ORACLE = """
SELECT c_custkey, 'configured' AS rule, 'CH-CONF' AS ch FROM customer
UNION ALL SELECT c_custkey, 'record', c_mktsegment FROM customer
UNION ALL SELECT c_custkey, 'none', CAST(NULL AS VARCHAR) FROM customer
UNION ALL SELECT c_custkey, 'definition', 'CH-DEF' FROM customer
"""

_FIRST = "CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN '   ' ELSE c_name END"
_LAST = "CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN '' ELSE n_name END"


def map_full_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = fixtures.read(spark, sf_dir, "customer")
    n = fixtures.read(spark, sf_dir, "nation")
    src = c.join(n, c.c_nationkey == n.n_nationkey).selectExpr("c_custkey", f"{_FIRST} AS first_name", f"{_LAST} AS last_name")
    return _map(src, "full_name string", [m.full_name("full_name", "first_name", "last_name")], ("c_custkey",), data_col=None)


def _duck_full_name(a: str, b: str) -> str:
    joined = f"(coalesce({a}, '') || CASE WHEN {b} IS NOT NULL THEN ' ' || {b} ELSE '' END)"
    return f"(CASE WHEN {duck.jtrim(joined)} = '' THEN NULL ELSE {duck.jtrim(joined)} END)"


FULL_NAME_ORACLE = f"""
SELECT c_custkey, {_duck_full_name('first_name', 'last_name')} AS full_name FROM (
  SELECT c_custkey, {_FIRST} AS first_name, {_LAST} AS last_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey) q
"""


# --- level-2 mappers via the pipeline definitions ---------------------------------

_SILVER_ID = "CASE c_custkey % 9 WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE 'U' || lpad(CAST(c_custkey AS STRING), 7, '0') END"


def _silver_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A silver topic (key + record struct) derived from customer."""
    c = fixtures.read(spark, sf_dir, "customer").selectExpr(
        f"{_SILVER_ID} AS user_id", "c_name AS first_name", "c_mktsegment AS last_name",
        "'user' || CAST(c_custkey AS STRING) || '@example.com' AS email", "c_custkey",
    )
    return c.select(F.col("c_custkey").cast("string").alias("key"), F.struct("user_id", "first_name", "last_name", "email").alias("value"))


def map_cache_entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    defn = definition("lv2", "StampsCustomers")
    routed = build.route(build.refine(_silver_users(spark, sf_dir), defn, context(spark, sf_dir)), defn)
    return routed.success.select(
        "key", "entity_id",
        F.map_keys("data")[0].alias("cache_key"),
        F.map_values("data")[0].alias("cache_value"),
    )


CACHE_ORACLE = f"""
SELECT user_id AS key, user_id AS entity_id, 'sample.user:customers:' || user_id AS cache_key,
       CAST({PROCESSED_AT_MS} AS BIGINT) AS cache_value
FROM (SELECT {_SILVER_ID} AS user_id FROM customer) q
WHERE user_id IS NOT NULL AND {duck.jtrim('user_id')} <> ''
"""


def _silver_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = fixtures.read(spark, sf_dir, "supplier").selectExpr(
        "'S' || lpad(CAST(s_suppkey AS STRING), 7, '0') AS user_id", "s_name AS first_name",
        "CAST(NULL AS STRING) AS last_name", "'contact@' || lower(replace(s_name, '#', '')) || '.com' AS email",
        "CASE s_suppkey % 3 WHEN 0 THEN 'c' WHEN 1 THEN 'u' ELSE 'd' END AS __op", "s_suppkey",
    )
    return s.select(
        F.col("s_suppkey").cast("string").alias("key"),
        F.struct("user_id", "first_name", "last_name", "email", "__op").alias("value"),
    )


def union_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources x the union template -> one destination, tagged by channel."""
    ctx = context(spark, sf_dir)
    out = None
    for name, src in (("ContactsCustomers", _silver_users(spark, sf_dir)), ("ContactsSuppliers", _silver_suppliers(spark, sf_dir))):
        defn = definition("lv2", name)
        ok = build.route(build.refine(src, defn, ctx), defn).success
        out = ok if out is None else out.unionByName(ok, allowMissingColumns=True)
    return out.select(
        F.to_json("key").alias("key_json"), "user_id", "channel", "full_name", "contact_email", "contact_phone", "__op", "__processed_at"
    )


UNION_ORACLE = f"""
SELECT '{{"channel":"customers","user_id":"' || user_id || '"}}' AS key_json, user_id, 'customers' AS channel,
       {_duck_full_name('first_name', 'last_name')} AS full_name, email AS contact_email,
       CAST(NULL AS VARCHAR) AS contact_phone, CAST(NULL AS VARCHAR) AS __op, CAST({PROCESSED_AT_MS} AS BIGINT) AS __processed_at
FROM (SELECT {_SILVER_ID} AS user_id, c_name AS first_name, c_mktsegment AS last_name,
             'user' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email FROM customer) c
WHERE user_id IS NOT NULL
UNION ALL
SELECT '{{"channel":"suppliers","user_id":"' || user_id || '"}}', user_id, 'suppliers', {_duck_full_name('first_name', 'NULL')},
       email, NULL, op, CAST({PROCESSED_AT_MS} AS BIGINT)
FROM (SELECT 'S' || lpad(CAST(s_suppkey AS VARCHAR), 7, '0') AS user_id, s_name AS first_name,
             'contact@' || lower(replace(s_name, '#', '')) || '.com' AS email,
             CASE s_suppkey % 3 WHEN 0 THEN 'c' WHEN 1 THEN 'u' ELSE 'd' END AS op FROM supplier) s
"""


# --- keyed lookups --------------------------------------------------------------

def lookup_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = fixtures.read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = fixtures.read(spark, sf_dir, "customer")
    out = lookup.lookup(o, [F.col("o_custkey")], c, ["c_custkey"], "c_name", "c_name")
    # duplicate reference keys: first line of the order (smallest line number)
    # whose value may be NULL
    li = fixtures.read(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", f"{FIRST_FLAG} AS l_returnflag")
    out = lookup.lookup(out, [F.col("o_orderkey")], li, ["l_orderkey"], "l_returnflag", "first_flag", order_col="l_linenumber")
    return out.select("o_orderkey", "o_custkey", "c_name", "first_flag")


FIRST_FLAG = "CASE WHEN l_orderkey % 3 = 0 AND l_linenumber = 1 THEN NULL ELSE l_returnflag END"
LOOKUP_ORACLE = f"""
SELECT o_orderkey, o_custkey, c.c_name, f.first_flag FROM orders o
LEFT JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN (SELECT l_orderkey, l_returnflag AS first_flag FROM (
             SELECT l_orderkey, l_returnflag,
                    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_returnflag NULLS FIRST) AS rn
             FROM (SELECT l_orderkey, l_linenumber, {FIRST_FLAG} AS l_returnflag FROM lineitem) l) x WHERE rn = 1) f
  ON f.l_orderkey = o.o_orderkey
"""


def lookup_pushed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookups of ``lookup_enrich`` in three micro-batches, each reading what its keys need:
    listed keys for two of them, key ranges for the third."""
    orders = fixtures.read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = pushed.FileReference(lambda: fixtures.read(spark, sf_dir, "customer"))
    lines = pushed.FileReference(lambda: fixtures.read(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", f"{FIRST_FLAG} AS l_returnflag"))
    out = None
    for n, at_most in enumerate((pushed.AT_MOST, pushed.AT_MOST, 0)):
        batch = orders.where(F.col("o_orderkey") % 3 == n)
        batch = pushed.lookup_pushed(batch, [F.col("o_custkey")], customers, ["c_custkey"], "c_name", "c_name", at_most=at_most)
        batch = pushed.lookup_pushed(batch, [F.col("o_orderkey")], lines, ["l_orderkey"], "l_returnflag", "first_flag", order_col="l_linenumber", at_most=at_most)
        out = batch if out is None else out.unionByName(batch)
    return out.select("o_orderkey", "o_custkey", "c_name", "first_flag")


def lookup_enrich_compound(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = fixtures.read(spark, sf_dir, "lineitem")
    src = li.select("l_orderkey", "l_linenumber")
    out = lookup.lookup(
        src, [F.col("l_orderkey"), F.col("l_linenumber") + 1], li, ["l_orderkey", "l_linenumber"], "l_shipdate", "next_ship"
    )
    return out.select("l_orderkey", "l_linenumber", F.col("next_ship").cast("string").alias("next_ship"))


LOOKUP_COMPOUND_ORACLE = """
SELECT a.l_orderkey, a.l_linenumber, CAST(b.l_shipdate AS VARCHAR) AS next_ship FROM lineitem a
LEFT JOIN (SELECT l_orderkey, l_linenumber, min(l_shipdate) AS l_shipdate FROM lineitem
           WHERE l_shipdate IS NOT NULL GROUP BY l_orderkey, l_linenumber) b
  ON b.l_orderkey = a.l_orderkey AND b.l_linenumber = a.l_linenumber + 1
"""


# --- protect / reveal -------------------------------------------------------------

def protect_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = fixtures.read(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", F.when(F.col("c_custkey") % 4 == 0, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("seg")
    )
    k = SAMPLE_KEY
    enc = protect.protect(F.col("seg"), k)
    det1 = protect.protect(F.col("c_name"), k, deterministic=True)
    det2 = protect.protect(F.col("c_name"), k, deterministic=True)
    batch = protect.reveal_all(protect.protect_all(F.array("c_name", "seg"), k), k)
    return c.select(
        "c_custkey",
        protect.reveal(enc, k).alias("seg_back"),
        (det1 == det2).alias("deterministic_equal"),
        (enc.isNull()).alias("null_stays_null"),
        protect.reveal(F.col("c_name"), k).alias("reveal_plain"),
        F.array_join(batch, "|", "<null>").alias("batch_back"),
        F.size(batch).alias("batch_len"),
    )


PROTECT_ORACLE = """
SELECT c_custkey, seg AS seg_back, true AS deterministic_equal, seg IS NULL AS null_stays_null,
       CAST(NULL AS VARCHAR) AS reveal_plain, c_name || '|' || coalesce(seg, '<null>') AS batch_back, 2 AS batch_len
FROM (SELECT c_custkey, c_name, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END AS seg FROM customer) q
"""


# --- address matching ----------------------------------------------------------------

_KEYWORD = (
    "CASE c_custkey % 9 WHEN 0 THEN 'Unknown ' || c_name "
    "WHEN 1 THEN r_name || ' ' || n_name || ' ' || c_name || ' (' || c_mktsegment || ')' "
    "WHEN 2 THEN r_name || '  ' || n_name || chr(9) || c_name || ' -' "
    "WHEN 3 THEN r_name || ' ' || n_name "
    "WHEN 4 THEN r_name || ' nowhere' "
    "WHEN 5 THEN ' ' || r_name || ',' "
    "WHEN 6 THEN ' -' "
    "ELSE r_name || ' ' || n_name || ' ' || c_name END"
)
_REF_COLS = [
    ("search_text", "r_name || ' ' || n_name || ' ' || s_name"),
    ("road_address", "s_name || ' road ' || CAST(s_suppkey AS STRING)"),
    ("zipcode", "lpad(CAST(n_nationkey * 100 + s_suppkey % 2 AS STRING), 5, '0')"),
    ("city", "r_name"),
    ("district", "n_name"),
    ("town", "'TOWN-' || CAST(n_nationkey % 3 AS STRING) || CASE WHEN s_suppkey % 10 = 0 THEN ' ' ELSE '' END"),
]


def address_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = fixtures.read(spark, sf_dir, "supplier")
    n = fixtures.read(spark, sf_dir, "nation")
    r = fixtures.read(spark, sf_dir, "region")
    j = s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return j.selectExpr(*[f"{e} AS {c}" for c, e in _REF_COLS])


def _customer_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = fixtures.read(spark, sf_dir, "customer")
    n = fixtures.read(spark, sf_dir, "nation")
    r = fixtures.read(spark, sf_dir, "region")
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return j.selectExpr("c_custkey", f"{_KEYWORD} AS address", "CASE WHEN c_custkey % 17 = 0 THEN 'd' ELSE 'u' END AS __op")


def _matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return address.match_addresses(_customer_addresses(spark, sf_dir), ["address"], address_reference(spark, sf_dir), keep=("c_custkey",))


def address_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _matched(spark, sf_dir).select("c_custkey", "full_address", "juso_matched_keyword", "juso_result_count", "__op")


def address_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _matched(spark, sf_dir).select("c_custkey", "city", "district", "town", "road_address", "zipcode")


def address_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _matched(spark, sf_dir).groupBy("juso_quality").agg(F.count(F.lit(1)).alias("n"))


_SP = "[ ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ']"


def _duck_norm(x: str) -> str:
    """Whitespace runs -> ' ', Java trim, strip trailing separators (RE2 classes)."""
    ws_class = "'[ ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ']+'"
    trailing = "'[ ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ',()_/\\]\\[-]+$'"
    squeezed = f"regexp_replace({x}, {ws_class}, ' ', 'g')"
    return f"regexp_replace({duck.jtrim(squeezed)}, {trailing}, '', 'g')"


def _duck_address() -> str:
    cust = f"""(SELECT c_custkey, kw, __op, {_duck_norm('kw')} AS norm FROM (
        SELECT c_custkey, {duck.jtrim(_KEYWORD)} AS kw, CASE WHEN c_custkey % 17 = 0 THEN 'd' ELSE 'u' END AS __op
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) a
        WHERE kw <> '' AND __op <> 'd')"""
    ref = f"""(SELECT *, {_duck_norm('search_text')} AS rnorm FROM (
        SELECT {', '.join(f'{e} AS {c}' for c, e in _REF_COLS)}
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) b)"""
    levels = "(SELECT unnest(range(1, 64)) AS lvl)"
    # brute force: every keyword prefix against every reference prefix
    return f"""
WITH cust AS {cust}, ref AS {ref},
kp AS (SELECT c.*, l.lvl, array_to_string(list_slice(string_split(norm, ' '), 1, l.lvl), ' ') AS p
       FROM cust c, {levels} l WHERE norm <> '' AND l.lvl <= len(string_split(norm, ' '))),
rp AS (SELECT r.*, l.lvl AS rl, array_to_string(list_slice(string_split(rnorm, ' '), 1, l.lvl), ' ') AS p
       FROM ref r, {levels} l WHERE l.lvl <= len(string_split(rnorm, ' '))),
hits AS (SELECT kp.c_custkey, kp.lvl, kp.p, rp.* EXCLUDE (p, rl) FROM kp JOIN rp ON kp.p = rp.p),
best AS (SELECT c_custkey, max(lvl) AS lvl FROM hits GROUP BY c_custkey),
cand AS (SELECT h.* FROM hits h JOIN best b ON h.c_custkey = b.c_custkey AND h.lvl = b.lvl),
agg AS (SELECT c_custkey, any_value(p) AS used, count(*) AS n,
          CASE WHEN count(DISTINCT {duck.jtrim('city')}) = 1 THEN any_value({duck.jtrim('city')}) END AS c_city,
          CASE WHEN count(DISTINCT {duck.jtrim('district')}) = 1 THEN any_value({duck.jtrim('district')}) END AS c_district,
          CASE WHEN count(DISTINCT {duck.jtrim('town')}) = 1 THEN any_value({duck.jtrim('town')}) END AS c_town,
          CASE WHEN count(DISTINCT {duck.jtrim('zipcode')}) = 1 THEN any_value({duck.jtrim('zipcode')}) END AS c_zip,
          CASE WHEN count(DISTINCT {duck.jtrim('road_address')}) = 1 THEN any_value({duck.jtrim('road_address')}) END AS c_road,
          any_value(city) AS o_city, any_value(district) AS o_district, any_value(town) AS o_town,
          any_value(zipcode) AS o_zip, any_value(road_address) AS o_road
        FROM cand GROUP BY c_custkey),
res AS (SELECT c.c_custkey, c.kw AS full_address, coalesce(a.used, c.norm) AS juso_matched_keyword,
          CAST(coalesce(a.n, 0) AS INTEGER) AS juso_result_count, c.__op, a.*,
          (a.c_city IS NOT NULL AND a.c_district IS NOT NULL AND a.c_town IS NOT NULL) AS triplet
        FROM cust c LEFT JOIN agg a ON a.c_custkey = c.c_custkey)
"""


def _pick(single: str, cons: str, full: bool) -> str:
    cond = "triplet AND c_zip IS NOT NULL AND c_road IS NOT NULL" if full else "triplet"
    return f"CASE WHEN juso_result_count = 1 THEN {single} WHEN juso_result_count > 1 AND {cond} THEN {cons} END"


ADDRESS_MATCH_ORACLE = _duck_address() + """
SELECT c_custkey, full_address, juso_matched_keyword, juso_result_count, __op FROM res
"""
ADDRESS_CONSENSUS_ORACLE = _duck_address() + f"""
SELECT c_custkey, {_pick('o_city', 'c_city', False)} AS city, {_pick('o_district', 'c_district', False)} AS district,
       {_pick('o_town', 'c_town', False)} AS town, {_pick('o_road', 'c_road', True)} AS road_address,
       {_pick('o_zip', 'c_zip', True)} AS zipcode FROM res
"""
ADDRESS_QUALITY_ORACLE = _duck_address() + """
SELECT CASE WHEN juso_result_count = 0 THEN 'not_found' WHEN juso_result_count = 1 THEN 'ok'
            WHEN triplet THEN 'ok' ELSE 'ambiguous' END AS juso_quality, count(*) AS n
FROM res GROUP BY 1
"""


# --- keys ---------------------------------------------------------------------------

def key_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cdcflow.queries.lv1 import _refined_users

    return _refined_users(spark, sf_dir).success.select("user_id", F.to_json("key").alias("key_json"))


KEY_STRUCT_ORACLE = f"""
SELECT {jt('img', 'id')} AS user_id, '{{"user_id":"' || {jt('img', 'id')} || '"}}' AS key_json FROM {_duck_user_images()}
"""

_KEY_CHANNEL = "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END"


def key_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = fixtures.read(spark, sf_dir, "customer").selectExpr(
        "c_custkey", f"{_KEY_CHANNEL} AS channel", "'U' || lpad(CAST(c_custkey AS STRING), 7, '0') AS user_id"
    )
    return keys.string_key(c, ["channel", "user_id"]).select("c_custkey", "key")


KEY_JSON_ORACLE = f"""
SELECT c_custkey, CAST(json_object('channel', {_KEY_CHANNEL}, 'user_id', 'U' || lpad(CAST(c_custkey AS VARCHAR), 7, '0')) AS VARCHAR) AS key
FROM customer
"""

QUERIES = {
    "map_json_string": map_json_string,
    "map_cleansed_contact": map_cleansed_contact,
    "map_json_timestamp": map_json_timestamp,
    "map_json_boolean": map_json_boolean,
    "map_json_boolean_default": map_json_boolean_default,
    "map_json_instant": map_json_instant,
    "map_struct_fields": map_struct_fields,
    "map_channel": map_channel,
    "map_full_name": map_full_name,
    "map_cache_entry": map_cache_entry,
    "union_channels": union_channels,
    "lookup_enrich": lookup_enrich,
    "lookup_pushed": lookup_pushed,
    "lookup_enrich_compound": lookup_enrich_compound,
    "protect_roundtrip": protect_roundtrip,
    "address_match": address_match,
    "address_consensus": address_consensus,
    "address_quality": address_quality,
    "key_struct": key_struct,
    "key_json": key_json,
}

ORACLE = {
    "map_json_string": MAP_JSON_STRING_ORACLE,
    "map_cleansed_contact": CONTACT_ORACLE,
    "map_json_timestamp": TIMESTAMP_ORACLE,
    "map_json_boolean": BOOLEAN_ORACLE,
    "map_json_boolean_default": BOOLEAN_DEFAULT_ORACLE,
    "map_json_instant": INSTANT_ORACLE,
    "map_struct_fields": STRUCT_FIELDS_ORACLE,
    "map_channel": CHANNEL_ORACLE,
    "map_full_name": FULL_NAME_ORACLE,
    "map_cache_entry": CACHE_ORACLE,
    "union_channels": UNION_ORACLE,
    "lookup_enrich": LOOKUP_ORACLE,
    "lookup_pushed": LOOKUP_ORACLE,
    "lookup_enrich_compound": LOOKUP_COMPOUND_ORACLE,
    "protect_roundtrip": PROTECT_ORACLE,
    "address_match": ADDRESS_MATCH_ORACLE,
    "address_consensus": ADDRESS_CONSENSUS_ORACLE,
    "address_quality": ADDRESS_QUALITY_ORACLE,
    "key_struct": KEY_STRUCT_ORACLE,
    "key_json": KEY_JSON_ORACLE,
}
