"""Queries exercising the scalar functions on the driver's tables.

Each query derives its inputs with an SQL expression shared verbatim by Spark
(``selectExpr``) and the DuckDB oracle, then applies the function: the Spark
Column function on one side, the independent DuckDB fragment on the other.
Edge cases the tables lack (Hangul names, odd e-mails) are literals picked by
the row's key (``CASE key % n``); every row of every input table is used.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcflow.functions import idfn, text, timefn
from cdcflow.queries import duck
from cdcflow.queries.common import AS_OF, AS_OF_SQL, NOW_MS, PROCESSED_AT_MS, now_col
from cdcflow.queries.fixtures import SPARK_TS_US, DUCK_TS_US, read

# Characters of Java's \s, spelled without backslashes so the text means the
# same in Spark SQL and DuckDB string literals.
_WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
EMAIL_CANDIDATE = f"'[^' || {_WS} || '@]+@[^' || {_WS} || '@]+'"


class ScalarQuery:
    """inputs (shared SQL over one table) -> function -> one output column."""

    def __init__(
        self,
        table: str,
        cols: dict[str, str],
        out: str,
        spark_fn: Callable[..., Column],
        duck_fn: Callable[..., str],
        args: tuple[str, ...] = ("input",),
        ts_cols: bool = False,
    ):
        self.table, self.cols, self.out = table, cols, out
        self.spark_fn, self.duck_fn, self.args = spark_fn, duck_fn, args
        self.ts_cols = ts_cols

    def _exprs(self, ts: str) -> list[str]:
        return [f"{e.replace('{ts_us}', ts)} AS {n}" for n, e in self.cols.items()]

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        src = read(spark, sf_dir, self.table).selectExpr(*self._exprs(SPARK_TS_US.format(c="ts")))
        return src.select(*self.cols.keys(), self.spark_fn(*[F.col(a) for a in self.args]).alias(self.out))

    def oracle(self) -> str:
        inner = f"SELECT {', '.join(self._exprs(DUCK_TS_US.format(c='ts')))} FROM {self.table}"
        return f"SELECT {', '.join(self.cols.keys())}, {self.duck_fn(*self.args)} AS {self.out} FROM ({inner}) q"


def _union_query(parts: list[ScalarQuery], spark_fn, duck_fn, out: str, args=("input",)):
    """Several ScalarQuery inputs (same column names) unioned, then one function."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        dfs = [read(spark, sf_dir, p.table).selectExpr(*p._exprs("")) for p in parts]
        src = dfs[0]
        for d in dfs[1:]:
            src = src.unionByName(d)
        return src.select(*parts[0].cols.keys(), spark_fn(*[F.col(a) for a in args]).alias(out))

    inner = " UNION ALL ".join(f"SELECT {', '.join(p._exprs(''))} FROM {p.table}" for p in parts)
    oracle = f"SELECT {', '.join(parts[0].cols.keys())}, {duck_fn(*args)} AS {out} FROM ({inner}) q"
    return run, oracle


# --- e-mail: every address-like run in every document, plus crafted variants.
_EMAIL_VARIANTS = (
    "CASE c_custkey % 16 "
    "WHEN 0 THEN 'a@b.co' WHEN 1 THEN 'ab@b.co' WHEN 2 THEN 'a.@b.co' WHEN 3 THEN '.ab@b.co' "
    "WHEN 4 THEN 'a b@x.io' WHEN 5 THEN 'ab@-x.io' WHEN 6 THEN 'ab@x-.io' WHEN 7 THEN 'ab@x..io' "
    "WHEN 8 THEN 'AB%CD+' || CAST(c_custkey AS STRING) || '@X.IO' WHEN 9 THEN 'ab@x.c0' "
    "WHEN 10 THEN 'ab@sub.x-y.com' WHEN 11 THEN 'user' || repeat('a', 40) || '@' || repeat('b', 60) "
    "WHEN 12 THEN ' ab@x.io' WHEN 13 THEN 'ab @x.io' WHEN 14 THEN '홍길동@x.io' ELSE 'x.y.z@a.b.c.de' END"
)


def clean_email_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(
        F.lit("doc").alias("src"),
        F.col("doc_id").alias("id"),
        F.explode(F.expr(f"regexp_extract_all(text, {EMAIL_CANDIDATE}, 0)")).alias("input"),
    )
    cust = read(spark, sf_dir, "customer").selectExpr("'cust' AS src", "c_custkey AS id", f"{_EMAIL_VARIANTS} AS input")
    src = docs.unionByName(cust)
    return src.select("src", "id", "input", text.clean_email(F.col("input")).alias("email"))


CLEAN_EMAIL_ORACLE = f"""
SELECT src, id, input, {duck.email('input')} AS email FROM (
  SELECT 'doc' AS src, doc_id AS id, unnest(regexp_extract_all(text, {EMAIL_CANDIDATE}, 0)) AS input FROM documents
  UNION ALL
  SELECT 'cust' AS src, c_custkey AS id, {_EMAIL_VARIANTS} AS input FROM customer) q
"""

_D8 = "lpad(CAST((c_custkey * 7919) % 100000000 AS STRING), 8, '0')"
PHONE = ScalarQuery(
    "customer",
    {
        "id": "c_custkey",
        "input": (
            "CASE c_custkey % 12 "
            f"WHEN 0 THEN '010' || {_D8} WHEN 1 THEN '02' || substr({_D8}, 1, 7) "
            f"WHEN 2 THEN '02-' || substr({_D8}, 1, 4) || '-' || substr({_D8}, 5, 4) "
            f"WHEN 3 THEN '(031) ' || substr({_D8}, 1, 3) || '.' || substr({_D8}, 4, 4) "
            f"WHEN 4 THEN '050' || substr({_D8}, 1, 7) WHEN 5 THEN '070-' || {_D8} "
            f"WHEN 6 THEN '011' || substr({_D8}, 1, 7) WHEN 7 THEN '123' "
            f"WHEN 8 THEN '+82 10-' || substr({_D8}, 1, 4) || '-' || substr({_D8}, 5, 4) "
            f"WHEN 9 THEN 'tel: 064) ' || substr({_D8}, 1, 4) || ' ' || substr({_D8}, 5, 4) "
            f"WHEN 10 THEN '0212345678' ELSE '' END"
        ),
    },
    "phone",
    text.clean_phone,
    duck.phone,
)

_NAME_VARIANTS = (
    "CASE c_custkey % 20 WHEN 0 THEN c_name WHEN 1 THEN lower(c_name) WHEN 2 THEN '홍 길 동' "
    "WHEN 3 THEN '홍길동 김철수' WHEN 4 THEN '홍길동/김철수' WHEN 5 THEN '홍길동(VIP)' "
    "WHEN 6 THEN '  james bond  ' WHEN 7 THEN '!!!' WHEN 8 THEN '1 2' WHEN 9 THEN '김,철수' "
    "WHEN 10 THEN 'Kim (Manager)' WHEN 11 THEN '이 몽 룡 (A)' WHEN 12 THEN ' ' WHEN 13 THEN 'abc123' "
    "WHEN 14 THEN '홍길동,kim' WHEN 15 THEN 'x/y' WHEN 16 THEN '(홍길동)' WHEN 17 THEN 'Lee, Jane' "
    "WHEN 18 THEN '최' || chr(9) || '영 희' ELSE c_mktsegment END"
)
NAME_INPUTS = [
    ScalarQuery("customer", {"src": "'cust'", "id": "c_custkey", "input": _NAME_VARIANTS}, "name", None, None),
    ScalarQuery("part", {"src": "'part'", "id": "p_partkey", "input": "p_name"}, "name", None, None),
]

ADDRESS = ScalarQuery(
    "customer",
    {
        "id": "c_custkey",
        "input": (
            "CASE c_custkey % 8 WHEN 0 THEN c_name || chr(9) || c_mktsegment "
            "WHEN 1 THEN chr(160) || ' ' || c_name || ' ' || chr(160) WHEN 2 THEN ' x ' "
            "WHEN 3 THEN chr(9) || 'ab' || chr(10) WHEN 4 THEN 'a' || chr(160) "
            "WHEN 5 THEN '서울' || chr(9) || '강남구' WHEN 6 THEN '' ELSE c_mktsegment END"
        ),
    },
    "address",
    text.clean_address,
    duck.address,
)

TEXT_OR_NULL = ScalarQuery(
    "customer",
    {
        "id": "c_custkey",
        "input": (
            "CASE c_custkey % 7 WHEN 0 THEN ' null ' WHEN 1 THEN 'NULL' WHEN 2 THEN '' WHEN 3 THEN '  ' || c_name || '  ' "
            "WHEN 4 THEN NULL WHEN 5 THEN 'nullable' ELSE c_mktsegment END"
        ),
    },
    "value",
    text.text_or_null,
    duck.text_or_null,
)

NULL_TO_EMPTY = ScalarQuery(
    "customer",
    {"id": "c_custkey", "input": "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END"},
    "value",
    text.null_to_empty,
    lambda x: f"coalesce({x}, '')",
)

_FLAG = (
    "CASE c_custkey % 12 WHEN 0 THEN 'Y' WHEN 1 THEN 'y' WHEN 2 THEN ' true ' WHEN 3 THEN 'TRUE' WHEN 4 THEN '1' "
    "WHEN 5 THEN 'N' WHEN 6 THEN NULL WHEN 7 THEN '' WHEN 8 THEN '0' WHEN 9 THEN 'false' WHEN 10 THEN 'yes' ELSE ' n ' END"
)
YN = ScalarQuery("customer", {"id": "c_custkey", "input": _FLAG}, "flag", idfn.yn_to_boolean, duck.yn)
AS_BOOL = ScalarQuery(
    "customer",
    {"id": "c_custkey", "input": _FLAG, "dflt": "c_custkey % 2 = 0"},
    "flag",
    idfn.as_boolean,
    duck.as_bool,
    args=("input", "dflt"),
)

_ISO = (
    "CASE o_orderkey % 13 WHEN 0 THEN replace(CAST(o_orderdate AS STRING), ' ', 'T') || 'Z' "
    "WHEN 1 THEN replace(CAST(o_orderdate AS STRING), ' ', 'T') || '+09:00' "
    "WHEN 2 THEN replace(CAST(o_orderdate AS STRING), ' ', 't') || '.5z' "
    "WHEN 3 THEN replace(CAST(o_orderdate AS STRING), ' ', 'T') || '.123456-05:30' "
    "WHEN 4 THEN substr(CAST(o_orderdate AS STRING), 1, 10) "
    "WHEN 5 THEN substr(replace(CAST(o_orderdate AS STRING), ' ', 'T'), 1, 16) || 'Z' "
    "WHEN 6 THEN CAST(o_orderdate AS STRING) || 'Z' "
    "WHEN 7 THEN substr(CAST(o_orderdate AS STRING), 1, 8) || '30T10:00:00Z' "
    "WHEN 8 THEN 'garbage' WHEN 9 THEN replace(CAST(o_orderdate AS STRING), ' ', 'T') || 'Z' || chr(10) "
    "WHEN 10 THEN substr(CAST(o_orderdate AS STRING), 1, 10) || 'T24:00:00Z' "
    "WHEN 11 THEN substr(CAST(o_orderdate AS STRING), 1, 10) || 'T24:00:00.000+09:00' ELSE NULL END"
)
INSTANT = ScalarQuery("orders", {"id": "o_orderkey", "input": _ISO}, "millis", timefn.parse_instant, duck.instant)

_EPOCH_TEXT = (
    "CASE event_id % 10 WHEN 0 THEN CAST(CAST(floor({ts_us} / 1000000) AS BIGINT) AS STRING) "
    "WHEN 1 THEN CAST(CAST(floor({ts_us} / 1000) AS BIGINT) AS STRING) "
    "WHEN 2 THEN CAST({ts_us} AS STRING) "
    "WHEN 3 THEN '2024-01-' || lpad(CAST(1 + event_id % 28 AS STRING), 2, '0') || 'T00:00:00Z' "
    "WHEN 4 THEN '99999999999999999999' WHEN 5 THEN '' WHEN 6 THEN ' 123' "
    "WHEN 7 THEN CAST(event_id % 1000 AS STRING) WHEN 9 THEN CAST(event_id AS STRING) || chr(10) ELSE props END"
)
EPOCH_OR_ISO = ScalarQuery(
    "events", {"id": "event_id", "input": _EPOCH_TEXT}, "millis", timefn.parse_timestamp_text, duck.ts_text
)

_EPOCH_NUM = (
    "CASE event_id % 8 WHEN 0 THEN CAST(floor({ts_us} / 1000000) AS BIGINT) "
    "WHEN 1 THEN CAST(floor({ts_us} / 1000) AS BIGINT) WHEN 2 THEN {ts_us} "
    "WHEN 3 THEN 0 WHEN 4 THEN -1 * event_id WHEN 5 THEN 50000000000 + event_id "
    "WHEN 6 THEN 10000000000000000 + event_id ELSE {ts_us} * 1000 END"
)
NORMALIZE = ScalarQuery(
    "events", {"id": "event_id", "input": _EPOCH_NUM}, "millis", timefn.normalize_epoch_millis, duck.normalize
)

_ODATE = "replace(substr(CAST(o_orderdate AS STRING), 1, 10), '-', '')"
_BIRTH = (
    f"CASE o_orderkey % 12 WHEN 0 THEN {_ODATE} WHEN 1 THEN substr(CAST(o_orderdate AS STRING), 1, 10) "
    f"WHEN 2 THEN substr({_ODATE}, 3, 6) WHEN 3 THEN substr({_ODATE}, 1, 6) || '30' "
    f"WHEN 4 THEN substr({_ODATE}, 1, 4) || '1301' WHEN 5 THEN substr({_ODATE}, 1, 4) || '/' || substr({_ODATE}, 5, 2) || '/' || substr({_ODATE}, 7, 2) || ' extra 99' "
    f"WHEN 6 THEN '20991231' WHEN 7 THEN '18991231' WHEN 8 THEN '900229' "
    f"WHEN 9 THEN substr({_ODATE}, 3, 2) || '0231' WHEN 10 THEN 'invalid' ELSE '250101' END"
)
REFINE_BIRTH = ScalarQuery(
    "orders",
    {"id": "o_orderkey", "input": _BIRTH},
    "birth",
    lambda c: timefn.refine_birth(c, AS_OF).cast("string"),  # ISO text: engine-neutral for the value hash
    lambda x: f"CAST({duck.refine_birth(x, AS_OF_SQL)} AS VARCHAR)",
)
REFINE_BIRTH_DAYS = ScalarQuery(
    "orders",
    {"id": "o_orderkey", "input": _BIRTH},
    "birth_days",
    lambda c: timefn.refine_birth_epoch_days(c, AS_OF),
    lambda x: f"CAST({duck.refine_birth(x, AS_OF_SQL)} - DATE '1970-01-01' AS INTEGER)",
)

_CONT = (
    "CASE o_orderkey % 9 WHEN 0 THEN replace(substr(CAST(o_orderdate AS STRING), 1, 10), '-', '/') "
    "WHEN 1 THEN substr(CAST(o_orderdate AS STRING), 1, 10) "
    "WHEN 2 THEN substr(CAST(o_orderdate AS STRING), 1, 4) || '/02/30' "
    "WHEN 3 THEN substr(CAST(o_orderdate AS STRING), 1, 4) || '/13/01' "
    "WHEN 4 THEN substr(CAST(o_orderdate AS STRING), 1, 4) || '/1/5' WHEN 5 THEN '   ' "
    "WHEN 6 THEN substr(CAST(o_orderdate AS STRING), 1, 4) || '/04/31' "
    "WHEN 8 THEN substr(CAST(o_orderdate AS STRING), 1, 4) || '/04/01' || chr(10) ELSE NULL END"
)
CONTDATE = ScalarQuery("orders", {"id": "o_orderkey", "input": _CONT}, "millis", timefn.contdate_to_millis, duck.contdate)

_RESNO = (
    "CASE c_custkey % 10 "
    "WHEN 0 THEN lpad(CAST(c_custkey % 100 AS STRING), 2, '0') || lpad(CAST(1 + c_custkey % 12 AS STRING), 2, '0') || lpad(CAST(1 + c_custkey % 28 AS STRING), 2, '0') || '-' || CAST(c_custkey % 10 AS STRING) || '234567' "
    "WHEN 1 THEN lpad(CAST(c_custkey % 100 AS STRING), 2, '0') || '0229' || CAST(CAST(floor(c_custkey / 10) AS BIGINT) % 10 AS STRING) || '234567' "
    "WHEN 2 THEN '900230' || '-' || CAST(1 + c_custkey % 4 AS STRING) || '000000' "
    "WHEN 3 THEN '12345' WHEN 4 THEN '991231-' WHEN 5 THEN '0101019123456' "
    "WHEN 6 THEN '05' || lpad(CAST(1 + c_custkey % 12 AS STRING), 2, '0') || '15' || CAST(CAST(floor(c_custkey / 10) AS BIGINT) % 10 AS STRING) "
    "WHEN 7 THEN 'ab0101-3' WHEN 8 THEN '8001010' ELSE '851313-2345678' END"
)
GENDER = ScalarQuery("customer", {"id": "c_custkey", "input": _RESNO}, "gender", idfn.gender_from_resno, duck.gender)
BIRTH_RESNO = ScalarQuery("customer", {"id": "c_custkey", "input": _RESNO}, "birth_days", idfn.birth_from_resno, duck.birth_resno)

# --- change-sequence codec: base64 of big-endian integers built from keys.
# Numbers of 40 and 200 bytes are constants: their decimal text is beyond the oracle's integers.
_SEQ_LONG = {18: (1 << 320) - 12345, 24: (1 << 1600) - 10**300 + 7}
_SEQ_HEX = (
    "CASE " + " ".join(f"WHEN o_orderkey % {k} = 0 THEN '{v:X}'" for k, v in _SEQ_LONG.items()) + " "
    "ELSE CASE o_orderkey % 6 WHEN 0 THEN lpad(hex(o_orderkey), 16, '0') "
    "WHEN 1 THEN lpad(hex(o_orderkey * 1000003), 2 * CAST(ceil(length(hex(o_orderkey * 1000003)) / 2.0) AS INTEGER), '0') "
    "WHEN 2 THEN lpad(hex(o_orderkey), 16, '0') || lpad(hex(o_custkey), 16, '0') "
    "WHEN 3 THEN 'FF' || lpad(hex(o_orderkey), 30, '0') ELSE '' END END"
)


def decode_sequence_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").selectExpr("o_orderkey AS id", f"{_SEQ_HEX} AS hx", "o_orderkey % 6 AS kind")
    b64 = (
        F.when(F.col("kind") == 4, F.lit("!!not base64!!"))
        .when(F.col("kind") == 5, F.lit(None).cast("string"))
        .otherwise(F.translate(F.base64(F.unhex(F.col("hx"))), "\r\n", ""))  # Spark wraps long texts
    )
    return o.select("id", text.null_to_empty(b64).alias("input"), idfn.decode_sequence_b64(b64).alias("decimal_text"))


def _duck_seq_expected() -> str:
    # Unsigned value of the hex text computed with 128-bit integers (<= 16 bytes).
    return (
        "CASE " + " ".join(f"WHEN o_orderkey % {k} = 0 THEN '{v}'" for k, v in _SEQ_LONG.items()) + " "
        "WHEN kind = 4 OR kind = 5 THEN '' "
        "WHEN kind = 2 THEN CAST((CAST(o_orderkey AS UHUGEINT) << 64) + CAST(o_custkey AS UHUGEINT) AS STRING) "
        "WHEN kind = 3 THEN CAST((CAST(255 AS UHUGEINT) << 120) + CAST(o_orderkey AS UHUGEINT) AS STRING) "
        "WHEN kind = 1 THEN CAST(o_orderkey * 1000003 AS STRING) ELSE CAST(o_orderkey AS STRING) END"
    )


DECODE_SEQUENCE_ORACLE = f"""
SELECT o_orderkey AS id,
       CASE o_orderkey % 6 WHEN 4 THEN '!!not base64!!' WHEN 5 THEN '' ELSE to_base64(unhex({_SEQ_HEX})) END AS input,
       {_duck_seq_expected()} AS decimal_text
FROM (SELECT *, o_orderkey % 6 AS kind FROM orders) q
"""


def stamp_processed_at_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").select("o_orderkey")
    return o.select("o_orderkey", timefn.processed_at(now_col()).alias("__processed_at"), timefn.now_millis(now_col()).alias("now_millis"))


STAMP_ORACLE = f"SELECT o_orderkey, CAST({PROCESSED_AT_MS} AS BIGINT) AS __processed_at, CAST({NOW_MS} AS BIGINT) AS now_millis FROM orders"


def key_from_template_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_orderstatus", "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS prio"
    )
    fields = {c: F.col(c) for c in o.columns}
    return o.select("o_orderkey", text.format_template("order:{o_orderkey}/{o_orderstatus}/{prio}/{missing}", fields).alias("key"))


KEY_TEMPLATE_ORACLE = """
SELECT o_orderkey, 'order:' || CAST(o_orderkey AS VARCHAR) || '/' || coalesce(o_orderstatus, '') || '/' ||
       coalesce(CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END, '') || '/{missing}' AS key
FROM orders
"""

_name_run, _name_oracle = _union_query(NAME_INPUTS, text.clean_name, duck.name, "name")
_name1_run, _name1_oracle = _union_query(NAME_INPUTS, text.clean_name_compact, duck.name_compact, "name")

QUERIES = {
    "clean_email": clean_email_q,
    "clean_phone": PHONE.run,
    "clean_name": _name_run,
    "clean_name_compact": _name1_run,
    "clean_address": ADDRESS.run,
    "text_or_null": TEXT_OR_NULL.run,
    "null_to_empty": NULL_TO_EMPTY.run,
    "yn_to_boolean": YN.run,
    "as_boolean_default": AS_BOOL.run,
    "parse_iso_instant": INSTANT.run,
    "parse_epoch_or_iso": EPOCH_OR_ISO.run,
    "normalize_epoch": NORMALIZE.run,
    "refine_birth": REFINE_BIRTH.run,
    "refine_birth_days": REFINE_BIRTH_DAYS.run,
    "contract_date_millis": CONTDATE.run,
    "gender_from_resident_no": GENDER.run,
    "birth_from_resident_no": BIRTH_RESNO.run,
    "decode_sequence": decode_sequence_q,
    "stamp_processed_at": stamp_processed_at_q,
    "key_from_template": key_from_template_q,
}

ORACLE = {
    "clean_email": CLEAN_EMAIL_ORACLE,
    "clean_phone": PHONE.oracle(),
    "clean_name": _name_oracle,
    "clean_name_compact": _name1_oracle,
    "clean_address": ADDRESS.oracle(),
    "text_or_null": TEXT_OR_NULL.oracle(),
    "null_to_empty": NULL_TO_EMPTY.oracle(),
    "yn_to_boolean": YN.oracle(),
    "as_boolean_default": AS_BOOL.oracle(),
    "parse_iso_instant": INSTANT.oracle(),
    "parse_epoch_or_iso": EPOCH_OR_ISO.oracle(),
    "normalize_epoch": NORMALIZE.oracle(),
    "refine_birth": REFINE_BIRTH.oracle(),
    "refine_birth_days": REFINE_BIRTH_DAYS.oracle(),
    "contract_date_millis": CONTDATE.oracle(),
    "gender_from_resident_no": GENDER.oracle(),
    "birth_from_resident_no": BIRTH_RESNO.oracle(),
    "decode_sequence": DECODE_SEQUENCE_ORACLE,
    "stamp_processed_at": STAMP_ORACLE,
    "key_from_template": KEY_TEMPLATE_ORACLE,
}
