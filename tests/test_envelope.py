"""Envelope unwrap end to end (the reference's in-memory topology cases)."""

import json

from pyspark.sql import functions as F

from cdcflow.operators import envelope, rejects
from cdcflow.plans import build, spec
from cdcflow.plans.context import Context

NOW_MS = 1_704_067_200_000


def _ctx(spark):
    users = spark.createDataFrame([("USER_001", "900101-1234567")], "ID string, SSN string")
    return Context(spark=spark, protect_key="0" * 32, tables={"USERS": users}, now=F.timestamp_millis(F.lit(NOW_MS)))


def _feed(spark, rows):
    return spark.createDataFrame(rows, "key string, value string")


def _lv1():
    return spec.load()["lv1"][0]


def test_create_record(spark):
    after = {"id": "USER_001", "name": "Test User", "email": "test@gmail.com", "phone_number": "01012345678",
             "active_yn": "Y", "created_at": 1704067200000}
    value = json.dumps({"schema": {}, "payload": {"op": "c", "before": None, "after": after}})
    routed = build.route(build.refine(_feed(spark, [("USER_001", value)]), _lv1(), _ctx(spark)), _lv1())
    row = routed.success.collect()[0]
    assert row["key"]["user_id"] == "USER_001"
    assert row["email"] == "test@gmail.com"
    assert row["phone"] == "010-1234-5678"
    assert row["is_active"] is True
    assert row["__op"] == "c"
    assert row["created_at"] == 1704067200000
    assert row["decrypted_ssn"] == "900101-1234567"
    assert row["__processed_at"] == 1_704_067_200_000 + 9 * 3_600_000
    assert routed.rejects.count() == 0


def test_delete_uses_before_image(spark):
    before = {"id": "USER_002", "name": "Deleted User"}
    value = json.dumps({"schema": {}, "payload": {"op": "d", "before": before, "after": None}})
    routed = build.route(build.refine(_feed(spark, [("USER_002", value)]), _lv1(), _ctx(spark)), _lv1())
    row = routed.success.collect()[0]
    assert (row["key"]["user_id"], row["__op"], row["user_id"], row["user_name"]) == ("USER_002", "d", "USER_002", "Deleted User")


def test_rejects_and_tombstones(spark):
    rows = [
        ("k1", None),                                              # tombstone: dropped
        ("k2", '{"payload":{"op":"c","after":{"id":'),             # broken JSON
        ("k3", '{"payload":{"op":"d","after":{"id":"x"}}}'),       # delete without before
        ("k4", '{"payload":{"op":"u","after":null}}'),             # image JSON null
        ("k5", '{"id":"flat","__op":"r"}'),                        # no envelope: whole doc, own __op
        ("k6", '{"payload":{"after":{"id":"noop"}}}'),             # op absent -> c
        ("k7", '{"payload":{"op":"c","after":{"name":"no id"}}}'),  # required user_id missing
    ]
    refined = build.refine(_feed(spark, rows), _lv1(), _ctx(spark))
    routed = build.route(refined, _lv1())
    ok = {r["key"]["user_id"]: r["__op"] for r in routed.success.collect()}
    assert ok == {"flat": "r", "noop": "c"}
    bad = {r["key"]: (r["reason"], r["error_context"]) for r in routed.rejects.collect()}
    assert bad["k2"] == (envelope.PARSE_FAILED, "json_parsing")
    assert bad["k3"] == ("missing before image", None)
    assert bad["k4"][1] == "json_parsing"
    assert bad["k7"][1] == rejects.CTX_MAPPING and "user_id" in bad["k7"][0]
    assert set(bad) == {"k2", "k3", "k4", "k7"}


def test_struct_envelope(spark):
    df = spark.createDataFrame(
        [("1", ("d", ("a", 1), None)), ("2", (None, None, ("b", 2))), ("3", ("d", None, ("c", 3))), ("4", None)],
        "key string, value struct<op:string, before:struct<id:string,n:int>, after:struct<id:string,n:int>>",
    )
    out = envelope.unwrap_struct(df)
    got = {r["key"]: (r["__op"], r["_reject"] is None) for r in out.collect()}
    assert got == {"1": ("d", True), "2": ("c", True), "3": ("d", False)}


def test_tombstone_on_delete(spark):
    df = spark.createDataFrame([("a", "v", "D"), ("b", "v", "u"), ("c", "v", None)], "key string, value string, __op string")
    got = {r["key"]: r["value"] for r in envelope.tombstone_on_delete(df).collect()}
    assert got == {"a": None, "b": "v", "c": "v"}


def test_dead_letters(spark):
    df = spark.createDataFrame([("k", '{"a":1}'), ("k", '{"a":'), ("k", None)], "key string, value string")
    dlq = rejects.dead_letters(df.withColumn("d", F.try_parse_json("value")), "value", "d", "bronze.x").collect()
    assert len(dlq) == 1
    assert [h["key"] for h in dlq[0]["headers"]] == ["original.topic", "exception.message"]
    assert bytes(dlq[0]["headers"][0]["value"]).decode() == "bronze.x"


def test_format_switch_struct_source(spark):
    """inputFormat AVRO (any case) selects the struct envelope reader."""
    df = spark.createDataFrame(
        [("U1", ("c", None, ("U1", "Kim", "a@b.co", "01012345678", "Y", 1704067200000)))],
        "key string, value struct<op:string, before:struct<id:string,name:string,email:string,phone_number:string,"
        "active_yn:string,created_at:bigint>, after:struct<id:string,name:string,email:string,phone_number:string,"
        "active_yn:string,created_at:bigint>>",
    )
    defn = dict(_lv1(), inputFormat="avro")
    row = build.route(build.refine(df, defn, _ctx(spark)), defn).success.collect()[0]
    assert (row["user_id"], row["phone"], row["is_active"], row["created_at"], row["__op"]) == (
        "U1", "010-1234-5678", True, 1704067200000, "c")
