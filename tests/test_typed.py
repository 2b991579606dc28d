"""Values that do not fit their declared type: rejects that name field and value, never a dead job."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcflow.operators import mapping as m
from cdcflow.operators import typed
from cdcflow.operators.rejects import rejects, successes

CASES = [
    # source type, declared type, value, fits
    ("string", "bigint", "12", True), ("string", "bigint", " 12 ", True), ("string", "bigint", "x1", False), ("string", "bigint", "", False),
    ("string", "bigint", "9223372036854775808", False), ("string", "boolean", "true", True), ("string", "boolean", "maybe", False),
    ("string", "double", "1e3", True), ("string", "date", "2020-02-30", False), ("string", "date", "2020-02-29", True),
    ("bigint", "int", 2**31 - 1, True), ("bigint", "int", 2**40, False), ("bigint", "int", -(2**31) - 1, False), ("bigint", "tinyint", 200, False),
    ("int", "bigint", 7, True), ("int", "double", 7, True), ("double", "int", 2.0, True), ("double", "int", 2.5, False), ("double", "bigint", float("nan"), False),
    ("double", "bigint", float("inf"), False), ("decimal(10,2)", "int", "3.00", True), ("decimal(10,2)", "int", "3.70", False),
    ("decimal(10,2)", "decimal(3,2)", "123.45", False), ("int", "boolean", 1, True), ("int", "boolean", 2, False),
    ("string", "varchar(4)", "abcd", True), ("string", "varchar(4)", "abcde", False), ("int", "varchar(2)", 123, False), ("int", "string", 123, True),
    ("array<string>", "array<int>", ["1", "2"], True), ("array<string>", "array<int>", ["1", "x"], False), ("array<string>", "array<int>", [None], True),
    ("map<string,string>", "map<string,bigint>", {"a": "1"}, True), ("map<string,string>", "map<string,bigint>", {"a": "z"}, False),
    ("struct<a:string>", "struct<a:int>", ("5",), True), ("struct<a:string>", "struct<a:int>", ("five",), False),
]


@pytest.mark.parametrize("group", range(4))
def test_fit_of_every_pair_of_types(spark, group):
    for have, want, value, fits in CASES[group::4]:
        given = T.StructType.fromDDL(f"x {'string' if have.startswith('decimal') else have}")
        df = spark.createDataFrame([(value,), (None,)], given).select(F.col("x").cast(have).alias("x"))
        kind = T.StructType.fromDDL(f"x {want}")[0].dataType
        bad = typed.misfit(F.col("x"), df.schema[0].dataType, kind)
        got = df.select(F.lit(False) if bad is None else bad).collect()
        assert [r[0] for r in got] == [not fits, False], (have, want, value)
        out = df.select(typed.converted(F.col("x"), df.schema[0].dataType, kind)).collect()
        assert out[1][0] is None and (not fits or out[0][0] is not None), (have, want, value)


def test_impossible_conversions_fail_at_plan_time(spark):
    from pyspark.errors import AnalysisException

    df = spark.createDataFrame([(True,)], "x boolean")
    with pytest.raises(AnalysisException):
        m.Mapping("m", "x timestamp", [m.struct_value("x", "x")]).apply(df, data_col=None)


def test_struct_and_json_rules_reject_what_does_not_fit(spark):
    schema = "id string NOT NULL, n bigint, small int, flag boolean, name varchar(5)"
    df = spark.createDataFrame(
        [("1", "7", 5, "true", "abc"), ("2", "x1", 5, "true", "abc"), ("3", "7", 2**40, "true", "abc"), ("4", "7", 5, "maybe", "abc"),
         ("5", "7", 5, "true", "abcdef"), ("6", None, None, None, None), (None, "x1", 5, "true", "abc"), ("8", "7%s$", 2**41, "no", "abc")],
        "id string, n string, small bigint, flag string, name string")
    rules = [m.struct_value(c, c) for c in ("id", "n", "small", "flag", "name")]
    out = m.Mapping("m", schema, rules).apply(df, data_col=None, keep=())
    assert sorted(r.id for r in successes(out).collect()) == ["1", "6"]
    why = sorted((r.reason, r.error_context) for r in rejects(out, None).collect())
    f = "Failed to apply mapping rule for field '{}': value '{}' does not fit {}"
    assert why == sorted((w, "field_mapping") for w in [
        f.format("n", "x1", "bigint"), f.format("n", "x1", "bigint"), f.format("small", 2**40, "int"), f.format("flag", "maybe", "boolean"),
        f.format("name", "abcdef", "varchar(5)"), f.format("n", "7%s$", "bigint")])
    assert [str(x) for x in out.drop("_reject").schema.fields[4].dataType.simpleString().split()] == ["string"]
    js = spark.createDataFrame([('{"id":"1","n":"x1"}',), ('{"id":"2","n":"41"}',), ('{"id":"3","n":{"a":1}}',)], "j string").select(F.parse_json("j").alias("data"))
    got = m.Mapping("m", "id string, n bigint", [m.json_string("id", "id"), m.json_string("n", "n")]).apply(js, keep=())
    assert [(r.id, r.n) for r in successes(got).collect()] == [("2", 41)]
    assert {r.reason for r in rejects(got, None).collect()} == {f.format("n", v, "bigint") for v in ("x1", "")}


def test_declared_defaults_fill_absent_fields_only(spark):
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.IntegerType(), False, {"default": 9}), T.StructField("on", T.DateType(), True, {"default": "2020-01-01"})])
    df = spark.createDataFrame([("a", None), ("b", "3"), ("c", "bad")], "id string, n string")
    out = m.Mapping("m", schema, [m.struct_string("id", "id"), m.struct_value("n", "n")]).apply(df, data_col=None, keep=())
    assert [(r.id, r.n, r.on) for r in successes(out).collect()] == [("a", 9, dt.date(2020, 1, 1)), ("b", 3, dt.date(2020, 1, 1))]
    assert [r.reason[-22:] for r in rejects(out, None).collect()] == ["'bad' does not fit int"]


def test_a_stream_survives_a_bad_value(spark, scratch):
    from cdcflow.plans import registry
    from cdcflow.plans.context import Context
    from cdcflow.sources import TopicBinding, read_topic
    from cdcflow.streaming.runner import start_pipeline

    registry.register_schema("TypedProbe", T.StructType.fromDDL("id string NOT NULL, n bigint"), "lv2")

    @registry.mapping("lv2", "typed_probe")
    def probe(defn, ctx):
        mp = m.Mapping("TypedProbe", registry.get_schema("TypedProbe", "lv2"), [m.struct_string("id", "id"), m.struct_long("n", "n")])
        return lambda df: mp.apply(df, data_col=None, params=defn, keep=("key",), now=ctx.now)

    path = lambda n: os.path.join(scratch, n)
    spark.createDataFrame([("a", ("a", "1")), ("b", ("b", "x1")), ("c", ("c", "3"))], "key string, value struct<id:string,n:string>").coalesce(1).write.parquet(path("in"))
    b = {n: TopicBinding(path=path(n)) for n in ("in", "out", "fail")}
    defn = {"name": "probe", "group": "lv2", "sourceTopic": "in", "destinationTopic": "out", "failTopic": "fail", "mapperName": "typed_probe", "schemaName": "TypedProbe", "primaryKeyFields": ["id"]}
    start_pipeline(spark, defn, Context(spark=spark), b, path("ck"), {"availableNow": True}).awaitTermination()
    assert sorted((r.id, r.n) for r in read_topic(spark, "out", b).select("value.*").collect()) == [("a", 1), ("c", 3)]
    assert [r.reason for r in read_topic(spark, "fail", b).select("value.*").collect()] == ["Failed to apply mapping rule for field 'n': value 'x1' does not fit bigint"]
