"""Reasons in dead letters: the decoder's own refusals, explained."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcflow.operators import diagnose
from cdcflow.plans import build
from cdcflow.sources.topics import TopicBinding, decoded

SCHEMA = "k int, on boolean, t timestamp, inner struct<x:int>, many array<int>, `a.b` double, name string"
CASES = {
    '{"k": 1': "the JSON text is cut short after 7 characters",
    '{"k": 1, "name": "a}': "the JSON text is cut short after 20 characters",
    '{"name": "\\"': "the JSON text is cut short after 12 characters",
    '[{"k": 1}': "the JSON text is cut short after 9 characters",
    "plain": "the text is not JSON",
    '{"k" 1}': "the text is not JSON",
    '{"k": 1,}}': "the text is not JSON",
    "": "the value is empty",
    " \t": "the value is empty",
    "[1]": "the value is no object but ARRAY",
    "5": "the value is no object but BIGINT",
    '"s"': "the value is no object but STRING",
    '{"k": "x"}': "field 'k' is no int: x",
    '{"k": 5000000000}': "field 'k' is no int: 5000000000",
    '{"k": {"a": 1}}': "field 'k' is no int: {\"a\":1}",
    '{"k": 1, "on": "maybe", "t": "nope"}': "field 'on' is no boolean: maybe",
    '{"t": "nope"}': "field 't' is no timestamp: nope",
    '{"inner": {"x": "y"}}': "field 'inner' is no struct<x:int>: {\"x\":\"y\"}",
    '{"many": [1, "q"]}': "field 'many' is no array<int>: [1,\"q\"]",
    '{"a.b": "z"}': "field 'a.b' is no double: z",
    '{"k": "' + "9" * 300 + '"}': "field 'k' is no int: " + "9" * diagnose.SHOWN,
}


def test_reasons(spark):
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(CASES)] + [("ok", '{"k": 1}'), ("null", None)], "key string, value string")
    good, dead = build.undecodable(decoded(df, TopicBinding(value_schema=SCHEMA)), {"sourceTopic": "t"})
    got = {r.value: bytes(r.headers[-1]["value"]).decode() for r in dead.collect()}
    assert {v: w.removeprefix(diagnose.NO_DECODE + ": ") for v, w in got.items()} == CASES
    assert sorted(r.key for r in good.collect()) == ["null", "ok"]


def test_a_long_text_of_strings_needs_no_deep_recursion(spark):
    text = '{"name": "' + "a\\\\" * 200_000 + '", "k": "' + "b" * 500_000
    df = spark.createDataFrame([(text,)], "v string").select(diagnose.json_failure(F.col("v"), T.StructType.fromDDL("k int, name string")))
    assert "cut short" in df.collect()[0][0]


@pytest.mark.parametrize("schema", ["k int", "name string, k int"])
def test_rejects_without_a_dead_letter_topic_say_why(spark, schema):
    from cdcflow.plans.context import Context

    df = spark.createDataFrame([("1", '{"k": "x"}')], "key string, value string")
    _, dead = build.undecodable(decoded(df, TopicBinding(value_schema=schema)), {"sourceTopic": "t"})
    r = build.dead_letter_rejects(dead, {}, Context(spark=spark)).collect()[0]
    assert (r.reason, r.payload, r.error_context) == (diagnose.NO_DECODE + ": field 'k' is no int: x", '{"k": "x"}', "json_parsing")
