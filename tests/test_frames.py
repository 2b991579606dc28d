"""Schema-registry frames: heads, routing by schema id, dead letters."""

import importlib.util

import pytest
from pyspark.sql import functions as F

from cdcflow.plans import build
from cdcflow.sources import TopicBinding, frames
from cdcflow.sources.topics import DECODE_FAILURE, RAW_VALUE, decoded


def test_heads_of_all_kinds(spark):
    values = [b"\0\0\0\0\5abc", b"\0\0\0\1\x2c", b"\0\x7f\xff\xff\xff\0", b"\1\0\0\0\5abc", b"\0\0\0\0", b"", None, b"\0\xff\xff\xff\xffz"]
    df = spark.createDataFrame([(v,) for v in values], "v binary")
    got = df.select(frames.schema_id(F.col("v")).alias("i"), frames.body(F.col("v")).alias("b")).collect()
    assert [(r.i, None if r.b is None else bytes(r.b)) for r in got] == [
        (5, b"abc"), (300, b""), (2**31 - 1, b"\0"), (None, None), (None, None), (None, None), (None, None), (2**32 - 1, b"z")]


def test_frames_round_trip(spark):
    df = spark.createDataFrame([(b"",), (b"\0\1\2",), (None,)], "v binary")
    for i in (0, 5, 300, 2**31 - 1):
        f = frames.framed(F.col("v"), i)
        got = df.select(f.alias("f"), frames.schema_id(f).alias("i"), frames.body(f).alias("b")).collect()
        assert [r.i for r in got] == [i, i, None] and [None if r.b is None else bytes(r.b) for r in got] == [b"", b"\0\1\2", None]
        assert bytes(got[1].f) == b"\0" + i.to_bytes(4, "big") + b"\0\1\2"
    with pytest.raises(ValueError):
        frames.framed(F.col("v"), -1)


def test_rows_go_to_their_schemas_decoder_and_the_rest_to_dead_letters(spark):
    frame = lambda i, b: b"\0" + i.to_bytes(4, "big") + b
    rows = [("a", frame(1, b"x=1")), ("b", frame(2, b"2")), ("c", frame(3, b"x=1")), ("d", b"plain"), ("e", None), ("f", frame(2, b"two"))]
    number = lambda c: F.when(c.cast("string").try_cast("int").isNotNull(), F.struct(c.cast("string").try_cast("int").alias("x")))
    older = lambda c: F.struct(F.regexp_extract(c.cast("string"), "x=(.*)", 1).try_cast("int").alias("x"))
    topic = frames.decode(spark.createDataFrame(rows, "key string, value binary"), {1: older, 2: number}, RAW_VALUE, DECODE_FAILURE)
    good, dead = build.undecodable(topic, {"sourceTopic": "t"})
    assert sorted((r.key, r.value and r.value.x) for r in good.collect()) == [("a", 1), ("b", 2), ("e", None)]
    assert DECODE_FAILURE not in good.columns
    assert {r.key: bytes(r.headers[-1]["value"]).decode() for r in dead.collect()} == {
        "c": "schema id 3 is not known", "d": "the value has no schema-registry frame", "f": "the record does not decode with schema id 2"}
    assert {r.key: bytes(r.value) for r in dead.collect()}["d"] == b"plain"
    with pytest.raises(ValueError, match="no schema is known"):
        frames.decode(topic, {}, RAW_VALUE, DECODE_FAILURE)


def test_avro_bodies_need_the_package(spark):
    schema = '{"type":"record","name":"r","fields":[{"name":"x","type":"int"}]}'
    df = spark.createDataFrame([("a", b"\0\0\0\0\1\2")], "key string, value binary")
    try:
        got = decoded(df, TopicBinding(avro_schemas={1: schema})).select("value.x").collect()
    except Exception as e:  # noqa: BLE001
        assert "avro" in str(e).lower()
    else:
        assert got[0].x == 1
    assert importlib.util.find_spec("pyspark.sql.avro") is not None
