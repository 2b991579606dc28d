"""Commit log of file topics, shared-read fan-out, starts that fail."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from cdcflow.plans import spec
from cdcflow.queries import common, fixtures
from cdcflow.sources import TopicBinding, read_topic, write_topic
from cdcflow.sources import topiclog
from cdcflow.streaming.runner import FanOut, fan_outs, start_pipeline, start_state, supervise
from cdcflow.streaming.state import StateTable
from conftest import SF_SMALL


def _batch(spark, n, size=40):
    return spark.range(n * size, (n + 1) * size).select(
        (F.col("id") % 7).cast("string").alias("key"), F.struct((F.col("id") % 7).cast("string").alias("k"), F.col("id").alias("v")).alias("value"), (-F.col("id")).alias("_seq"))


def test_a_replay_is_read_once_and_keys_keep_their_order(spark, scratch):
    b = {"t": TopicBinding(path=scratch, log=True, partitions=4)}
    for n in (0, 1, 1, 2):
        write_topic(_batch(spark, n), "t", b, batch_id=n, writer="w/1")
    # an attempt that died before its commit
    _batch(spark, 3).select("key", "value", F.lit(0).alias("_place"), F.lit(0).alias("partition")).write.partitionBy("partition").parquet(
        f"{scratch}/data/writer=w_1/batch_id=3")
    rows = read_topic(spark, "t", b).collect()
    assert sorted(r.value.v for r in rows) == list(range(120))
    parts, order = {}, {}
    for r in sorted(rows, key=lambda r: r.offset):
        parts.setdefault(r.key, set()).add(r.partition)
        order.setdefault(r.key, []).append(r.value.v)
    assert all(len(p) == 1 for p in parts.values())
    # by batch, then by the source's sequence (falling with v here)
    assert all(o == sorted(o, key=lambda v: (v // 40, -v)) for o in order.values())
    assert len({(r.partition, r.offset) for r in rows}) == 120
    write_topic(_batch(spark, 3), "t", b, batch_id=3, writer="w/1")  # the attempt's replay
    assert read_topic(spark, "t", b).count() == 160
    with pytest.raises(ValueError, match="commit log"):
        write_topic(_batch(spark, 4), "t", b)


def test_two_writers_and_a_stream_of_the_log(spark, scratch):
    path = os.path.join(scratch, "t")
    b = {"t": TopicBinding(path=path, log=True, partitions=2, options={"maxFilesPerTrigger": "1"})}
    seen = []

    def run():
        q = (read_topic(spark, "t", b, streaming=True).writeStream.option("checkpointLocation", os.path.join(scratch, "ck"))
             .foreachBatch(lambda df, n: seen.append(sorted(r.value.v for r in topics_opened(df, b).collect())) and None).trigger(availableNow=True).start())
        q.awaitTermination()

    write_topic(_batch(spark, 0), "t", b, batch_id=0, writer="a")
    write_topic(_batch(spark, 1), "t", b, batch_id=0, writer="b")
    run()
    write_topic(_batch(spark, 1), "t", b, batch_id=0, writer="b")  # a replay after the reader had it
    write_topic(_batch(spark, 2), "t", b, batch_id=1, writer="a")
    run()
    assert sorted(x for s in seen for x in s) == list(range(120)) and len(seen) == 3
    assert topiclog.committed(spark, path) == {("a", 0): 0, ("b", 0): 1, ("a", 1): 2}


def topics_opened(df, b):
    from cdcflow.sources.topics import opened

    return opened(df, "t", b)


def test_an_empty_log_is_an_empty_topic(spark, scratch):
    b = {"t": TopicBinding(path=scratch, log=True, schema="key string, value struct<k:string>")}
    os.makedirs(os.path.join(scratch, "log"))
    got = read_topic(spark, "t", b)
    assert got.count() == 0 and got.columns == ["key", "value", "partition", "offset"]


def test_state_over_a_log_is_ordered_by_its_offsets(spark, scratch):
    b = {"t": TopicBinding(path=os.path.join(scratch, "t"), log=True, partitions=3)}
    rows = lambda *r: spark.createDataFrame(r, "key string, value struct<k:string,v:string,__op:string>, _seq long")
    write_topic(rows(("a", ("a", "2", "u"), 2), ("a", ("a", "1", "c"), 1), ("b", ("b", "1", "c"), 1)), "t", b, 0, "w")
    write_topic(rows(("b", None, 1), ("c", ("c", "9", "c"), 5)), "t", b, 1, "w")
    start_state(spark, "t", b, os.path.join(scratch, "state"), os.path.join(scratch, "ck"), ["k"], ["offset"], trigger={"availableNow": True}, buckets=2).awaitTermination()
    got = StateTable(spark, os.path.join(scratch, "state"), ["k"], ["offset"]).read()
    assert sorted((r.k, r.v) for r in got.collect()) == [("a", "2"), ("c", "9")]


def test_levels_over_logged_topics(spark, scratch):
    """Refined users from a log, published to two logs by one reader of the topic between."""
    ctx = common.context(spark, SF_SMALL)
    names = ["changes.customer", "refined.customer", "refined.supplier", "matched.address", "contacts.by_channel", "stamps.by_customer", "rejects.refine", "rejects.match", "rejects.publish"]
    b = {n: TopicBinding(path=os.path.join(scratch, n), log=n.startswith(("changes", "refined", "contacts", "stamps")), partitions=3) for n in names}
    feed = fixtures.user_feed(spark, SF_SMALL, protect_key=common.SAMPLE_KEY).selectExpr("key", "value", "c_custkey AS _seq")
    write_topic(feed, "changes.customer", b, 0, "source")
    defs = spec.load()
    start_pipeline(spark, defs["lv1"][0], ctx, b, os.path.join(scratch, "ck"), {"availableNow": True}).awaitTermination()
    silver = read_topic(spark, "refined.customer", b)
    n = silver.count()
    assert n > 0 and {"partition", "offset"} <= set(silver.columns)
    outs = fan_outs(spark, [d for d in defs["api"] + defs["lv2"] if d["sourceTopic"] == "refined.customer"], ctx, b, os.path.join(scratch, "fan"))
    assert list(outs) == ["refined.customer"] and len(outs["refined.customer"].defns) == 3
    for _ in range(2):
        outs["refined.customer"].start({"availableNow": True}).awaitTermination()
    assert read_topic(spark, "contacts.by_channel", b).count() == n == read_topic(spark, "stamps.by_customer", b).count()
    assert read_topic(spark, "matched.address", b).count() > 0


def _definitions(names):
    return [{"name": n, "group": "lv2", "sourceTopic": "in", "destinationTopic": f"out.{n}", "failTopic": f"fail.{n}", "mapperName": "cache_stamp",
             "schemaName": "CacheStamp", "keyType": "String", "keyFormat": "{entity_id}", "primaryKeyFields": ["entity_id"], "channel": n} for n in names]


def test_one_destinations_failure_neither_blocks_nor_repeats_the_others(spark, scratch):
    ctx = common.context(spark, SF_SMALL)
    b = {n: TopicBinding(path=os.path.join(scratch, n)) for n in ["in", "out.a", "out.c", "fail.a", "fail.b", "fail.c"]}  # out.b is not bound
    fan = FanOut(spark, "in", _definitions("abc"), ctx, b, os.path.join(scratch, "fan"), most_behind=2)
    batch = lambda n: spark.createDataFrame([(f"k{n}", (f"u{n}",))], "key string, value struct<user_id:string>")
    ids = lambda t: sorted(r.key for r in read_topic(spark, t, b).collect())
    assert fan.process(batch(0), 0) == {"a": "done", "b": "waits", "c": "done"}
    assert fan.process(batch(1), 1) == {"a": "done", "b": "waits", "c": "done"}
    stamps = {f: os.stat(f).st_mtime_ns for t in ("out.a", "out.c") for d, _, fs in os.walk(b[t].path) for f in (os.path.join(d, x) for x in fs)}
    assert fan.process(batch(1), 1) == {"a": "done before", "b": "waits", "c": "done before"}  # a replay
    assert all(os.stat(f).st_mtime_ns == t for f, t in stamps.items())
    assert ids("out.a") == ids("out.c") == ["u0", "u1"] and fan.waiting("b") == [0, 1]
    with pytest.raises(RuntimeError, match="wait"):
        fan.process(batch(2), 2)  # b is too far behind
    b["out.b"] = TopicBinding(path=os.path.join(scratch, "out.b"))
    assert fan.process(batch(2), 2) == {"a": "done before", "b": "done", "c": "done"}
    assert ids("out.b") == ["u0", "u1", "u2"] == ids("out.c") and fan.waiting("b") == []


class _Query:
    lastProgress = None

    def __init__(self, forever=False):
        self.isActive = forever

    def exception(self):
        return None

    def stop(self):
        self.isActive = False


def test_a_start_that_raises_leaves_the_others_running():
    tries, healthy, stop = [], _Query(forever=True), threading.Event()

    def starts_the_fourth_time():
        tries.append(1)
        if len(tries) < 4:
            raise ValueError("topic not there yet")
        stop.set()
        return _Query()

    supervise(None, {"good": lambda: healthy, "late": starts_the_fourth_time}, poll_seconds=0.01, longest_wait=0.02, stop=stop)
    assert len(tries) == 4
    other = _Query(forever=True)

    def never():
        raise ValueError("no such topic")

    with pytest.raises(RuntimeError, match="no such topic"):
        supervise(None, {"good": lambda: other, "bad": never}, poll_seconds=0.01, longest_wait=0.01, max_restarts=2)
    assert not other.isActive
