"""Keyed state in buckets: what a merge rewrites, replays, tombstones, dead letters."""

import os

import pytest
from pyspark.sql import functions as F

from cdcflow.operators import changes
from cdcflow.sources import TopicBinding, read_topic
from cdcflow.streaming.runner import start_state
from cdcflow.streaming.state import StateTable

SCHEMA = "k string, seq long, __op string, v string"


def _rows(spark, *rows, schema=SCHEMA):
    return spark.createDataFrame(list(rows), schema)


def _files(path):
    out = {}
    for d, _, names in os.walk(os.path.join(path, "data")):
        for n in names:
            if n.endswith(".parquet"):
                out[os.path.join(d, n)] = os.stat(os.path.join(d, n)).st_mtime_ns
    return out


def _live(t):
    return sorted((r.k, r.v) for r in t.read().collect())


def test_a_merge_rewrites_only_the_buckets_it_touches(spark, scratch):
    t = StateTable(spark, scratch, ["k"], ["seq"], buckets=16)
    assert t.read() is None and t.lookup(_rows(spark, ("a", 0, "c", ""))) is None
    t.merge(_rows(spark, *[(f"k{i}", i, "c", f"v{i}") for i in range(200)]), 0)
    before, first = _files(scratch), t.manifest()
    assert sorted(first.at) == list(range(16))
    m = t.merge(_rows(spark, ("k7", 1000, "u", "new"), ("k7", 999, "u", "older")), 1)
    assert m.version == 2 and sum(v == 2 for v in m.at.values()) == 1
    after = _files(scratch)
    new = set(after) - set(before)
    # the files of the other fifteen buckets are the same files
    assert all(after[f] == before[f] for f in before) and {f.split("bucket=")[1].split("/")[0] for f in new} == {str(b) for b, v in m.at.items() if v == 2}
    assert dict(_live(t))["k7"] == "new" and len(_live(t)) == 200


def test_old_versions_go_and_the_last_two_stay(spark, scratch):
    t = StateTable(spark, scratch, ["k"], ["seq"], buckets=4)
    for n in range(6):
        t.merge(_rows(spark, ("a", n, "u", f"v{n}")), n)
    assert t.versions() == [5, 6]
    named = {(b, v) for n in t.versions() for b, v in t.manifest(n).at.items()}
    there = {(int(f.split("bucket=")[1].split("/")[0]), int(f.split("version=")[1].split("/")[0])) for f in _files(scratch)}
    assert there == named and _live(t) == [("a", "v5")]


def test_replays_late_changes_and_dead_attempts(spark, scratch):
    t = StateTable(spark, scratch, ["k"], ["seq"], buckets=4)
    t.merge(_rows(spark, ("a", 1, "c", "x"), ("b", 1, "c", "y")), 0, "q")
    t.merge(_rows(spark, ("a", 3, "d", None)), 1, "q")
    again = t.merge(_rows(spark, ("a", 9, "c", "never")), 1, "q")  # batch 1 is committed: not applied twice
    assert again.version == 2 and _live(t) == [("b", "y")]
    # an attempt that died after writing its rows and before its manifest
    t._write(_rows(spark, ("b", 9, "u", "lost")).withColumn("bucket", t._bucket(4)), 3)
    assert _live(t) == [("b", "y")]
    t.merge(_rows(spark, ("a", 2, "u", "late"), ("b", 2, "u", "z")), 2, "q")
    assert _live(t) == [("b", "z")]
    t.merge(_rows(spark, ("c", 1, "c", "other")), 0, "another query")  # its own numbering
    assert _live(t) == [("b", "z"), ("c", "other")]
    assert t.merge(_rows(spark, *[], schema=SCHEMA), 3, "q").writers == {"q": 3, "another query": 0}


def test_new_columns_null_keys_rebucket_forget_and_lookup(spark, scratch):
    t = StateTable(spark, scratch, ["k"], ["seq"], buckets=3)
    t.merge(_rows(spark, ("a", 1, "c", "x"), (None, 1, "c", "nokey"), ("gone", 1, "d", None)))
    t.merge(_rows(spark, ("b", 2, "c", "y", 7), schema=SCHEMA + ", w int"))
    want = [(None, "nokey", None), ("a", "x", None), ("b", "y", 7)]
    got = lambda: sorted(((r.k, r.v, r.w) for r in t.read().collect()), key=lambda r: (r[0] is not None, r[0]))
    assert got() == want
    assert t.rebucket(11).buckets == 11 and got() == want
    assert t.read(with_deletes=True).count() == 4
    t.forget("seq", 5)
    assert t.read(with_deletes=True).count() == 3 and got() == want
    t.merge(_rows(spark, ("a", 3, "u", "x2")))
    assert {(r.k, r.v) for r in t.lookup(_rows(spark, ("a", 0, "", ""), ("zz", 0, "", ""))).collect()} == {("a", "x2")}


def test_keys_of_another_type_meet_their_rows(spark, scratch):
    t = StateTable(spark, scratch, ["k"], ["seq"], buckets=8)
    t.merge(_rows(spark, (5, 1, "c", "x"), schema="k long, seq long, __op string, v string"))
    t.merge(_rows(spark, (5, 2, "d", None), schema="k int, seq int, __op string, v string"))
    assert t.read().count() == 0


@pytest.mark.parametrize("key", ["struct", "json", "plain"])
def test_tombstones_delete_by_the_records_key(spark, key):
    keys = {"struct": "named_struct('k', k)", "json": "to_json(named_struct('k', k))", "plain": "k"}[key]
    topic = _rows(spark, ("a", 1, "c", "x"), ("b", 2, "c", "y"), ("a", 3, None, None), ("b", 1, None, None)).selectExpr(
        f"{keys} AS key", "seq AS offset", "CASE WHEN __op IS NOT NULL THEN named_struct('k', k, '__op', __op, 'v', v) END AS value")
    out = changes.latest_state(changes.keyed_changes(topic, ["k"], ["offset"]), ["k"], ["offset"])
    assert [(r.k, r.v) for r in out.collect()] == [("b", "y")]  # b's tombstone is older than its record


def test_keyed_changes_refuses_what_it_cannot_order_or_read(spark):
    topic = _rows(spark, ("a", 1, "c", "x")).selectExpr("k AS key", "named_struct('k', k, 'seq', seq) AS value")
    with pytest.raises(ValueError, match="not columns of the topic"):
        changes.keyed_changes(topic, ["k"], ["seq"])
    with pytest.raises(ValueError, match="decoded value"):
        changes.keyed_changes(topic.selectExpr("key", "'{}' AS value"), ["k"], ["seq"])
    with pytest.raises(ValueError, match="must be a struct or JSON"):
        changes.keyed_changes(topic.selectExpr("1 AS key", "value", "1 AS o"), ["k", "j"], ["o"])


def test_state_of_a_topic_honours_tombstones_and_loses_nothing(spark, scratch):
    src, dead = os.path.join(scratch, "topic"), os.path.join(scratch, "dead")
    text = lambda k, v: f'{{"k":"{k}","v":"{v}","__op":"c"}}'
    rows = [("a", text("a", 1), 1), ("b", text("b", 1), 2), ("a", None, 3), ("c", '{"k":"c","v"', 4), ("d", None, 5)]
    spark.createDataFrame(rows, "key string, value string, offset long").write.parquet(src)
    b = {"t": TopicBinding(path=src, value_schema="k string, v string, __op string"), "dead": TopicBinding(path=dead)}
    args = (spark, "t", b, os.path.join(scratch, "state"), os.path.join(scratch, "ck"), ["k"], ["offset"])
    with pytest.raises(ValueError, match="dead_letter_topic"):
        start_state(*args)
    for _ in range(2):  # the second run finds nothing new
        start_state(*args, trigger={"availableNow": True}, dead_letter_topic="dead", buckets=4).awaitTermination()
    t = StateTable(spark, os.path.join(scratch, "state"), ["k"], ["offset"])
    assert [(r.k, r.v) for r in t.read().collect()] == [("b", "1")]
    assert {(r.k, r["__op"]) for r in t.read(with_deletes=True).collect()} == {("a", "d"), ("b", "c"), ("d", "d")}
    assert [(r.key, r.value) for r in read_topic(spark, "dead", b).collect()] == [("c", '{"k":"c","v"')]


def test_a_merge_shuffles_once_by_bucket(spark, scratch):
    t = StateTable(spark, scratch, ["k"], ["seq"], buckets=4)
    t.merge(_rows(spark, ("a", 1, "c", "x")), 0)
    m = t.manifest()
    both = t.rows(m, [0, 1]).unionByName(_rows(spark, ("a", 2, "c", "x")).withColumn("bucket", t._bucket(4))).repartition(F.col("bucket"))
    plan = changes.latest_state(both, ["bucket", "k"], ["seq"], keep_deletes=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1, plan
