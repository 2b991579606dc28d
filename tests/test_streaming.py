"""Spec-driven streaming run on file-bound topics, compared with the batch plan."""

import os

from pyspark.sql import functions as F

from cdcflow.plans import build, spec
from cdcflow.queries import common, fixtures
from cdcflow.queries.mappings import address_reference
from cdcflow.sources import TopicBinding, read_topic, write_topic
from cdcflow.streaming import run_spec, start_pipeline, supervise
from conftest import SF_SMALL


def _bindings(root):
    names = ["changes.customer", "refined.customer", "refined.supplier", "matched.address",
             "contacts.by_channel", "stamps.by_customer", "rejects.refine", "rejects.match", "rejects.publish"]
    return {n: TopicBinding(format="parquet", path=os.path.join(root, n)) for n in names}


def test_stream_matches_batch(spark, scratch):
    ctx = common.context(spark, SF_SMALL)
    b = _bindings(scratch)
    feed = fixtures.user_feed(spark, SF_SMALL, protect_key=common.SAMPLE_KEY).select("key", "value")
    feed.write.parquet(b["changes.customer"].path)
    ckpt = os.path.join(scratch, "_checkpoints")
    qs = run_spec(spark, None, ctx, b, ckpt, trigger={"availableNow": True}, groups=("lv1",))
    for q in qs:
        q.awaitTermination()
    defs = spec.load()
    lv1 = defs["lv1"][0]
    expected = build.route(build.refine(feed, lv1, ctx), lv1).success
    got = read_topic(spark, "refined.customer", b)
    assert got.count() == expected.count() > 0
    cols = ["user_id", "email", "phone", "created_at", "__op"]
    assert sorted(got.select("value.*").select(*cols).collect()) == sorted(expected.select(*cols).collect())

    # fan-out: the silver topic feeds the address stage and two gold templates
    spark.read.parquet(b["refined.customer"].path).limit(50).write.parquet(b["refined.supplier"].path)
    qs = run_spec(spark, None, ctx, b, ckpt, trigger={"availableNow": True}, groups=("api", "lv2"))
    for q in qs:
        q.awaitTermination()
    n_silver = got.count()
    assert read_topic(spark, "contacts.by_channel", b).count() == n_silver + 50
    redis = read_topic(spark, "stamps.by_customer", b)
    assert redis.count() == n_silver
    assert redis.where(F.col("key") != F.col("value.entity_id")).count() == 0
    api = read_topic(spark, "matched.address", b)
    assert api.count() > 0
    assert set(r[0] for r in api.select("value.juso_quality").distinct().collect()) <= {"ok", "ambiguous", "not_found"}

    # a replayed run from the same checkpoint adds nothing
    qs = run_spec(spark, None, ctx, b, ckpt, trigger={"availableNow": True}, groups=("lv1",))
    for q in qs:
        q.awaitTermination()
    assert read_topic(spark, "refined.customer", b).count() == n_silver


def test_rejects_reach_fail_topic(spark, scratch):
    ctx = common.context(spark, SF_SMALL)
    b = _bindings(scratch)
    fixtures.event_feed(spark, SF_SMALL).select("key", "value").write.parquet(b["changes.customer"].path)
    lv1 = spec.load()["lv1"][0]
    q = start_pipeline(spark, lv1, ctx, b, os.path.join(scratch, "_ck"), trigger={"availableNow": True})
    q.awaitTermination()
    fails = read_topic(spark, "rejects.refine", b)
    ok = read_topic(spark, "refined.customer", b)
    total = fixtures.event_feed(spark, SF_SMALL).where("value IS NOT NULL").count()
    assert fails.count() > 0 and ok.count() + fails.count() == total
    assert fails.where(F.col("value.reason").isNull()).count() == 0


def test_supervise_restarts_then_finishes(spark, scratch):
    ctx = common.context(spark, SF_SMALL)
    b = _bindings(scratch)
    fixtures.user_feed(spark, SF_SMALL, protect_key=common.SAMPLE_KEY).select("key", "value").write.parquet(
        b["changes.customer"].path
    )
    lv1 = spec.load()["lv1"][0]
    ck = os.path.join(scratch, "_ck")
    supervise(spark, {"lv1": lambda: start_pipeline(spark, lv1, ctx, b, ck, trigger={"availableNow": True})}, poll_seconds=0.5)
    assert read_topic(spark, "refined.customer", b).count() > 0
    _ = address_reference  # the api stage's reference set is bound lazily in the context


def test_cli_runs_a_spec_once(spark, scratch):
    import yaml

    from cdcflow import cli

    b = _bindings(scratch)
    fixtures.user_feed(spark, SF_SMALL, protect_key=common.SAMPLE_KEY).select("key", "value").write.parquet(
        b["changes.customer"].path
    )
    users = os.path.join(scratch, "users")
    fixtures.users_table(spark, SF_SMALL).write.parquet(users)
    addresses = os.path.join(scratch, "addresses")
    address_reference(spark, SF_SMALL).write.parquet(addresses)
    # a second channel's silver topic, produced elsewhere
    lv1 = spec.load()["lv1"][0]
    ctx = common.context(spark, SF_SMALL)
    feed = fixtures.user_feed(spark, SF_SMALL, protect_key=common.SAMPLE_KEY).select("key", "value")
    other = build.route(build.refine(feed, lv1, ctx), lv1).success.limit(20)
    write_topic(other, "refined.supplier", b, batch_id=0, writer="other")
    conf = {
        "checkpoint": os.path.join(scratch, "_cli_ck"),
        "topics": {n: {"format": "parquet", "path": t.path} for n, t in b.items()},
        "protect_key_conf": "cdcflow.test.key",
        "tables": {"USERS": {"path": users}, "ADDRESSES": {"path": addresses}},
    }
    path = os.path.join(scratch, "bindings.yml")
    with open(path, "w") as fh:
        yaml.safe_dump(conf, fh)
    spark.conf.set("cdcflow.test.key", common.SAMPLE_KEY)
    cli.main(["run", "--bindings", path, "--once"])
    n = read_topic(spark, "refined.customer", b).count()
    assert n > 0
    assert read_topic(spark, "contacts.by_channel", b).count() == n + 20
    assert read_topic(spark, "matched.address", b).count() > 0


def test_lookup_sees_rows_added_between_batches(spark, scratch):
    from cdcflow.plans.context import Context
    from cdcflow.streaming.runner import process_batch

    path = os.path.join(scratch, "users")
    spark.createDataFrame([("U1", "s1")], "ID string, SSN string").write.parquet(path)
    ctx = Context(spark=spark, tables={"USERS": lambda: spark.read.parquet(path)}, protect_key=common.SAMPLE_KEY)
    b = _bindings(scratch)
    lv1 = spec.load()["lv1"][0]
    envelope = lambda i: spark.createDataFrame([(i, '{"payload":{"op":"c","after":{"id":"%s"}}}' % i)], "key string, value string")
    process_batch(envelope("U1"), 0, lv1, ctx, b)
    spark.createDataFrame([("U2", "s2")], "ID string, SSN string").write.mode("append").parquet(path)
    process_batch(envelope("U2"), 1, lv1, ctx, b)
    got = {r.user_id: r.decrypted_ssn for r in read_topic(spark, lv1["destinationTopic"], b).select("value.*").collect()}
    assert got == {"U1": "s1", "U2": "s2"}
    ctx.release()


def test_values_that_do_not_decode_reach_the_dead_letter_topic(spark, scratch):
    from cdcflow.streaming.runner import process_batch

    b = _bindings(scratch)
    dead = os.path.join(scratch, "dead")
    b["dead"] = TopicBinding(path=dead)
    src = os.path.join(scratch, "text")
    rows = [("1", '{"user_id":"U1","email":"a@b.co"}'), ("2", '{"user_id":'), ("3", None), ("4", '{"user_id":{"x":1}}')]
    spark.createDataFrame(rows, "key string, value string").write.parquet(src)
    b["refined.customer"] = TopicBinding(path=src, value_schema="user_id string, email string")
    ctx = common.context(spark, SF_SMALL)
    defn = next(d for d in spec.load()["lv2"] if d["name"] == "ContactsCustomers")
    batch = read_topic(spark, "refined.customer", b)
    process_batch(batch, 0, dict(defn, deadLetterTopic="dead"), ctx, b)
    assert [r.key for r in read_topic(spark, "dead", b).select("key").collect()] == ["2"]
    # an object where text is asked for reads as its JSON text, as the text rules do
    assert read_topic(spark, defn["destinationTopic"], b).count() == 2
    process_batch(batch, 1, defn, ctx, b)  # without a dead-letter topic: a reject record
    bad = read_topic(spark, defn["failTopic"], b).select("key", "value.*").collect()
    assert [(r.key, r.error_context, r.payload) for r in bad] == [("2", "json_parsing", '{"user_id":')]


def test_text_topic_without_a_schema_is_refused(spark):
    import pytest

    flat = spark.createDataFrame([("1", "{}")], "key string, value string")
    with pytest.raises(ValueError, match="value_schema"):
        build.normalize_source(flat, {"group": "lv2", "sourceTopic": "t"}, common.context(spark, SF_SMALL))
    with pytest.raises(ValueError, match="avro_schema"):
        build.normalize_source(flat, {"group": "lv1", "inputFormat": "avro"}, common.context(spark, SF_SMALL))


def test_state_of_batches_is_replayable_and_keeps_deletes(spark, scratch):
    from cdcflow.operators.changes import live
    from cdcflow.streaming.runner import merge_batch

    path = os.path.join(scratch, "state")
    batch = lambda *rows: spark.createDataFrame(rows, "k string, seq int, __op string, v string")
    merge_batch(batch(("a", 1, "c", "x"), ("b", 1, "c", "y")), 0, path, ["k"], ["seq"])
    merge_batch(batch(("a", 3, "d", None)), 1, path, ["k"], ["seq"])
    for _ in range(2):  # the second time is a replay
        state = merge_batch(batch(("a", 2, "u", "late"), ("b", 2, "u", "z")), 2, path, ["k"], ["seq"])
    assert {(r.k, r.v) for r in live(state).collect()} == {("b", "z")}


class _Query:
    def __init__(self, error=None, forever=False):
        self.error, self.isActive, self.lastProgress = error, forever, None

    def exception(self):
        return self.error

    def stop(self):
        self.isActive = False


def test_supervise_has_no_lifetime_cap_and_stops_all(spark):
    import threading

    import pytest

    made = []

    def flaky():
        made.append(_Query("boom" if len(made) < 8 else None))
        made[-1].lastProgress = {}  # got on before it failed
        return made[-1]

    supervise(spark, {"q": flaky}, poll_seconds=0.01, max_restarts=2, longest_wait=0.01)
    assert len(made) == 9
    with pytest.raises(RuntimeError, match="in a row"):
        other = _Query(forever=True)
        supervise(spark, {"bad": lambda: _Query("boom"), "good": lambda: other}, poll_seconds=0.01, max_restarts=2, longest_wait=0.01)
    assert not other.isActive
    stop, running = threading.Event(), _Query(forever=True)
    threading.Timer(0.1, stop.set).start()
    supervise(spark, {"q": lambda: running}, poll_seconds=0.01, stop=stop)
    assert not running.isActive
