"""Lookups whose keys decide what is read, references kept current, safe refresh."""

import os
import re
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcflow.operators import lookup, pushed
from cdcflow.plans import build, spec
from cdcflow.plans.context import Context
from cdcflow.queries import common
from cdcflow.streaming.state import StateTable
from test_plans import plan_of


def _ref(spark, scratch, n=1000):
    path = os.path.join(scratch, "ref")
    spark.range(n).selectExpr("concat('U', lpad(id, 5, '0')) AS ID", "id AS num", "concat('s', id) AS SSN", "repeat('x', 50) AS wide").repartitionByRange(8, "ID").write.parquet(path)
    return pushed.FileReference(lambda: spark.read.parquet(path))


def _batch(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "id string")


@pytest.mark.parametrize("at_most", [100, 2])
def test_pushed_lookups_equal_whole_ones(spark, scratch, at_most):
    ref = _ref(spark, scratch)
    df = _batch(spark, ["U00003", "U00007", "U00003", None, "nobody", "U00500", "skipped", "U00009"])
    skip = F.col("id") == "skipped"
    got = pushed.lookup_pushed(df, [F.col("id")], ref, ["ID"], "SSN", "ssn", skip=skip, at_most=at_most)
    whole = lookup.lookup(df, [F.col("id")], ref.read(), ["ID"], "SSN", "ssn", skip=skip)
    assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect()))
    scan = next(x for x in plan_of(got).splitlines() if "PushedFilters" in x and "SSN" in x)
    want = r"In\(ID, \[" if at_most == 100 else r"GreaterThanOrEqual\(ID,"
    assert re.search(want, scan) and "wide" not in scan, scan  # the key filter is on the scan, and only two columns


def test_numeric_and_compound_keys_and_batches_without_keys(spark, scratch):
    ref = _ref(spark, scratch)
    df = _batch(spark, ["5", "17", "x", None]).withColumn("who", F.concat(F.lit("U"), F.lpad("id", 5, "0")))
    got = pushed.lookup_pushed(df, [F.col("id")], ref, ["num"], "SSN", "ssn")
    assert {(r.id, r.ssn) for r in got.collect()} == {("5", "s5"), ("17", "s17"), ("x", None), (None, None)}
    for at_most in (0, 9):
        both = pushed.lookup_pushed(df, [F.col("who"), F.col("id")], ref, ["ID", "num"], "SSN", "ssn", at_most=at_most)
        assert {(r.id, r.ssn) for r in both.collect()} == {("5", "s5"), ("17", "s17"), ("x", None), (None, None)}
    for at_most in (0, 9):
        none = pushed.lookup_pushed(df.where("id IS NULL"), [F.col("id")], ref, ["num"], "SSN", "ssn", at_most=at_most)
        assert [r.ssn for r in none.collect()] == [None]


def test_keys_with_quotes_and_backslashes(spark):
    odd = ["it's", "a\\b", 'say "x"', "", "${x}", "새\n줄", "%", "\\"]
    table = spark.createDataFrame([(o, f"v{k}") for k, o in enumerate(odd)] + [("other", "no")], "ID string, V string")
    want = pushed.asked(_batch(spark, odd), [F.col("id")], table.schema, ["ID"])
    got = pushed.FileReference(lambda: table).rows(want, ["ID", "V"])
    assert sorted((r.ID, r.V) for r in got.collect()) == sorted((o, f"v{k}") for k, o in enumerate(odd))


def test_jdbc_predicates_ask_for_each_key_once_and_quote():
    one = pushed.Keys(["ID"], [T.StringType()], listed=[("b",), ("a'; DROP",), ("b",), ("c",)])
    assert pushed.predicates(one, 2) == ["ID IN ('a''; DROP', 'b')", "ID IN ('c')"]
    two = pushed.Keys(["A", "B"], [T.LongType(), T.StringType()], listed=[(1, "x"), (2, "y")])
    assert pushed.predicates(two) == ["(A = 1 AND B = 'x') OR (A = 2 AND B = 'y')"]


@pytest.mark.parametrize("kind", ["bigint", "timestamp"])
def test_a_reference_kept_current_reads_only_what_changed(spark, scratch, kind):
    path, state = os.path.join(scratch, "src"), os.path.join(scratch, "state")
    def put(rows, mode="append"):
        spark.createDataFrame(rows, "ID string, SSN string, at bigint").withColumn("at", F.col("at") if kind == "bigint" else F.timestamp_seconds("at")).coalesce(1).write.mode(mode).parquet(path)

    put([(f"U{i}", f"s{i}", 10) for i in range(50)])
    table = StateTable(spark, state, ["ID"], ["at"], buckets=8)
    ref = pushed.StateReference(table, lambda: spark.read.parquet(path), "at")
    unit = 1 if kind == "bigint" else 10**6
    assert ref.refresh() == 10 * unit
    find = lambda *ids: {r.id: r.ssn for r in pushed.lookup_pushed(_batch(spark, ids), [F.col("id")], ref, ["ID"], "SSN", "ssn").collect()}
    assert find("U1", "U2", "zz") == {"U1": "s1", "U2": "s2", "zz": None}
    first = table.manifest().at
    put([("U1", "new", 20)])
    assert find("U1") == {"U1": "s1"}  # as of the last refresh
    assert ref.refresh() == 20 * unit and find("U1", "U2") == {"U1": "new", "U2": "s2"}
    assert sum(table.manifest().at[b] != v for b, v in first.items()) == 1  # one bucket was rewritten
    put([("U3", "same instant", 20)])
    assert ref.refresh() == 20 * unit and find("U3", "U1") == {"U3": "same instant", "U1": "new"}


def test_the_sample_refinement_takes_a_keyed_reference(spark, scratch):
    ref = pushed.FileReference(lambda: spark.createDataFrame([("U1", "s1"), ("U2", "s2")], "ID string, SSN string"))
    feed = spark.createDataFrame([(i, '{"payload":{"op":"c","after":{"id":"%s"}}}' % i) for i in ("U1", "U9")], "key string, value string")
    lv1 = spec.load()["lv1"][0]
    ctx = Context(spark=spark, tables={"USERS": ref}, protect_key=common.SAMPLE_KEY)
    got = build.route(build.refine(feed, lv1, ctx), lv1).success
    assert {(r.user_id, r.decrypted_ssn) for r in got.collect()} == {("U1", "s1"), ("U9", None)} and ctx.prepared == {}


def test_one_batchs_refresh_leaves_the_others_table_alone(spark):
    read = []
    def source():
        read.append(1)
        return spark.createDataFrame([("a", len(read))], "k string, v int")

    ctx = Context(spark=spark, tables={"T": source}, refresh_seconds=0)
    get = lambda: ctx.reference("T", "T", lambda t: t)
    with ctx.batch():
        first = get()
        assert first.collect()[0].v == 1 and get() is first
        seen = {}

        def other():
            with ctx.batch():  # a batch of another query: its own generation
                seen["v"] = get().collect()[0].v
                seen["first still there"] = first.is_cached
        t = threading.Thread(target=other)
        t.start()
        t.join()
        assert seen == {"v": 2, "first still there": True}
        assert first.is_cached and first.collect()[0].v == 1
    assert not first.is_cached  # its last batch ended after it was retired
    ctx.release()


def test_a_slow_preparation_keeps_no_other_table_waiting(spark):
    going, go = threading.Event(), threading.Event()
    def slow():
        going.set()
        assert go.wait(60)
        return spark.range(1)

    ctx = Context(spark=spark, tables={"SLOW": slow, "FAST": lambda: spark.range(2)}, refresh_seconds=None)
    t = threading.Thread(target=lambda: ctx.reference("s", "SLOW", lambda d: d))
    t.start()
    assert going.wait(60)
    assert ctx.reference("f", "FAST", lambda d: d).count() == 2  # while SLOW is being read
    go.set()
    t.join()
    assert ctx.reference("s", "SLOW", lambda d: d).count() == 1
    ctx.release()
