"""Physical-plan properties the design relies on (read from ``explain``)."""

import contextlib
import io

from pyspark.sql import functions as F

from cdcflow.operators import address, changes, envelope, lookup, rejects
from cdcflow.plans import build, spec
from cdcflow.plans.context import Context


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("extended")
    text = buf.getvalue()
    return text[text.index("== Physical Plan =="):]


def _feed(spark, n=200):
    rows = [(str(i), '{"payload":{"op":"c","after":{"id":"U%d","email":"a%d@b.co"}}}' % (i, i)) for i in range(n)]
    return spark.createDataFrame(rows, "key string, value string")


def test_json_is_parsed_once_even_under_the_success_filter(spark):
    ok = rejects.successes(envelope.unwrap_json(_feed(spark)))
    p = plan_of(ok)
    assert p.count("parseJson") == 1, p


def test_prepared_reference_is_broadcast_when_small(spark):
    users = spark.createDataFrame([("U%d" % i, "s%d" % i) for i in range(100)], "ID string, SSN string")
    ctx = Context(spark=spark, tables={"USERS": users}, protect_key="0" * 32)
    lv1 = spec.load()["lv1"][0]
    p = plan_of(build.route(build.refine(_feed(spark), lv1, ctx), lv1).success)
    assert "BroadcastHashJoin" in p and "InMemoryTableScan" in p
    ctx.release()


def test_unprepared_large_reference_is_not_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        ref = spark.range(100000).selectExpr("CAST(id AS STRING) AS k", "CAST(id AS STRING) AS v")
        df = spark.range(100000).selectExpr("CAST(id AS STRING) AS k")
        p = plan_of(lookup.lookup(df, [F.col("k")], ref, ["k"], "v", "out"))
        assert "BroadcastHashJoin" not in p and "SortMergeJoin" in p
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_latest_state_aggregates_partially_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("CAST(id % 3 AS STRING) AS key", "id AS seq", "'u' AS __op")
    p = plan_of(changes.latest_state(df, ["key"], ["seq"]))
    assert "partial_max_by" in p and "Window" not in p


def test_address_match_has_no_pairwise_product(spark):
    ref = spark.createDataFrame([("a b c", "r", "z", "c1", "d1", "t1")], "search_text string, road_address string, zipcode string, city string, district string, town string")
    df = spark.createDataFrame([("a b x",)], "addr string")
    p = plan_of(address.match_addresses(df, ["addr"], ref))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "partial_" in p  # prefix summary and distinct keywords aggregate map-side


def test_refine_users_reads_pruned_parquet_without_a_checkpoint(spark):
    from cdcflow.queries import all_queries
    from conftest import SF_SMALL

    p = plan_of(all_queries()["refine_users"](spark, SF_SMALL))
    assert "FileScan parquet" in p and "ExistingRDD" not in p
    # the only round-robin exchange is the rebalanced reference of the lookup
    assert p.count("RoundRobinPartitioning") == p.count("REBALANCE_PARTITIONS_BY_NONE")
    scan = next(x for x in p.splitlines() if "FileScan parquet" in x and "c_custkey" in x)
    assert "c_acctbal" not in scan and "c_comment" not in scan


def test_struct_times_and_bytes_become_plain_values(spark):
    from cdcflow.functions.jsonval import json_text

    df = spark.sql("SELECT named_struct('op', 'c', 'after', named_struct('t', TIMESTAMP_NTZ '2024-01-01 00:00:01', 'd', DATE '1970-01-03', "
                   "'b', CAST('ab' AS BINARY), 'inner', named_struct('ts', TIMESTAMP '2024-01-01 00:00:00Z'), 'list', array(DATE '1970-01-02'))) AS value")
    u = envelope.unwrap_struct(df)
    r = u.select(json_text(F.col("data"), "t").alias("t"), json_text(F.col("data"), "d").alias("d"), json_text(F.col("data"), "b").alias("b"),
                 F.to_json("data").alias("j")).collect()[0]
    assert (r.t, r.d, r.b) == ("1704067201000", "2", "ab")
    assert '"inner":{"ts":1704067200000}' in r.j and '"list":[1]' in r.j
