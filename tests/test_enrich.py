"""Lookups, protection, address matching, latest state."""

from pyspark.sql import functions as F

from cdcflow.operators import address, changes, lookup, protect

KEY = "0123456789abcdef0123456789abcdef"


def test_lookup_single_compound_and_first_match(spark):
    ref = spark.createDataFrame([("1", "a", 2, "x2"), ("1", "a", 1, "x1"), ("2", "b", 1, None)], "id string, k2 string, ord int, v string")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "a")], "id int, k2 string")
    single = lookup.lookup(df, [F.col("id")], ref, ["id"], "v", "out", order_col="ord")
    assert {(r["id"], r["out"]) for r in single.collect()} == {(1, "x1"), (2, None), (3, None), (None, None)}
    comp = lookup.lookup(df, [F.col("id"), F.col("k2")], ref, ["id", "k2"], "v", "out")
    assert {(r["id"], r["out"]) for r in comp.collect()} == {(1, "x1"), (2, None), (3, None), (None, None)}


def test_protect_contract(spark):
    df = spark.createDataFrame([("secret",), (None,)], "x string")
    out = df.select(
        protect.reveal(protect.protect("x", KEY), KEY).alias("back"),
        protect.reveal(F.lit("not-a-cipher"), KEY).alias("bad"),
        protect.reveal_all(protect.protect_all(F.array("x", F.lit("b")), KEY), KEY).alias("batch"),
        (protect.protect("x", KEY, True) == protect.protect("x", KEY, True)).alias("det"),
    ).collect()
    assert out[0]["back"] == "secret" and out[1]["back"] is None
    assert out[0]["bad"] is None
    assert out[0]["batch"] == ["secret", "b"] and out[1]["batch"] == [None, "b"]
    assert out[0]["det"] is True


def _ref(spark):
    rows = [
        ("서울 중구 한강대로 405", "서울특별시 중구 한강대로 405", "04320", "서울특별시", "중구", "봉래동2가"),
        ("서울 중구 세종대로 1", "서울특별시 중구 세종대로 1", "04500", "서울특별시", "중구", "태평로1가"),
        ("서울 중구 세종대로 2", "서울특별시 중구 세종대로 2", "04500", "서울특별시", "중구", "태평로1가 "),
        ("부산 해운대구 A", "부산 해운대구 A", "48000", "부산광역시", "해운대구", "우동"),
        ("부산 해운대구 B", "부산 해운대구 B", "48001", "부산광역시", "해운대구", "중동"),
    ]
    return spark.createDataFrame(rows, "search_text string, road_address string, zipcode string, city string, district string, town string")


def test_address_single_hit_and_drops(spark):
    df = spark.createDataFrame(
        [("서울 중구 한강대로 405", None), ("", None), (None, None), ("서울 중구 한강대로 405", "d")], "cust_address string, __op string"
    )
    out = address.match_addresses(df, ["cust_address"], _ref(spark)).collect()
    assert len(out) == 1
    r = out[0]
    assert (r["full_address"], r["juso_matched_keyword"], r["juso_result_count"], r["juso_quality"]) == (
        "서울 중구 한강대로 405", "서울 중구 한강대로 405", 1, "ok")
    assert (r["city"], r["district"], r["town"], r["zipcode"]) == ("서울특별시", "중구", "봉래동2가", "04320")


def test_address_fallback_and_consensus(spark):
    df = spark.createDataFrame([("서울  중구 세종대로 99 (),",), ("부산 해운대구 C",), ("대구 어딘가",)], "a string")
    out = {r["full_address"]: r for r in address.match_addresses(df, ["a"], _ref(spark)).collect()}
    seoul = out["서울  중구 세종대로 99 (),"]
    # "99" fails, "서울 중구 세종대로" hits two rows that agree on city/district/town (town trimmed) but not road
    assert (seoul["juso_matched_keyword"], seoul["juso_result_count"], seoul["juso_quality"]) == ("서울 중구 세종대로", 2, "ok")
    assert (seoul["town"], seoul["zipcode"], seoul["road_address"]) == ("태평로1가", None, None)
    busan = out["부산 해운대구 C"]
    assert (busan["juso_result_count"], busan["juso_quality"], busan["city"], busan["town"]) == (2, "ambiguous", None, None)
    nf = out["대구 어딘가"]
    assert (nf["juso_result_count"], nf["juso_quality"], nf["juso_matched_keyword"]) == (0, "not_found", "대구 어딘가")


def test_longer_prefixes_than_the_reference_has_change_nothing(spark):
    summary = address.prefix_summary(_ref(spark))
    most = address.longest_prefix(summary)
    assert most == 4 and address.longest_prefix(summary.limit(0)) == 0
    df = spark.createDataFrame([("서울 중구 한강대로 405 " + "길 " * 300,), ("부산 해운대구 C",), ("",)], "a string")
    whole = address.match_addresses(df, ["a"], summary=summary).collect()
    assert sorted(whole) == sorted(address.match_addresses(df, ["a"], summary=summary, max_words=most).collect())
    assert {r["juso_result_count"] for r in address.match_addresses(df, ["a"], summary=summary.limit(0), max_words=0).collect()} == {0}


def test_latest_state_hot_key(spark):
    rows = [("hot", i, "u", f"v{i}") for i in range(2000)] + [("hot", 2000, "d", None), ("k", 1, "c", "a"), ("k", 2, "u", "b")]
    df = spark.createDataFrame(rows, "key string, seq int, __op string, v string").repartition(8)
    out = {r["key"]: (r["seq"], r["v"]) for r in changes.latest_state(df, ["key"], ["seq"]).collect()}
    assert out == {"k": (2, "b")}
    kept = changes.latest_state(df, ["key"], ["seq"], keep_deletes=True).collect()
    assert {r["key"]: r["__op"] for r in kept} == {"hot": "d", "k": "u"}


def test_apply_changes(spark):
    state = spark.createDataFrame([("a", 1, "c", "x"), ("b", 1, "c", "y")], "key string, seq int, __op string, v string")
    batch = spark.createDataFrame([("a", 2, "d", None), ("c", 2, "c", "z")], "key string, seq int, __op string, v string")
    merged = changes.apply_changes(state, batch, ["key"], ["seq"])
    assert {r["key"]: r["v"] for r in changes.live(merged).collect()} == {"b": "y", "c": "z"}
    # an older change that comes late does not bring the deleted key back
    late = spark.createDataFrame([("a", 1, "u", "old"), ("c", 3, "u", "new")], "key string, seq int, __op string, v string")
    again = changes.apply_changes(merged, late, ["key"], ["seq"])
    assert {r["key"]: r["v"] for r in changes.live(again).collect()} == {"b": "y", "c": "new"}
    kept = {r["key"] for r in changes.purge_deletes(again, "seq", 2).collect()}
    assert kept == {"a", "b", "c"} and {r["key"] for r in changes.purge_deletes(again, "seq", 3).collect()} == {"b", "c"}


def test_lookup_first_null_types_and_skip(spark):
    ref = spark.createDataFrame([("1", 1.0, 1, None), ("1", 1.0, 2, "second"), ("2", 2.0, 1, "x")], "k string, d double, ord int, v string")
    df = spark.createDataFrame([(1, "1", False), (2, "2", False), (2, "2", True)], "i int, s string, off boolean")
    by_number = lookup.lookup(df, [F.col("i")], ref, ["d"], "v", "out", order_col="ord", skip=F.col("off"))
    assert sorted((r["i"], r["off"], r["out"]) for r in by_number.collect()) == [(1, False, None), (2, False, "x"), (2, True, None)]
    by_text = lookup.lookup(df, [F.col("s")], ref, ["d"], "v", "out")
    assert {(r["s"], r["out"]) for r in by_text.where(~F.col("off")).collect()} == {("1", "second"), ("2", "x")}


def _skewed(spark, df):
    """The executed plan with broadcasting off and low skew limits."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = df()
        out.collect()
        return out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_hot_lookup_and_address_keys_are_split(spark):
    hot = spark.range(60000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS STRING) END AS k", "id", "repeat('x', 50) AS pad").repartition(12)
    ref = spark.range(5000).selectExpr("CASE WHEN id = 7 THEN 'hot' ELSE CAST(id AS STRING) END AS k", "CAST(id AS STRING) AS v")
    assert "skew=true" in _skewed(spark, lambda: lookup.lookup(hot, [F.col("k")], ref, ["k"], "v", "out"))
    rows = hot.selectExpr("CASE WHEN id % 3 = 0 THEN 'a b c' ELSE concat('a ', k) END AS addr", "concat(id, pad) AS pad")
    places = spark.range(50).selectExpr("concat('a b ', id) AS search_text", "'r' AS road_address", "'z' AS zipcode", "'c' AS city", "'d' AS district", "'t' AS town")
    assert "skew=true" in _skewed(spark, lambda: address.match_addresses(rows, ["addr"], places, keep=["pad"]))


def test_deterministic_protection_never_shares_an_iv(spark):
    import base64

    df = spark.range(500).selectExpr("CAST(id AS STRING) AS x")
    rows = df.select("x", protect.protect("x", KEY, True).alias("c"), protect.reveal(protect.protect("x", KEY, True), KEY).alias("back")).collect()
    assert len({base64.b64decode(r["c"])[:12] for r in rows}) == 500
    assert all(r["x"] == r["back"] for r in rows)


def test_key_is_not_in_explain_output(spark):
    import contextlib
    import io

    from cdcflow.plans.context import Context

    Context(spark=spark, protect_key=KEY)  # redacts
    df = spark.range(3).select(protect.protect(F.col("id").cast("string"), KEY).alias("c"), protect.reveal(F.lit("x"), KEY).alias("r"))
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("extended")
        df.explain("formatted")
    assert KEY not in text.getvalue() and KEY.encode().hex() not in text.getvalue().lower()

