"""Every registered query against its DuckDB oracle on the smallest tables."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cdcflow.queries import all_oracles, all_queries, fixtures
from conftest import SF_SMALL
from tools.compare import rows_of

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(all_oracles()) == set(all_queries())
    assert set(all_queries()) <= set(entry.queries()) and set(all_oracles()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    res = con.execute(entry.oracle_sql()[name])
    dnames = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dnames)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(dnames, res.fetchall())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "user_id" in df.columns


TIME_SENSITIVE = ["refine_users", "parse_iso_instant", "parse_epoch_or_iso", "normalize_epoch", "refine_birth",
                  "contract_date_millis", "stamp_processed_at", "map_json_timestamp", "lookup_enrich_compound"]


@pytest.mark.parametrize("conf", [{"spark.sql.session.timeZone": "Asia/Seoul"}, {"spark.sql.ansi.enabled": "false"}])
def test_results_do_not_depend_on_session_settings(spark, con, conf):
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        for name in TIME_SENSITIVE:
            df = entry.queries()[name](spark, SF_SMALL)
            res = con.execute(entry.oracle_sql()[name])
            dnames = [d[0] for d in res.description]
            assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(dnames, res.fetchall()), name
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_the_user_feed_of_one_file_is_derived_by_several_tasks(spark, tmp_path):
    n = F.col("id")
    rows = spark.range(0, 120000, 1, 1).select(n.alias("c_custkey"), F.md5(n.cast("string")).alias("c_name"), F.lit(1).alias("c_nationkey"),
                                               F.rand(1).alias("c_acctbal"), F.md5(F.reverse(n.cast("string"))).alias("c_mktsegment"))
    rows.write.parquet(f"{tmp_path}/customer.parquet")
    spark.sql("SELECT 1 AS n_nationkey, 'N' AS n_name, 1 AS n_regionkey").write.parquet(f"{tmp_path}/nation.parquet")
    spark.sql("SELECT 1 AS r_regionkey, 'R' AS r_name").write.parquet(f"{tmp_path}/region.parquet")
    feed = fixtures.user_feed(spark, str(tmp_path)).select(F.spark_partition_id().alias("task"), "value")
    per = {r.task: r.n for r in feed.where("length(value) > 0").groupBy("task").agg(F.count("value").alias("n")).collect()}
    assert sum(per.values()) == 120000 and len(per) >= 2
