import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cdcflow-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="cdcflow-test-")


def one(spark, col, value=None, schema="x string"):
    """Evaluate a Column over a one-row DataFrame (column ``x`` holds ``value``)."""
    df = spark.createDataFrame([(value,)], schema)
    return df.select(col.alias("r")).collect()[0]["r"]


def many(spark, fn, values, schema="x string"):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, " + schema)
    rows = df.select("i", fn(F.col("x")).alias("r")).collect()
    return [r["r"] for r in sorted(rows, key=lambda r: r["i"])]
