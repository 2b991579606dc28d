"""File topics with a commit log: keyed partitions, offsets, and replays that are read once.

Layout below the topic's path::

    data/writer=<w>/batch_id=<n>/partition=<p>/...   the rows of one batch of one writer
    log/<commit>~<writer>~<batch>.json               one small file per committed batch

A batch is written first and then committed by its log file, which appears whole or
not at all.  Readers go by the log only, so an attempt that died, or one under way,
is not seen; a batch that the log has already is not written again.  The stream of
a topic is the stream of its log; a micro-batch reads the folders it names.

Rows are dealt to ``partitions`` by the hash of their key and sorted inside by the
source's sequence (``_seq``), if they carry one.  Readers get ``partition`` and
``offset`` beside ``key`` and ``value``: the offset grows with the commit and, inside
one, with the place in the partition, so it orders the records of a key as they were
written.  One driver writes a topic; its threads take turns at the log.
"""

from __future__ import annotations

import json
import threading
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcflow.sources import files

SEQ_COL = "_seq"          # the source's sequence, carried through refinement
PLACE = "_place"
BITS = 32                 # of an offset that count places within a commit
ENTRY = T.StructType([T.StructField("log_commit", T.LongType()), T.StructField("log_writer", T.StringType()),
                      T.StructField("log_batch", T.LongType()), T.StructField("log_path", T.StringType())])
_LOCKS: dict[str, threading.Lock] = defaultdict(threading.Lock)


def is_log(df: DataFrame) -> bool:
    return set(df.columns) == set(ENTRY.fieldNames())


def _safe(name: str) -> str:
    return "".join(c if c.isalnum() or c in "-_." else "_" for c in name) or "default"


def committed(spark: SparkSession, path: str) -> dict[tuple[str, int], int]:
    """``(writer, batch) -> commit`` of a topic, from the names in its log."""
    out = {}
    for name in files.names(spark, f"{path}/log"):
        parts = name.removesuffix(".json").split("~")
        if name.endswith(".json") and len(parts) == 3:
            out[parts[1], int(parts[2])] = int(parts[0])
    return out


def write(df: DataFrame, path: str, fmt: str, options: dict, partitions: int, writer: str, batch_id: int) -> bool:
    """Write and commit one batch of ``key`` and ``value`` (and ``_seq``); false if it was committed before."""
    spark, writer = df.sparkSession, _safe(writer)
    if (writer, batch_id) in committed(spark, path):
        return False
    order = ["partition", SEQ_COL] if SEQ_COL in df.columns else ["partition"]
    dealt = df.repartition(partitions, "key").withColumn("partition", F.spark_partition_id()).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias(PLACE)
    folder = f"data/writer={writer}/batch_id={batch_id}"
    rows = dealt.select("key", "value", place, "partition")
    rows.write.mode("overwrite").partitionBy("partition").format(fmt).options(**options).save(f"{path}/{folder}")
    with _LOCKS[path]:
        commit = max(committed(spark, path).values(), default=-1) + 1
        entry = {"log_commit": commit, "log_writer": writer, "log_batch": batch_id, "log_path": folder}
        return files.write_once(spark, f"{path}/log/{commit:012d}~{writer}~{batch_id}.json", json.dumps(entry))


def read_log(spark: SparkSession, path: str, options: dict, streaming: bool) -> DataFrame:
    reader = spark.readStream.options(**{k: v for k, v in options.items() if k.lower().startswith("max")}) if streaming else spark.read
    return reader.schema(ENTRY).json(f"{path}/log")


def expand(entries: DataFrame, path: str, fmt: str, options: dict, schema: T.StructType | str | None = None) -> DataFrame | None:
    """The records of some commits, with ``partition`` and ``offset``; ``None`` if there are no commits."""
    spark = entries.sparkSession
    found = entries.select(*ENTRY.fieldNames()).collect()  # a short row per commit
    if not found:
        return None
    reader = spark.read.format(fmt).options(**options).option("basePath", f"{path}/data")
    if schema is not None:
        fields = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        more = [T.StructField(PLACE, T.LongType()), T.StructField("writer", T.StringType()), T.StructField("batch_id", T.LongType()), T.StructField("partition", T.IntegerType())]
        reader = reader.schema(T.StructType([*[f for f in fields.fields if f.name in ("key", "value")], *more]))
    rows = reader.load([f"{path}/{r.log_path}" for r in found])
    commits = spark.createDataFrame([(r.log_writer, r.log_batch, r.log_commit) for r in found], "w string, b long, c long")
    joined = rows.join(commits, (F.col("writer").cast("string") == F.col("w")) & (F.col("batch_id") == F.col("b")))
    return joined.select("key", "value", F.col("partition").cast("int").alias("partition"),
                         (F.shiftleft(F.col("c"), BITS) + F.col(PLACE)).alias("offset"))


def empty(spark: SparkSession, schema: T.StructType | str | None) -> DataFrame:
    fields = T.StructType.fromDDL("key string, value string") if schema is None else schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    return spark.createDataFrame([], T.StructType([*[f for f in fields.fields if f.name in ("key", "value")], T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType())]))
