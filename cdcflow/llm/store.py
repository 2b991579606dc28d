"""Written intermediate tables in the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from cdcflow.session import ensure_checkpoint_dir


#: Texts travel to Python workers in batches of about so many bytes, as Spark's 10,000 rows may be of any size.
BATCH_CONF, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20

#: Whether a query's shuffle files go when it ends (Spark 4.1; other versions ignore it).
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors once per application, wherever the driver found it,
    and bound the session's batches (but for an application that says how large they are)."""
    sc = spark.sparkContext
    if not sc.getConf().contains(BATCH_CONF):
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))
    if sc.applicationId not in _SHIPPED:
        _SHIPPED.add(sc.applicationId)
        root = Path(__file__).resolve().parents[1]
        path = os.path.join(tempfile.mkdtemp(prefix="llm-code-"), f"{root.name}.zip")
        with zipfile.ZipFile(path, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f"{root.name}/{f.relative_to(root)}")
        sc.addPyFile(path)
    return spark


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back.

    Cuts lineage with files every executor sees, so a lost executor costs only
    its running tasks, and later reads are column pruned.  The shuffles of the write
    are deleted when it ends, not when the driver collects its garbage.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP_CONF, "false")
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP_CONF, before)
    return spark.read.schema(df.schema).parquet(path)


def housed(d: DataFrame, classes: DataFrame, keyed, schema: str) -> tuple[DataFrame, DataFrame]:
    """Where the text of every class is: ``(key, doc_id)`` and the rows to look it up in.

    ``classes`` has ``key`` and ``doc``, the least id of its rows, NULL where none has an
    id.  Rows without an id are found by a number made of their text; ``keyed`` maps
    rows of ``doc_id, text`` to ``doc_id, key`` (``schema``).
    """
    from pyspark.sql import functions as F

    homes = classes.select("key", F.col("doc").alias("doc_id"))
    without = d.where("doc_id IS NULL")
    if without.isEmpty():
        return homes, d
    number = -1 - F.xxhash64("text").bitwiseAND(F.lit((1 << 62) - 1))
    made = without.select(number.alias("doc_id"), "text").mapInArrow(keyed, schema).where("key IS NOT NULL")
    made = made.groupBy("key").agg(F.min("doc_id").alias("number"))
    homes = homes.join(made, "key", "left").select("key", F.coalesce("doc_id", "number").alias("doc_id"))
    return homes, d.select(F.coalesce("doc_id", number).alias("doc_id"), "text")


def carried(docs: DataFrame, run, fields: str, *inputs) -> DataFrame:
    """``row`` (all columns of ``docs`` as a struct, whatever their names) plus ``fields``
    that ``run`` computes: it maps a record batch of ``inputs`` to a list of arrays."""
    import pyarrow as pa
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    added = T.StructType.fromDDL(fields)
    names = ["row", *added.names]

    def each(batches):
        for batch in batches:
            part = pa.RecordBatch.from_arrays(batch.columns[1:], names=batch.schema.names[1:])
            yield pa.RecordBatch.from_arrays([batch.column(0), *run(part)], names=names)

    given = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), *inputs)
    return given.mapInArrow(each, T.StructType([T.StructField("row", given.schema["row"].dataType), *added.fields]))
