"""Topic bindings: logical topic name -> Spark source / sink.

A binding says where a topic lives: ``format`` (``kafka``, ``parquet``,
``json``, ``delta`` ... anything Spark can read) plus ``path`` and
``options``.  Kafka topics yield ``key``/``value`` as text (JSON values) or
binary (Avro); file topics hold ``key`` + ``value`` columns directly.

Decoding happens here and nowhere else: a binding with ``value_schema`` turns
JSON text values into structs, one with ``avro_schema`` Avro bytes (with
``from_avro``, when the package is on the class path).  The undecoded value stays
beside the decoded one as ``_raw_value``; rows that don't decode have a NULL value
and are told apart from tombstones by it (see ``rejects.dead_letters``).

Start position and delivery: Kafka sources start at ``latest`` unless the
binding says otherwise (the streaming checkpoint then owns the offsets);
file sources process files not yet seen by the checkpoint.  Sinks are
at-least-once, but for file topics with a commit log (``log: true``), whose readers
see every batch once and get partitions and offsets (``topiclog``).  Without a log a
replayed micro-batch overwrites its folder, so a reader of the finished topic sees
it once, but a streaming reader that had already taken the first attempt's files
takes the new ones too: order by the record's own sequence downstream
(``changes.apply_changes`` is unaffected).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcflow.sources import frames, topiclog
from cdcflow.sources.topiclog import SEQ_COL

KAFKA = "kafka"
DEFAULT_STARTING_OFFSETS = "latest"


@dataclass
class TopicBinding:
    format: str = "parquet"
    path: str | None = None
    options: dict = field(default_factory=dict)
    schema: T.StructType | str | None = None  # required for streaming file sources
    value_format: str = "json"  # kafka only: json text or avro
    value_schema: T.StructType | str | None = None  # decodes JSON text values
    avro_schema: str | None = None  # decodes Avro binary values; with schemas by id: the reader's
    avro_schemas: dict[int, str] | None = None  # writer schemas by registry id: values are framed (``frames``)
    schema_id: int | None = None  # Kafka sinks: write framed Avro of ``avro_schema`` under this id
    log: bool = False  # file topics: commit log, keyed partitions and offsets (``topiclog``)
    partitions: int = 8  # of a topic with a log


def _binding(bindings: dict, topic: str) -> TopicBinding:
    b = bindings.get(topic)
    if b is None:
        raise KeyError(f"topic {topic!r} is not bound to a source")
    return b if isinstance(b, TopicBinding) else TopicBinding(**b)


RAW_VALUE = "_raw_value"
DECODE_FAILURE = "_decode_failure"  # why a value did not decode, where the decoder says so


def decode_json_value(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """JSON text values into structs; text that does not fit the schema gives NULL."""
    fields = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    corrupt = "_corrupt_value"
    wide = T.StructType([*fields.fields, T.StructField(corrupt, T.StringType())])
    text = F.col("value").cast("string")
    read = F.from_json(text, wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    out = df.withColumn(RAW_VALUE, F.col("value")).withColumn("value", read)
    value = F.struct(*[F.col("value")[f.name].alias(f.name) for f in fields.fields])
    return out.withColumn("value", F.when(F.col("value").isNotNull() & F.col("value")[corrupt].isNull(), value))


def decoded(df: DataFrame, b: TopicBinding) -> DataFrame:
    """The topic with its values decoded as the binding says; struct values stay."""
    if "value" not in df.columns or isinstance(df.schema["value"].dataType, T.StructType):
        return df
    if b.avro_schemas:
        return frames.decode(df, frames.avro_decoders(b.avro_schemas, b.avro_schema), RAW_VALUE, DECODE_FAILURE)
    if b.avro_schema:
        return decode_avro_value(df, b.avro_schema)
    return decode_json_value(df, b.value_schema) if b.value_schema else df


def read_topic(spark: SparkSession, topic: str, bindings: dict, streaming: bool = False) -> DataFrame:
    """DataFrame of ``key`` + ``value`` (+ ``headers``/``timestamp`` for Kafka), decoded.

    The stream of a topic with a commit log is its log: give each micro-batch to ``opened``.
    """
    b = _binding(bindings, topic)
    if b.log:
        entries = topiclog.read_log(spark, b.path, b.options, streaming)
        return entries if streaming else opened(entries, topic, bindings)
    return decoded(_read_raw(spark, topic, b, streaming), b)


def opened(batch: DataFrame, topic: str, bindings: dict) -> DataFrame:
    """A micro-batch as records: the commits of a topic's log are read and decoded, records stay as they are."""
    if not topiclog.is_log(batch):
        return batch
    b = _binding(bindings, topic)
    options = {k: v for k, v in b.options.items() if not k.lower().startswith("max")}
    rows = topiclog.expand(batch, b.path, b.format, options, b.schema)
    return decoded(topiclog.empty(batch.sparkSession, b.schema) if rows is None else rows, b)


def _read_raw(spark: SparkSession, topic: str, b: TopicBinding, streaming: bool) -> DataFrame:
    if b.format == KAFKA:
        opts = {"subscribe": topic, "startingOffsets": DEFAULT_STARTING_OFFSETS, "includeHeaders": "true", **b.options}
        reader = spark.readStream if streaming else spark.read
        if not streaming:
            opts.pop("startingOffsets", None)
        raw = reader.format(KAFKA).options(**opts).load()
        if b.value_format == "avro" or b.avro_schemas:
            return raw.select("key", "value", "headers", "timestamp", "topic", "partition", "offset")
        return raw.select(
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
            "headers", "timestamp", "topic", "partition", "offset",
        )
    if streaming:
        schema = b.schema
        if schema is None:
            try:
                schema = spark.read.format(b.format).options(**b.options).load(b.path).schema
            except Exception as e:  # noqa: BLE001
                raise ValueError(
                    f"topic {topic!r}: no data at {b.path} to take a schema from; declare 'schema' in its binding"
                ) from e
        return spark.readStream.format(b.format).schema(schema).options(**b.options).load(b.path)
    return spark.read.format(b.format).options(**b.options).load(b.path)


def write_topic(
    df: DataFrame, topic: str, bindings: dict, batch_id: int | None = None, writer: str | None = None
) -> None:
    """Write a batch (e.g. one micro-batch) of ``key`` + record columns to a topic.

    Kafka: key and value serialised as JSON text.  Files: ``key`` + ``value``
    struct; a micro-batch goes to its own folder ``writer=<pipeline>/batch_id=<n>``,
    overwritten on replay, so a retried micro-batch never duplicates output and
    several pipelines can write one topic.
    """
    b = _binding(bindings, topic)
    seq = SEQ_COL in df.columns
    fields = [c for c in df.columns if c not in ("key", SEQ_COL)]
    if b.format == KAFKA:
        if seq:  # records of a key leave in the source's order
            df = df.repartition(F.col("key")).sortWithinPartitions(SEQ_COL)
        key_is_struct = isinstance(df.schema["key"].dataType, T.StructType)
        key = F.to_json(F.col("key")) if key_is_struct else F.col("key").cast("string")
        record = F.struct(*[F.col(f"`{c}`") for c in fields])
        value = F.to_json(record) if b.schema_id is None else frames.avro_framed(record, b.avro_schema, b.schema_id)
        out = df.select(key.alias("key"), value.alias("value"))
        out.write.format(KAFKA).options(topic=topic, **b.options).save()
        return
    body = F.col("value") if "value" in df.columns else F.struct(*[F.col(f"`{c}`") for c in fields])
    path = b.path
    if b.log:
        if batch_id is None:
            raise ValueError(f"topic {topic!r} keeps a commit log: name the batch that is written")
        out = df.select("key", body.alias("value"), *([SEQ_COL] if seq else []))
        topiclog.write(out, path, b.format, b.options, b.partitions, writer or "default", batch_id)
        return
    out = df.drop(SEQ_COL) if "value" in df.columns else df.select("key", body.alias("value"))
    if batch_id is not None:
        path = f"{path}/writer={writer or 'default'}/batch_id={batch_id}"
    out.write.mode("overwrite" if batch_id is not None else "append").format(b.format).options(**b.options).save(path)


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """A keyed reference table over JDBC, read in parallel ranges when a numeric
    partition column is given (one connection per task, not per record)."""
    if partition_column is not None:
        return spark.read.jdbc(
            url, table, column=partition_column, lowerBound=lower_bound, upperBound=upper_bound,
            numPartitions=num_partitions or spark.sparkContext.defaultParallelism, properties=properties or {},
        )
    return spark.read.jdbc(url, table, properties=properties or {})


def decode_avro_value(df: DataFrame, avro_schema_json: str, value_col: str = "value", out: str = "value") -> DataFrame:
    """Decode Avro bytes into a struct envelope with ``from_avro`` (PERMISSIVE:
    undecodable bytes become NULL, see ``rejects.dead_letters``).

    Needs the ``spark-avro`` package on the class path; it is not bundled here,
    so the import is checked at call time.
    """
    try:
        from pyspark.sql.avro.functions import from_avro
    except ImportError as e:  # pragma: no cover - depends on the installation
        raise RuntimeError("Avro decoding needs the spark-avro package") from e
    decoded = from_avro(F.col(value_col), avro_schema_json, {"mode": "PERMISSIVE"})
    return df.withColumn(RAW_VALUE, F.col(value_col)).withColumn(out, decoded)
