"""Turn one resolved pipeline definition into DataFrames.

``refine`` = source normalisation -> mapping stage -> processed-at stamp; the
result carries ``_reject``.  ``route`` splits it into keyed successes for the
destination and reject records for ``failTopic``.  Nothing here is specific
to batch or streaming: the same plan is used by ``cdcflow.streaming``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcflow.operators import diagnose, envelope, keys, rejects
from cdcflow.operators.mapping import PROCESSED_AT_FIELD
from cdcflow.plans import registry
from cdcflow.plans import samples as _samples  # noqa: F401  (registers the sample mappers)
from cdcflow.plans.context import Context
from cdcflow.sources.topics import DECODE_FAILURE, RAW_VALUE, SEQ_COL

STRUCT_FORMAT = "AVRO"
TOPIC_COLUMNS = {"key", "value", "headers", "timestamp", "topic", "partition", "offset", "batch_id", "writer", RAW_VALUE, DECODE_FAILURE, SEQ_COL}


def sequenced(df: DataFrame) -> DataFrame:
    """Topic records with their offset, where they have one, as the sequence that sinks order a key's records by."""
    if SEQ_COL in df.columns or "offset" not in df.columns:
        return df
    return df.withColumn(SEQ_COL, F.col("offset"))


def normalize_source(df: DataFrame, defn: dict, ctx: Context) -> DataFrame:
    """Choose the envelope reader by group and ``inputFormat``.

    lv1: ``inputFormat`` AVRO (any case) -> struct envelopes, else JSON text.
    api / lv2: flat records; NULL values (tombstones) are dropped and the
    record struct is flattened into columns.
    """
    group = defn.get("group", "lv1")
    if group == "lv1":
        if str(defn.get("inputFormat") or "").upper() == STRUCT_FORMAT:
            return envelope.unwrap_struct(df, now=ctx.now)
        return envelope.unwrap_json(df, now=ctx.now)
    kind = df.schema["value"].dataType.typeName() if "value" in df.columns else None
    if kind in ("string", "binary") and set(df.columns) <= TOPIC_COLUMNS:
        raise ValueError(f"records of {defn.get('sourceTopic')!r} are {kind}: bind the topic with value_schema or avro_schema")
    flat = envelope.drop_tombstones(df, "value")
    if kind == "struct":
        flat = flat.select("key", "value.*", *([SEQ_COL] if SEQ_COL in flat.columns else []))
    return flat


def refine(df: DataFrame, defn: dict, ctx: Context) -> DataFrame:
    group = defn.get("group", "lv1")
    schema = registry.get_schema(defn["schemaName"], group)
    stage = registry.get_mapper(group, defn["mapperName"])(defn, ctx)
    mapped = stage(normalize_source(df, defn, ctx))
    if rejects.REJECT_COL not in mapped.columns:
        mapped = mapped.withColumn(rejects.REJECT_COL, rejects.no_reject())
    return rejects.stamp_processed_at(mapped, PROCESSED_AT_FIELD in schema.fieldNames(), ctx.now)


def undecodable(df: DataFrame, defn: dict) -> tuple[DataFrame, DataFrame | None]:
    """``(rows to refine, dead letters)`` of a topic that was decoded on reading: values that
    did not decode leave for the dead-letter topic with their raw value and headers, the
    last of which says why."""
    if RAW_VALUE not in df.columns:
        return df, None
    kind, fields = df.schema[RAW_VALUE].dataType, df.schema["value"].dataType
    text = isinstance(kind, T.StringType) and isinstance(fields, T.StructType)
    why = diagnose.json_failure(F.col(RAW_VALUE), fields) if text else F.lit(diagnose.NO_DECODE)
    if DECODE_FAILURE in df.columns:
        why = F.coalesce(F.col(DECODE_FAILURE), why)
    dead = rejects.dead_letters(df, RAW_VALUE, "value", defn["sourceTopic"], why).withColumnRenamed(RAW_VALUE, "value").drop(DECODE_FAILURE)
    good = df.where(F.col(RAW_VALUE).isNull() | F.col("value").isNotNull())
    return good.drop(RAW_VALUE, DECODE_FAILURE), dead


def dead_letter_rejects(dead: DataFrame, defn: dict, ctx: Context) -> DataFrame:
    """Dead letters as reject records, for a definition without a dead-letter topic."""
    context = rejects.CTX_STRUCT if str(defn.get("inputFormat") or "").upper() == STRUCT_FORMAT else rejects.CTX_JSON
    why = F.decode(F.element_at("headers", -1)["value"], "UTF-8")
    rej = rejects.reject(F.col("value").cast("string"), why, context, ctx.now)
    return dead.select(F.col("key").cast("string").alias("key"), rej.alias("r")).select("key", "r.*")


@dataclass
class Routed:
    success: DataFrame  # key + target fields (+ the source's sequence)
    rejects: DataFrame  # key (text) + reject record


def route(refined: DataFrame, defn: dict) -> Routed:
    schema = registry.get_schema(defn["schemaName"], defn.get("group"))
    fields = schema.fieldNames()
    seq = [SEQ_COL] if SEQ_COL in refined.columns else []
    good = rejects.successes(refined).select("key", *[F.col(f"`{f}`") for f in fields], *seq)
    bad = rejects.rejects(refined, "key")
    body = good.drop("key")
    if str(defn.get("keyType") or "").lower() == "string":
        keyed = keys.string_key(body, defn.get("primaryKeyFields") or [], defn.get("keyFormat"))
    else:
        keyed = keys.struct_key(body, defn.get("primaryKeyFields") or [])
    return Routed(keyed.select("key", *[F.col(f"`{f}`") for f in fields], *seq), bad)

