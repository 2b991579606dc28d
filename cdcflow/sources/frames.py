"""Schema-registry frames: a zero byte, a four-byte schema id, then the encoded record.

Values of one topic may be written with several schemas.  ``decode`` reads the id
with built-in binary functions and gives each row to its id's decoder (rows of other
ids are not touched by it); every decoder must return the same struct, as Avro does
when it is given the reader's schema beside the writer's.  Values without a frame, of
an id that is not known, or whose body does not decode keep a NULL value and say why
in ``_decode_failure``; tombstones stay NULL without a failure.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAGIC = "00"       # the first byte, as hex digits
ID_BYTES = 4
HEAD = 1 + ID_BYTES


def framed(body: Column, schema_id: int) -> Column:
    """``body`` (binary) in a frame; NULL stays NULL."""
    if not 0 <= schema_id < 1 << 31:
        raise ValueError(f"schema id {schema_id} is out of range")
    return F.concat(F.unhex(F.lit(f"{MAGIC}{schema_id:08X}")), body)


def has_frame(value: Column) -> Column:
    """The value is long enough for a frame and starts like one."""
    return (F.octet_length(value) >= HEAD) & (F.hex(F.substring(value, 1, 1)) == MAGIC)


def schema_id(value: Column) -> Column:
    """The schema id of a framed value, else NULL."""
    return F.when(has_frame(value), F.conv(F.hex(F.substring(value, 2, ID_BYTES)), 16, 10).cast("bigint"))


def body(value: Column) -> Column:
    """What follows the frame's head, else NULL."""
    return F.when(has_frame(value), value.substr(F.lit(HEAD + 1), F.octet_length(value)))


def decode(df: DataFrame, decoders: Mapping[int, Callable[[Column], Column]], raw: str, failure: str, value_col: str = "value") -> DataFrame:
    """Decode framed values; ``raw`` keeps the bytes, ``failure`` says why a value has no record."""
    if not decoders:
        raise ValueError("no schema is known: every value would be a dead letter")
    src = df.withColumn(raw, F.col(value_col)).withColumn("_schema_id", schema_id(F.col(value_col)))
    sid, payload = F.col("_schema_id"), body(F.col(raw))
    value = None
    for i, read in sorted(decoders.items()):
        value = F.when(sid == i, read(payload)) if value is None else value.when(sid == i, read(payload))
    out = src.withColumn(value_col, value)
    why = (
        F.when(F.col(raw).isNull() | F.col(value_col).isNotNull(), F.lit(None).cast("string"))
        .when(sid.isNull(), F.lit("the value has no schema-registry frame"))
        .when(~sid.isin(sorted(decoders)), F.concat(F.lit("schema id "), sid.cast("string"), F.lit(" is not known")))
        .otherwise(F.concat(F.lit("the record does not decode with schema id "), sid.cast("string")))
    )
    return out.withColumn(failure, why).drop("_schema_id")


def avro_decoders(schemas: Mapping[int, str], reader: str | None = None) -> dict[int, Callable[[Column], Column]]:
    """Decoders for Avro bodies by writer schema id; records are read as ``reader`` (default: the
    greatest id's schema).  Needs the ``spark-avro`` package on the class path."""
    try:
        from pyspark.sql.avro.functions import from_avro
    except ImportError as e:  # pragma: no cover - depends on the installation
        raise RuntimeError("Avro decoding needs the spark-avro package") from e
    read_as = reader or schemas[max(schemas)]
    return {i: (lambda c, w=w: from_avro(c, w, {"mode": "PERMISSIVE", "avroSchema": read_as})) for i, w in schemas.items()}


def avro_framed(record: Column, schema: str, schema_id_: int) -> Column:
    """A record as framed Avro bytes.  Needs the ``spark-avro`` package on the class path."""
    try:
        from pyspark.sql.avro.functions import to_avro
    except ImportError as e:  # pragma: no cover - depends on the installation
        raise RuntimeError("Avro encoding needs the spark-avro package") from e
    return framed(to_avro(record, schema), schema_id_)
