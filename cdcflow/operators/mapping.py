"""Declarative field mapping onto a declared target schema.

A ``Mapping`` is an ordered list of ``Rule(output, build)``; ``build`` turns a
``Record`` (how to read the input row) into a Column.  ``Mapping.apply``
compiles every rule into one ``select``, so Catalyst prunes and collapses the
projection and the whole mapping runs in generated code.

* A NULL rule result leaves the field unset: NULL, or the field's declared default
  (``default`` in the metadata of the schema's field).
* A value that does not fit its field's declared type turns the row into a reject
  with context ``field_mapping`` that names field and value (``operators.typed``);
  it never fails the job.
* An output that the target schema does not declare is an error at plan time.
* A non-nullable target field that ends up NULL turns the row into a reject
  with context ``field_mapping`` (deviation: the original crashes at write).
* A target that declares ``__op`` receives the input's ``__op``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcflow.functions import idfn, jsonval, text, timefn
from cdcflow.operators import typed
from cdcflow.operators.rejects import CTX_MAPPING, REJECT_COL, add_reject, reject
from cdcflow.sources.topiclog import SEQ_COL

OP_FIELD = "__op"
PROCESSED_AT_FIELD = "__processed_at"


@dataclass
class Record:
    """How rules read the input row.

    ``data``: VARIANT column with the JSON row image (JSON rules).
    ``columns``: names of plain input columns (struct rules read them).
    ``params``: the pipeline definition's parameters (``channel`` etc.).
    """

    data: Column | None = None
    columns: frozenset[str] = frozenset()
    params: dict = field(default_factory=dict)
    texts: dict[str, str] = field(default_factory=dict)

    def text(self, name: str) -> Column:
        """Value-to-text of JSON field ``name``.

        Every field is extracted once, in a projection below the mapping
        (``Mapping.apply``), and rules refer to that column.  This keeps the
        generated code small however many rules read the same field.
        """
        if name not in self.texts:
            self.texts[name] = f"_t{len(self.texts)}"
        return F.col(self.texts[name])

    def has(self, name: str) -> bool:
        return name in self.columns

    def col(self, name: str) -> Column | None:
        return F.col(f"`{name}`") if name in self.columns else None


@dataclass(frozen=True)
class Rule:
    output: str
    build: Callable[[Record], Column]


# --- JSON rules ------------------------------------------------------------

def json_string(output: str, name: str) -> Rule:
    return Rule(output, lambda r: r.text(name))


def json_cleansed(output: str, name: str, kind: str) -> Rule:
    return Rule(output, lambda r: text.cleanse(kind, r.text(name)))


def json_cleansed_name(output: str, name: str) -> Rule:
    return json_cleansed(output, name, "name")


def json_cleansed_phone(output: str, name: str) -> Rule:
    return json_cleansed(output, name, "tel_no")


def json_cleansed_email(output: str, name: str) -> Rule:
    return json_cleansed(output, name, "email")


def json_cleansed_address(output: str, name: str) -> Rule:
    return json_cleansed(output, name, "address")


def json_timestamp(output: str, name: str) -> Rule:
    return Rule(output, lambda r: timefn.parse_timestamp(r.data, name, r.text(name)))


def json_boolean(output: str, name: str) -> Rule:
    """Only ``Y``/``true`` are true; ``1`` is false here (unlike ``json_boolean_default``)."""
    return Rule(output, lambda r: idfn.yn_to_boolean(r.text(name)))


def json_boolean_default(output: str, name: str, default: bool) -> Rule:
    return Rule(output, lambda r: idfn.as_boolean(r.text(name), default))


def json_instant(output: str, name: str) -> Rule:
    return Rule(output, lambda r: timefn.parse_instant(r.text(name)))


# --- struct (decoded record) rules ------------------------------------------

def _null() -> Column:
    return F.lit(None)


def struct_string(output: str, name: str) -> Rule:
    """Field as text; a field missing from the input schema reads NULL."""
    return Rule(output, lambda r: r.col(name).cast("string") if r.has(name) else _null().cast("string"))


def struct_value(output: str, name: str) -> Rule:
    """Field as is (boolean, long, ...); missing from the input schema -> NULL."""
    return Rule(output, lambda r: r.col(name) if r.has(name) else _null())


struct_boolean = struct_value
struct_long = struct_value


def channel(output: str, configured: str | None = None) -> Rule:
    """Configured channel wins; else the record's ``channel``; else NULL."""

    def build(r: Record) -> Column:
        conf = configured if configured is not None else r.params.get("channel")
        if conf is not None:
            return F.lit(conf)
        return r.col("channel").cast("string") if r.has("channel") else _null().cast("string")

    return Rule(output, build)


def custom(output: str, build: Callable[[Record], Column]) -> Rule:
    return Rule(output, build)


def full_name(output: str, first: str, last: str) -> Rule:
    """first + ' ' + last, NULL parts skipped, trimmed; blank -> NULL."""

    def build(r: Record) -> Column:
        a = r.col(first).cast("string") if r.has(first) else _null().cast("string")
        b = r.col(last).cast("string") if r.has(last) else _null().cast("string")
        joined = F.concat(F.coalesce(a, F.lit("")), F.when(b.isNotNull(), F.concat(F.lit(" "), b)).otherwise(F.lit("")))
        t = text.java_trim(joined)
        return F.when(t != "", t)

    return Rule(output, build)


# --- the mapping -----------------------------------------------------------

class Mapping:
    """Ordered rules compiled against a declared ``StructType``."""

    def __init__(self, name: str, schema: T.StructType | str, rules: Sequence[Rule]):
        self.name = name
        self.schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        self.rules = list(rules)
        declared = set(self.schema.fieldNames())
        for r in self.rules:
            if r.output not in declared:
                raise ValueError(f"mapping {name!r}: output field {r.output!r} is not declared in the target schema")

    def declares(self, name: str) -> bool:
        return name in self.schema.fieldNames()

    def columns(self, rec: Record) -> list[Column]:
        """What the rules give for each declared field, in its own type."""
        by_name = {r.output: r for r in self.rules}
        cols = []
        for f in self.schema.fields:
            if f.name in by_name:
                c = by_name[f.name].build(rec)
            elif f.name == OP_FIELD and rec.has(OP_FIELD):
                c = F.col(OP_FIELD)
            else:
                c = F.lit(None)
            cols.append(c)
        return cols

    @staticmethod
    def _value(c: Column, have: T.DataType, f: T.StructField) -> Column:
        out = typed.converted(c, have, f.dataType)
        if "default" in f.metadata:
            out = F.when(c.isNull(), F.lit(f.metadata["default"]).cast(f.dataType)).otherwise(out)
        return out.alias(f.name)

    def apply(
        self,
        df: DataFrame,
        data_col: str | None = "data",
        params: dict | None = None,
        keep: Sequence[str] = ("key",),
        payload: Column | None = None,
        now=None,
    ) -> DataFrame:
        """Map every row; keep ``keep`` columns and the reject column alongside.

        Rows already rejected pass through with NULL fields.  ``payload`` is
        the reject payload for mapping failures (default: the input as JSON).
        """
        cols = frozenset(df.columns)
        data = F.col(data_col) if data_col else None
        rec = Record(data=data, columns=cols, params=params or {})
        if payload is None:
            payload = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns if c != REJECT_COL and df.schema[c].dataType.typeName() != "variant"]))
        elif not isinstance(df.select(payload).schema[0].dataType, T.StringType):
            payload = F.to_json(payload)  # a decoded record: JSON, not a printed struct
        passthrough = [F.col(f"`{k}`") for k in dict.fromkeys([*keep, SEQ_COL]) if k in cols and not self.declares(k)]
        rej = F.col(REJECT_COL) if REJECT_COL in cols else F.lit(None)
        given = self.columns(rec)  # registers the JSON fields the rules read
        if rec.texts:
            df = jsonval.with_texts(df, data, rec.texts)
        fields = self.schema.fields
        types = [f.dataType for f in df.select(*[c.alias(f"_v{i}") for i, c in enumerate(given)]).schema.fields]
        checked = [typed.misfit(F.col(f"_v{i}"), have, f.dataType) for i, (f, have) in enumerate(zip(fields, types))]
        if all(m is None for m in checked):
            values = [self._value(c, have, f) for c, have, f in zip(given, types, fields)]
            mapped = df.select(*passthrough, *values, rej.alias(REJECT_COL), payload.alias("_payload"))
        else:
            # rule results once each below, checks and conversions above them
            below = [c.alias(f"_v{i}") for i, c in enumerate(given)]
            mapped = df.select(*passthrough, *below, rej.alias(REJECT_COL), payload.alias("_payload"))
            whys = [F.when(m, typed.reason(f.name, F.col(f"_v{i}"), types[i], f.dataType)) for i, (f, m) in enumerate(zip(fields, checked)) if m is not None]
            values = [self._value(F.col(f"_v{i}"), types[i], f) for i, f in enumerate(fields)]
            mapped = mapped.select(*passthrough, *values, REJECT_COL, "_payload", F.coalesce(*whys).alias("_why"))
            mapped = add_reject(mapped, F.col("_why").isNotNull(), reject(F.col("_payload"), F.col("_why"), CTX_MAPPING, now)).drop("_why")
        for f in self.schema.fields:
            if not f.nullable and f.name != PROCESSED_AT_FIELD:
                mapped = add_reject(
                    mapped,
                    F.col(f"`{f.name}`").isNull(),
                    reject(F.col("_payload"), f"Failed to apply mapping rule for field '{f.name}': required value is null", CTX_MAPPING, now),
                )
        return mapped.drop("_payload")
