"""Apply a change feed: the latest state per key, deletes removed.

``latest_state`` keeps, for every key, the change with the greatest ordering
value and drops the key when that change is a delete.  It is written as a
grouped ``max_by`` rather than ``row_number()`` over a window: the aggregate
runs partially on the map side, so a key holding a third of all changes is
reduced to one row per task before the shuffle instead of being sorted in a
single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcflow.operators.envelope import DELETE_OP


def latest_state(
    df: DataFrame,
    key_cols: Sequence[str],
    order_cols: Sequence[str],
    op_col: str = "__op",
    keep_deletes: bool = False,
) -> DataFrame:
    """Latest change per key by ``order_cols`` (ties must be broken by the caller's
    order columns, e.g. a sequence number); deletes remove the key."""
    others = [c for c in df.columns if c not in key_cols]
    order = F.struct(*[F.col(f"`{c}`") for c in order_cols])
    row = F.struct(*[F.col(f"`{c}`") for c in others])
    latest = df.groupBy(*[F.col(f"`{k}`") for k in key_cols]).agg(F.max_by(row, order).alias("_last"))
    out = latest.select(*[F.col(f"`{k}`") for k in key_cols], "_last.*")
    if keep_deletes:
        return out
    return live(out, op_col)


def apply_changes(
    state: DataFrame | None,
    changes: DataFrame,
    key_cols: Sequence[str],
    order_cols: Sequence[str],
    op_col: str = "__op",
) -> DataFrame:
    """Merge a batch of changes into a materialised state (same columns).

    The state keeps deleted keys with their order values, so a late, older
    change cannot bring a key back; read it through ``live``.
    """
    merged = changes if state is None else state.unionByName(changes, allowMissingColumns=True)
    return latest_state(merged, key_cols, order_cols, op_col, keep_deletes=True)


def live(state: DataFrame, op_col: str = "__op") -> DataFrame:
    """The rows of a state that are not deleted."""
    op = F.lower(F.col(f"`{op_col}`").cast("string"))
    return state.where(op.isNull() | (op != DELETE_OP))


def purge_deletes(state: DataFrame, order_col: str, before, op_col: str = "__op") -> DataFrame:
    """Forget deletes ordered before ``before``: changes older than that must not arrive any more."""
    op = F.lower(F.col(f"`{op_col}`").cast("string"))
    forget = (op == DELETE_OP) & (F.col(f"`{order_col}`") < F.lit(before))
    return state.where(~F.coalesce(forget, F.lit(False)))


def _key_field(df: DataFrame, name: str, kind: T.DataType, key_cols: Sequence[str], key_col: str) -> Column:
    """Key field ``name`` as the record's own key has it, in type ``kind``."""
    have = df.schema[key_col].dataType
    key = F.col(f"`{key_col}`")
    if isinstance(have, T.StructType):
        if name not in have.fieldNames():
            raise ValueError(f"the record key has no field {name!r}")
        return key[name].cast(kind)
    if len(key_cols) == 1:
        # a text key is the value itself, or a JSON object of it
        inner = F.get_json_object(key.cast("string"), f"$['{name}']") if isinstance(have, T.StringType) else F.lit(None)
        return F.coalesce(F.when(key.cast("string").startswith("{"), inner.try_cast(kind)), key.try_cast(kind))
    if not isinstance(have, T.StringType):
        raise ValueError(f"a key of {len(key_cols)} fields must be a struct or JSON text, not {have.simpleString()}")
    return F.get_json_object(key, f"$['{name}']").try_cast(kind)


def keyed_changes(
    topic: DataFrame,
    key_cols: Sequence[str],
    order_cols: Sequence[str],
    key_col: str = "key",
    value_col: str = "value",
    op_col: str = "__op",
) -> DataFrame:
    """Records of a keyed topic (``key``, ``value`` struct or NULL) as changes.

    A record without a value is a tombstone: it deletes its key.  It has no image
    to order it by, so the order columns are columns of the topic (an offset, the
    source's timestamp or sequence), beside key and value.  Key fields come from
    the value, or from the record's key where there is none; a key column that the
    value lacks always comes from the record's key.
    """
    kind = topic.schema[value_col].dataType
    if not isinstance(kind, T.StructType):
        raise ValueError(f"changes need a decoded value, not {kind.simpleString()}: bind the topic with value_schema or avro_schema")
    lost = [c for c in order_cols if c not in topic.columns]
    if lost:
        raise ValueError(f"order column(s) {lost} are not columns of the topic: a tombstone has no value to take them from")
    value = F.col(f"`{value_col}`")
    gone = value.isNull()
    types = {f.name: f.dataType for f in kind.fields}
    keys = []
    for k in key_cols:
        own = _key_field(topic, k, types.get(k, T.StringType()), key_cols, key_col) if key_col in topic.columns else F.lit(None)
        keys.append((F.when(gone, own).otherwise(value[k]) if k in types else own).alias(k))
    taken = {*key_cols, *order_cols, op_col}
    op = F.when(gone, F.lit(DELETE_OP)).otherwise(value[op_col].cast("string") if op_col in types else F.lit(None))
    fields = [value[n].alias(n) for n in types if n not in taken]
    return topic.select(*keys, *[F.col(f"`{c}`") for c in order_cols], op.alias(op_col), *fields)
