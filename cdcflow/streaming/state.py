"""Keyed state as buckets of files with a manifest: a batch rewrites only the buckets it touches.

Layout below the table's path::

    data/version=<n>/bucket=<b>/...   the rows of bucket b as merge n left them
    manifest/<n>                      which version holds each bucket; one small file, the commit

A key always hashes to the same bucket.  Merging a batch reduces it to one change
per key, reads the buckets that those keys hash to, writes these buckets as a new
version and then the manifest that points there.  All other buckets keep their
files.  A merge that dies before its manifest leaves nothing that a reader sees;
its folder is overwritten by the next attempt.  A batch whose number a writer has
committed already is not applied again.

Cost of a merge: the touched buckets, once through one shuffle by bucket.  Choose
``buckets`` so that one fits a task; ``rebucket`` deals the table anew.  Keys are
unique within the state, so a hot key is one row in it; in the batch it is reduced
per task before the shuffle (``changes.latest_state``).

The state keeps deleted keys with their order values (``changes.live`` hides them),
so an older change that comes late cannot bring a key back; ``forget`` drops them.
Columns that later batches add are NULL in older rows.  One process writes a table.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcflow.operators.changes import latest_state, live, purge_deletes
from cdcflow.operators.envelope import DELETE_OP
from cdcflow.sources import files

BUCKET = "bucket"
VERSION = "version"
BUCKETS = 64


@dataclass(frozen=True)
class Manifest:
    """A committed state: the version of each bucket that has rows, and the last batch of each writer."""

    version: int
    buckets: int
    schema: T.StructType
    at: dict[int, int]
    writers: dict[str, int]

    def dumps(self) -> str:
        return json.dumps({"version": self.version, "buckets": self.buckets, "schema": self.schema.jsonValue(), "at": self.at, "writers": self.writers})

    @staticmethod
    def loads(text: str) -> Manifest:
        d = json.loads(text)
        return Manifest(d["version"], d["buckets"], T.StructType.fromJson(d["schema"]), {int(k): v for k, v in d["at"].items()}, d["writers"])


class StateTable:
    """The latest row per key of a change feed, under ``path``.

    ``key_cols`` and ``order_cols`` are columns of the changes; ``buckets`` counts
    for a new table only (an existing one keeps its own).
    """

    def __init__(self, spark: SparkSession, path: str, key_cols: Sequence[str], order_cols: Sequence[str], op_col: str = "__op",
                 buckets: int = BUCKETS, keep: int = 2):
        self.spark, self.path = spark, path.rstrip("/")
        self.key_cols, self.order_cols, self.op_col = list(key_cols), list(order_cols), op_col
        self.buckets, self.keep = buckets, max(1, keep)

    # --- reading -----------------------------------------------------------

    def versions(self) -> list[int]:
        return sorted(int(n) for n in files.names(self.spark, f"{self.path}/manifest") if n.isdigit())

    def manifest(self, version: int | None = None) -> Manifest | None:
        if version is None:
            there = self.versions()
            if not there:
                return None
            version = there[-1]
        return Manifest.loads(files.read_text(self.spark, f"{self.path}/manifest/{version}"))

    def rows(self, m: Manifest, only: Sequence[int] | None = None) -> DataFrame:
        """The rows of a committed state, with their bucket; of ``only`` some buckets if given."""
        schema = T.StructType([*m.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        paths = [f"{self.path}/data/{VERSION}={v}/{BUCKET}={b}" for b, v in sorted(m.at.items()) if only is None or b in only]
        if not paths:
            return self.spark.createDataFrame([], schema)
        both = T.StructType([*schema.fields, T.StructField(VERSION, T.LongType())])
        return self.spark.read.schema(both).option("basePath", f"{self.path}/data").parquet(*paths).drop(VERSION)

    def read(self, with_deletes: bool = False) -> DataFrame | None:
        """The state as last committed; ``None`` before the first commit."""
        m = self.manifest()
        if m is None:
            return None
        out = self.rows(m).drop(BUCKET)
        return out if with_deletes else live(out, self.op_col)

    def lookup(self, keys: DataFrame) -> DataFrame | None:
        """The live rows of the given keys (columns as ``key_cols``), reading only their buckets."""
        m = self.manifest()
        if m is None:
            return None
        keys = self._typed(keys.select(*self._keys()), m).distinct()
        some = {r[0] for r in keys.select(self._bucket(m.buckets)).distinct().collect()}  # at most a row per bucket
        return live(self.rows(m, some).drop(BUCKET).join(keys, self.key_cols, "left_semi"), self.op_col)

    # --- writing -----------------------------------------------------------

    def _keys(self) -> list[Column]:
        return [F.col(f"`{k}`") for k in self.key_cols]

    def _bucket(self, n: int) -> Column:
        return F.pmod(F.xxhash64(*self._keys()), F.lit(n)).cast("int")

    def _typed(self, df: DataFrame, m: Manifest | None) -> DataFrame:
        """``df`` with its columns in the state's types: equal keys of another type would hash elsewhere."""
        have = {f.name: f.dataType for f in m.schema.fields} if m else {}
        return df.withColumns({c: F.col(f"`{c}`").cast(have[c]) for c in df.columns if c in have and df.schema[c].dataType != have[c]})

    def _write(self, rows: DataFrame, version: int) -> None:
        rows.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/data/{VERSION}={version}")

    def _commit(self, m: Manifest) -> Manifest:
        if not files.write_once(self.spark, f"{self.path}/manifest/{m.version}", m.dumps()):
            raise RuntimeError(f"version {m.version} of {self.path} was committed by another writer")
        self.clean()
        return m

    def merge(self, changes: DataFrame, batch_id: int | None = None, writer: str = "") -> Manifest | None:
        """Apply a batch of changes; returns the committed manifest (the current one if there was nothing to do).

        ``writer`` and ``batch_id`` name the batch, so that a replay is recognised.
        """
        m = self.manifest()
        if m is not None and batch_id is not None and batch_id <= m.writers.get(writer, -1):
            return m
        n = m.buckets if m else self.buckets
        batch = self._typed(latest_state(changes, self.key_cols, self.order_cols, self.op_col, keep_deletes=True), m)
        batch = batch.withColumn(BUCKET, self._bucket(n)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            touched = sorted(r[0] for r in batch.select(BUCKET).distinct().collect())  # at most a row per bucket
            if not touched and (m is None or batch_id is None):
                return m
            both = batch if m is None else self.rows(m, touched).unionByName(batch, allowMissingColumns=True)
            # rows lie together by bucket, which is enough for grouping by bucket and key: one shuffle
            both = both.repartition(F.col(BUCKET))
            merged = latest_state(both, [BUCKET, *self.key_cols], self.order_cols, self.op_col, keep_deletes=True) if touched else None
            version = (m.version if m else 0) + 1
            schema = m.schema if m else None
            if merged is not None:
                order = [f.name for f in (schema.fields if schema else [])] + [c for c in merged.columns if c != BUCKET and (schema is None or c not in schema.fieldNames())]
                merged = merged.select(*[F.col(f"`{c}`") for c in order], BUCKET)
                schema = T.StructType([T.StructField(f.name, f.dataType) for f in merged.schema.fields if f.name != BUCKET])
                self._write(merged, version)
        finally:
            batch.unpersist()
        writers = {**(m.writers if m else {}), **({writer: batch_id} if batch_id is not None else {})}
        return self._commit(Manifest(version, n, schema, {**(m.at if m else {}), **dict.fromkeys(touched, version)}, writers))

    def forget(self, order_col: str, before) -> Manifest | None:
        """Drop deleted keys ordered before ``before``, from the buckets that hold any."""
        m = self.manifest()
        if m is None:
            return None
        rows = self.rows(m)
        old = F.coalesce((F.lower(F.col(f"`{self.op_col}`").cast("string")) == DELETE_OP) & (F.col(f"`{order_col}`") < F.lit(before)), F.lit(False))
        some = sorted(r[0] for r in rows.where(old).select(BUCKET).distinct().collect())
        if not some:
            return m
        version = m.version + 1
        self._write(purge_deletes(self.rows(m, some), order_col, before, self.op_col).repartition(F.col(BUCKET)), version)
        left = {b: v for b, v in m.at.items() if b not in some} | {b: version for b in self._written(version)}
        return self._commit(Manifest(version, m.buckets, m.schema, left, m.writers))

    def rebucket(self, buckets: int) -> Manifest | None:
        """Deal all rows over another number of buckets (reads and writes the whole state once)."""
        m = self.manifest()
        if m is None or m.buckets == buckets:
            return m
        version = m.version + 1
        self._write(self.rows(m).withColumn(BUCKET, self._bucket(buckets)).repartition(F.col(BUCKET)), version)
        return self._commit(Manifest(version, buckets, m.schema, dict.fromkeys(self._written(version), version), m.writers))

    def _written(self, version: int) -> list[int]:
        return [int(n.split("=")[1]) for n in files.names(self.spark, f"{self.path}/data/{VERSION}={version}") if n.startswith(f"{BUCKET}=")]

    def clean(self) -> None:
        """Remove manifests before the last ``keep``, and the folders that only they point to."""
        there = self.versions()
        if len(there) <= self.keep:
            return
        kept = {(b, v) for n in there[-self.keep :] for b, v in self.manifest(n).at.items()}
        versions = {v for _, v in kept}
        for n in there[: -self.keep]:
            for b, v in self.manifest(n).at.items():
                if v in versions and (b, v) not in kept:
                    files.remove(self.spark, f"{self.path}/data/{VERSION}={v}/{BUCKET}={b}")
        for name in files.names(self.spark, f"{self.path}/data"):
            # a version above the last commit is an attempt under way; one below that nobody points to is garbage
            if name.startswith(f"{VERSION}=") and (v := int(name.split("=")[1])) not in versions and v < there[-1]:
                files.remove(self.spark, f"{self.path}/data/{name}")
        for n in there[: -self.keep]:
            files.remove(self.spark, f"{self.path}/manifest/{n}")
