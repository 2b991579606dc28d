"""Exact top-k inner-product search, a block at a time.

Vectors are quantised to integers and dealt into shards.  Within a shard they
are put in an order that brings alike ones together (leading dimensions first)
and cut into blocks, the document ranges.  A block keeps a maximum and a minimum
per dimension (a term) and its vectors as a forward index.  For a query the sum
of ``max(q * maximum, q * minimum)`` bounds every score in a block; blocks are
scored from the largest bound on, until bounds fall below the query's k-th best
score.  Queries travel in chunks against shards, so no side is held whole; the
best k of every shard meet in a last ranking by query.

Vectors that are null, or hold a null or non-finite component, take no part.
Missing trailing components count as zero.  Ties go to the smaller id.  A query
row does not match itself (rows of the same id).  Repeated rows are candidates as
often as they come.  Extra columns are ignored; an empty table, or one without
queries, gives an empty result.  Scores beyond 64 bits raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cdcflow.llm.store import stage

SCALE = 256
BLOCK = 64
SHARD = 2048         # vectors a shard holds, about
CHUNK = 512          # queries a chunk holds, about


def quantised(values: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * values.astype(np.float64))


def _quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that take part, their integer components as little-endian doubles."""
    for batch in batches:
        ids, asks, out = [], [], []
        for vec_id, ask, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            if vec_id is None or not v.is_valid or v.values.null_count:
                continue
            x = v.values.to_numpy(zero_copy_only=False)
            if np.isfinite(x).all():
                ids.append(vec_id)
                asks.append(bool(ask))
                out.append(quantised(x).astype("<f8").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(asks, pa.bool_()), pa.array(out, pa.binary())], names=["vec_id", "ask", "v"])


def matrix(column) -> np.ndarray:
    """Rows of doubles, padded with zeros to the longest."""
    rows = [np.frombuffer(x, "<f8") for x in column.to_pylist()]
    out = np.zeros((len(rows), max((len(r) for r in rows), default=0)))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products: by doubles where every sum stays below 2**53, else by Python integers."""
    d = min(q.shape[1], x.shape[1])
    q, x = q[:, :d], x[:, :d]
    if not d or np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * d < 2**53:
        return (q @ x.T).astype(np.int64)
    wide = np.array([[int(a) for a in r] for r in q], object) @ np.array([[int(a) for a in r] for r in x], object).T
    return wide.astype(np.int64)


class Blocks:
    """The blocks of one shard."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, size: int = BLOCK):
        lead = np.argsort(-np.abs(x), axis=1, kind="stable")[:, :2]
        sign = np.take_along_axis(x, lead, 1) >= 0
        keys = [lead[:, i] * 2 + sign[:, i] for i in range(lead.shape[1])]
        order = np.lexsort((ids, *keys[::-1])) if keys else np.argsort(ids, kind="stable")
        self.ids, self.x = ids[order], x[order]
        self.cuts = np.arange(0, len(ids), size)
        self.high = np.maximum.reduceat(self.x, self.cuts) if x.shape[1] else np.zeros((len(self.cuts), 0))
        self.low = np.minimum.reduceat(self.x, self.cuts) if x.shape[1] else np.zeros((len(self.cuts), 0))
        self.size = size

    def best(self, q_id: int, q: np.ndarray, k: int) -> tuple[list[tuple[int, int]], int]:
        """``(score, id)`` of the k best for a query, and the blocks scored."""
        d = min(len(q), self.x.shape[1])
        bound = np.maximum(self.high[:, :d] * q[:d], self.low[:, :d] * q[:d]).sum(1)
        bound += np.abs(bound) * 1e-9  # sums of doubles beyond 2**53 round
        scores, ids, scored = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        for b in np.argsort(-bound, kind="stable"):
            if len(scores) >= k and bound[b] < scores[-1]:
                break
            scored += 1
            a = self.cuts[b]
            own = self.ids[a : a + self.size]
            s = products(q[None], self.x[a : a + self.size])[0]
            other = own != q_id
            scores, ids = np.concatenate([scores, s[other]]), np.concatenate([ids, own[other]])
            at = np.lexsort((ids, -scores))[:k]
            scores, ids = scores[at], ids[at]
        return list(zip(scores.tolist(), ids.tolist())), scored


def _search(k: int):
    def run(queries: pa.Table, docs: pa.Table) -> pa.Table:
        out: tuple[list, ...] = ([], [], [])
        if queries.num_rows and docs.num_rows:
            blocks = Blocks(docs.column("vec_id").to_numpy(), matrix(docs.column("v")))
            for q_id, q in zip(queries.column("vec_id").to_pylist(), matrix(queries.column("v"))):
                for score, vec_id in blocks.best(q_id, q, k)[0]:
                    out[0].append(q_id)
                    out[1].append(vec_id)
                    out[2].append(score)
        return pa.table({n: pa.array(x, pa.int64()) for n, x in zip(("query_id", "vec_id", "score"), out)})

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best other rows of every query row."""
    given = vectors.select(F.col(id_col).cast("long").alias("vec_id"), is_query.alias("ask"), F.col(vector_col).cast("array<double>").alias("v"))
    ready = stage(given.mapInArrow(_quantise, "vec_id long, ask boolean, v binary"), "vectors")
    counts = ready.agg(F.count("*").alias("n"), F.count(F.when(F.col("ask"), 1)).alias("q")).first()
    shards, parts = max(1, -(-counts["n"] // SHARD)), max(1, -(-counts["q"] // CHUNK))
    # rows of one id all take part as candidates; as a query an id is asked once
    place = F.monotonically_increasing_id()
    docs = ready.select("vec_id", "v", F.pmod(F.xxhash64(place, F.lit(2)), F.lit(shards)).alias("shard"))
    asks = ready.where("ask").dropDuplicates(["vec_id", "v"]).select("vec_id", "v", F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(parts)).alias("part"))
    docs = docs.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    asks = asks.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    found = asks.groupBy("part", "shard").cogroup(docs.groupBy("part", "shard")).applyInArrow(_search(k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).alias("rank")
    return found.select("query_id", rank, "vec_id", "score").where(F.col("rank") <= k)
