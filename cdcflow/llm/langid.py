"""Language identification by nearest centroids of TF-IDF n-gram vectors.

A text is the counts of its letter n-grams (2 to 4 bytes of the lower-cased text
with every run of other ASCII characters as one blank), hashed into ``DIMS``
places, damped, weighted by inverse document frequency and normalised.  From a
bounded sample of labelled texts per language, each gets ``CENTROIDS`` spherical
k-means centroids.  A text takes the language of its nearest centroid by cosine;
it is flagged as rejected when that cosine falls below the language's threshold,
a low quantile of its own sample.  ``score`` is the share of similarity of the
best language among all (0 to 1).

A null text, or one without a letter, is ``und`` with score 0.  Rows repeat as
they are, extra columns are ignored, an empty table gives an empty result, and
without labelled texts every row is ``und``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcflow.llm.words import chunks

SAMPLE = 4_000       # labelled texts fitted on, about
DIMS = 4096
CENTROIDS = 4        # per language
LEAST = 64           # texts of a language drawn at least, where it has them
QUANTILE = 0.001     # of a language's own sample that its threshold rejects
SHARP = 12.0         # of the softmax over cosines that gives the score

# Lower-cased letters and bytes above ASCII stay, all else is a blank.
_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def vectors(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """n-gram counts (texts x ``DIMS``) of whole texts."""
    n = len(offsets) - 1
    out = np.zeros(n * DIMS, np.int64)
    c = _FOLD[data]
    keep = np.ones(len(c), bool)
    keep[1:] = (c[1:] != 32) | (c[:-1] != 32)
    doc = np.repeat(np.arange(n), np.diff(offsets))
    c, doc = c[keep].astype(np.uint32), doc[keep]
    gram = c.copy()
    for k in range(1, 4):
        gram = gram[:-1] * np.uint32(0x01000193) + c[k:] * np.uint32(0x9E3779B1)
        same = doc[k:] == doc[: len(doc) - k] if len(doc) > k else np.zeros(0, bool)
        h = gram ^ (gram >> np.uint32(15))
        h = (h * np.uint32(0x85EBCA6B)) >> np.uint32(20)
        out += np.bincount((doc[k:] * DIMS + h)[same], minlength=n * DIMS) if len(h) else 0
    return out.reshape(n, DIMS)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.sqrt(counts) * idf
    return v / np.maximum(np.sqrt((v * v).sum(1, keepdims=True)), 1e-12)


@dataclass
class Centroids:
    langs: list[str]
    idf: np.ndarray
    vector: np.ndarray     # centroids x DIMS
    owner: np.ndarray      # language of each
    least: np.ndarray      # threshold per language

    def predict(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(language, score, nearest cosine)`` per row of counts."""
        cos = weighted(counts, self.idf) @ self.vector.T
        per = np.stack([cos[:, self.owner == k].max(1) for k in range(len(self.langs))], 1)
        best = per.argmax(1)
        e = np.exp(SHARP * (per - per.max(1, keepdims=True)))
        return best, e.max(1) / e.sum(1), per.max(1)


def _cluster(v: np.ndarray, k: int, rng) -> np.ndarray:
    """Spherical k-means."""
    k = min(k, len(v))
    c = v[rng.choice(len(v), k, replace=False)]
    for _ in range(8):
        near = (v @ c.T).argmax(1)
        c = np.stack([v[near == j].mean(0) if (near == j).any() else c[j] for j in range(k)])
        c /= np.maximum(np.sqrt((c * c).sum(1, keepdims=True)), 1e-12)
    return c


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for _, _, data, offsets in chunks(batch.column(1), 1 << 18, 512):
            for v in vectors(data, offsets):
                at = np.flatnonzero(v)
                rows.append(np.stack([at, v[at]]).astype("<u4").tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], names=["lang", "counts"])


def shares(sizes: dict[str, int], sample: int) -> dict[str, float]:
    """The share of each class to draw: equal quotas, what small classes leave goes to the others."""
    out, left, rest = {}, sample, len(sizes)
    for name, n in sorted(sizes.items(), key=lambda e: (e[1], e[0])):
        quota = max(1, left // rest)
        # a few rows' draw may come out empty, so small quotas are drawn whole or wide
        out[name] = 1.0 if n <= max(quota, LEAST) else max(quota, LEAST) / n
        left, rest = max(0, left - min(n, quota)), rest - 1
    return out


def least_hash(name: Column, share: dict[str, float], size: int) -> Column:
    """The bound under which the hash of a row of a class lies when it is drawn."""
    pairs = [x for k, v in sorted(share.items()) for x in (F.lit(k), F.lit(math.ceil(v * size)))]
    return F.create_map(*pairs)[name]


def document_counts(texts: DataFrame) -> np.ndarray:
    """How many of all texts hold each n-gram, summed per task."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(DIMS, np.int64)
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(0), 1 << 18, 512):
                held += (vectors(data, offsets) > 0).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIMS, dtype=np.int64)), pa.array(held)], names=["k", "n"])

    out = np.zeros(DIMS, np.int64)
    for r in texts.mapInArrow(part, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect():
        out[r["k"]] = r["n"]
    return out


def fit(docs: DataFrame, learn: Column, sample: int = SAMPLE, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id") -> Centroids | None:
    """Centroids from about ``sample`` texts, drawn by hash per language, among rows where ``learn`` holds and
    the language is known; document frequencies are of all those rows."""
    known = docs.where(learn & F.col(lang_col).isNotNull() & (F.length(text_col) > 0)).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"), F.col(id_col).alias("id"))
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}  # a row per language
    if not sizes:
        return None
    share = shares(sizes, sample)
    rows = (known.where(F.pmod(F.xxhash64("id", "text", F.lit(9)), F.lit(1 << 30)) < least_hash(F.col("lang"), share, 1 << 30)).select("lang", "text")
            .mapInArrow(_counted, "lang string, counts binary").collect())  # about sample rows of sparse counts, and copies of equal rows
    rows.sort(key=lambda r: (r["lang"], r["counts"]))
    counts = np.zeros((len(rows), DIMS), np.float32)
    for i, r in enumerate(rows):
        at, n = np.frombuffer(r["counts"], "<u4").reshape(2, -1)
        counts[i, at] = n
    held = document_counts(known.select("text"))
    idf = (np.log((1 + sum(sizes.values())) / (1 + held)) + 0.05).astype(np.float32)
    v = weighted(counts, idf)
    del counts
    langs = sorted({r["lang"] for r in rows})
    y = np.array([langs.index(r["lang"]) for r in rows])
    rng = np.random.default_rng(9)
    made, owner, least = [], [], []
    for k in range(len(langs)):
        own = v[y == k]
        c = _cluster(own, CENTROIDS, rng)
        made.append(c)
        owner += [k] * len(c)
        least.append(np.quantile((own @ c.T).max(1), QUANTILE))
    return Centroids(langs, idf, np.concatenate(made), np.array(owner), np.array(least))


def has_letter(raw: bytes) -> bool:
    return any(map(str.isalpha, raw.decode()))


_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[65:91] = True


def identify(docs: DataFrame, model: Centroids | None, *carry: Column, text_col: str = "text") -> DataFrame:
    """``carry`` columns plus ``lang_pred, score, cosine, rejected`` per row."""
    given = docs.select(*carry, F.col(text_col).cast("string").alias("__text"))
    fields = [f for f in given.schema.fields if f.name != "__text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", lang_pred string, score double, cosine double, rejected boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score, cosine, rejected = [], [], [], []
            for _, _, data, offsets in chunks(batch.column(len(fields)), 1 << 18, 512):
                letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
                plain = letters[offsets[1:]] > letters[offsets[:-1]]
                best, sc, near = model.predict(vectors(data, offsets)) if model else (None, None, None)
                for i in range(len(offsets) - 1):
                    if model is None or not (plain[i] or has_letter(data[offsets[i] : offsets[i + 1]].tobytes())):
                        lang.append("und"), score.append(0.0), cosine.append(0.0), rejected.append(True)
                    else:
                        lang.append(model.langs[best[i]]), score.append(float(sc[i])), cosine.append(float(near[i]))
                        rejected.append(bool(near[i] < model.least[best[i]]))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(fields)], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(cosine, pa.float64()), pa.array(rejected, pa.bool_())],
                                             names=[f.name for f in fields] + ["lang_pred", "score", "cosine", "rejected"])

    return given.mapInArrow(run, schema)
