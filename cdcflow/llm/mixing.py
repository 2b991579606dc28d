"""Mixing sources to target weights with soft domain membership.

1. A classifier fitted on a bounded sample of a labelled table gives every text
   a posterior over the domains (softmax regression on the most telling words of
   the sample and a few text ratios).
2. Expected domain totals are sums of ``rate * words * posterior``.  Projected
   gradient descent with momentum finds nonnegative rates whose totals match the
   targets by least squares, held near one by a small ridge.  A rate depends on
   a text only through its posterior, so every step ships just the residuals of
   the steps so far and sums the totals where the rows are.
3. A rate becomes copies: its whole part, plus one with the chance of the rest,
   drawn from a hash of the id.

Null or blank texts have no words and count nothing; they get a rate like any.
Repeated rows each have the rate of their text.  With fewer than two labelled
domains, or an empty table, every rate is one.  Extra columns are ignored.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcflow.llm.langid import least_hash, shares
from cdcflow.llm.quality import MEASURED, measure
from cdcflow.llm.store import carried, stage
from cdcflow.llm.words import Words, chunks

log = logging.getLogger("cdcflow.mixing")

SAMPLE = 6_000       # labelled rows that the classifier is fitted on, about; drawn per domain
WORDS = 384          # words used as features
STEPS = 40
RIDGE = 1e-3
CLOSE = 2e-3         # stop when every total is within this share of all words


@dataclass
class Classifier:
    domains: list[str]
    words: np.ndarray      # sorted hashes
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    bias: np.ndarray

    def posterior(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) / self.scale @ self.weight + self.bias
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def ratios(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(words, features)`` of whole texts from their integer signals."""
    m = dict(zip(MEASURED, (x.to_numpy().astype(float) for x in measure(column))))
    words, chars = np.maximum(m["n_words"], 1), np.maximum(m["word_chars"], 1)
    x = np.stack([np.log1p(m["n_words"]), m["n_symbols"] / words, m["n_upper"] / chars, chars / words,
                  m["n_dup_lines"] / np.maximum(m["n_lines"], 1), m["n_lines"] / words, m["n_repeat_words"] / words], 1)
    return m["n_words"].astype(np.int64), x


def word_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """Distinct word hashes of every text."""
    for a, b, data, offsets in chunks(column):
        w = Words(data, offsets)
        h = w.hashes()
        for d in range(b - a):
            yield np.unique(h[w.first[d] : w.first[d + 1]])


def features(column: pa.Array, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(word counts, features)``: ratios, then presence of each of ``words``."""
    n, x = ratios(column)
    if not len(words):
        return n, x
    has = np.zeros((len(n), len(words)), np.float32)
    row = 0
    for a, b, data, offsets in chunks(column):
        w = Words(data, offsets)
        h = w.hashes()
        at = np.minimum(np.searchsorted(words, h), len(words) - 1)
        hit = np.flatnonzero(words[at] == h)
        docs = np.searchsorted(w.first, hit, "right") - 1
        has[row + docs, at[hit]] = 1
        row += b - a
    return n, np.hstack([x, has])


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, x = ratios(batch.column(1))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x.tolist(), pa.list_(pa.float64())), pa.array([s.tobytes() for s in word_sets(batch.column(1))], pa.binary())],
                                         names=["domain", "x", "words"])


def telling(sets: list[np.ndarray], y: np.ndarray, k: int, most: int = WORDS) -> np.ndarray:
    """The ``most`` words with the largest likelihood-ratio statistic of presence against domain."""
    words, inv = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(y, [len(s) for s in sets])
    seen = np.zeros((len(words), k))
    np.add.at(seen, (inv, owner), 1)
    per = np.bincount(y, minlength=k).astype(float)
    df = seen.sum(1, keepdims=True)
    expect, absent = df * per / per.sum(), per - seen
    other = (per.sum() - df) * per / per.sum()
    with np.errstate(divide="ignore", invalid="ignore"):
        g = np.where(seen > 0, seen * np.log(seen / expect), 0).sum(1) + np.where(absent > 0, absent * np.log(absent / other), 0).sum(1)
    g[df[:, 0] < 5] = 0
    best = np.lexsort((words, -g))[:most]
    return np.sort(words[best[g[best] > 0]])


def fit(docs: DataFrame, labelled: DataFrame, sample: int = SAMPLE) -> Classifier | None:
    """``labelled`` has ``doc_id, domain``; rows with a null in either, or without a text, are left out."""
    known = labelled.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("domain").cast("string").alias("domain")).dropna()
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = known.join(d.where("text IS NOT NULL").select("doc_id"), "doc_id", "left_semi")
    sizes = {r["domain"]: r["count"] for r in known.groupBy("domain").count().collect()}  # a row per domain
    if len(sizes) < 2:
        return None
    share = shares(sizes, sample)
    some = known.where(F.pmod(F.xxhash64("doc_id", "domain", F.lit(4)), F.lit(1 << 30)) < least_hash(F.col("domain"), share, 1 << 30))
    rows = (d.join(F.broadcast(some), "doc_id")  # about sample short rows
            .select("domain", "text").mapInArrow(_sampled, "domain string, x array<double>, words binary").collect())
    domains = sorted({r["domain"] for r in rows})
    if len(domains) < 2:
        return None
    rows.sort(key=lambda r: (r["domain"], r["words"], r["x"]))
    y = np.array([domains.index(r["domain"]) for r in rows])
    sets = [np.frombuffer(r["words"], np.uint64) for r in rows]
    words = telling(sets, y, len(domains))
    has = np.stack([np.isin(words, s, assume_unique=True) for s in sets]).astype(float)
    x = np.hstack([np.array([r["x"] for r in rows]), has])
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = (x - mean) / scale
    target = np.eye(len(domains))[y]
    # rows weigh so that domains count as they do in the whole table
    weigh = np.array([sizes[k] for k in domains]) / np.maximum(np.bincount(y, minlength=len(domains)), 1)
    weigh = (weigh / (weigh[y].mean()))[y][:, None]
    weight, bias = np.zeros((z.shape[1], len(domains))), np.log((weigh * target).mean(0))
    vw, vb, n = np.zeros_like(weight), np.zeros_like(bias), len(z)
    for _ in range(300):  # momentum descent on the regularised likelihood
        p = z @ weight + bias
        p = np.exp(p - p.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        vw = 0.9 * vw + z.T @ (weigh * (p - target)) / n + 1e-3 * weight
        vb = 0.9 * vb + (weigh * (p - target)).mean(0)
        weight, bias = weight - 0.1 * vw, bias - 0.1 * vb
    return Classifier(domains, words, mean, scale, weight, bias)


@dataclass
class Plan:
    """Replays the descent for any posterior: ``pull`` holds a vector per step."""

    pull: list[np.ndarray]
    step: float
    ridge: float
    top: float

    def rate(self, p: np.ndarray) -> np.ndarray:
        r = last = np.ones(len(p))
        for t, v in enumerate(self.pull):
            ahead = r + t / (t + 3) * (r - last)
            last, r = r, np.clip(ahead - self.step * (p @ v + self.ridge * (ahead - 1)), 0, self.top)
        return r

    def ahead(self, p: np.ndarray) -> np.ndarray:
        """Where the next gradient is taken."""
        t = len(self.pull)
        r = self.rate(p)
        last = Plan(self.pull[:-1], self.step, self.ridge, self.top).rate(p) if t else r
        return r + t / (t + 3) * (r - last)


def _total(post: DataFrame, of, width: int) -> np.ndarray:
    """Sums of ``of(n, p)`` over all rows, first per task."""

    def part(batches):
        total = np.zeros(width)
        for batch in batches:
            if batch.num_rows:
                n = batch.column(0).to_numpy().astype(float)
                total += of(n, np.array(batch.column(1).flatten()).reshape(len(n), -1))
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(total)], names=["k", "v"])

    rows = post.select("n_tokens", "posterior").mapInArrow(part, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(width)
    for r in rows:
        out[r["k"]] = r["v"]
    return out


def solve(post: DataFrame, k: int, goal, top: float = math.inf, steps: int = STEPS, ridge: float = RIDGE) -> tuple[Plan, np.ndarray]:
    """Rates for ``post`` (``n_tokens, posterior``); ``goal(totals)`` gives the target totals.  Returns the plan and the totals it reaches."""
    sums = _total(post, lambda n, p: np.concatenate([n @ p, (p.T * n @ p).ravel()]), k + k * k)
    start, gram = sums[:k], sums[k:].reshape(k, k)
    words = start.sum()
    if words <= 0:
        return Plan([], 1.0, ridge, top), start
    want = np.asarray(goal(start), float)
    weigh = words / np.maximum(start, words * 1e-6)  # errors relative to a domain's own size
    root = np.sqrt(weigh)
    step = 1 / (np.linalg.eigvalsh(gram / words * root[:, None] * root)[-1] + ridge)
    plan, now = Plan([], step, ridge, top), start
    for _ in range(steps):
        plan = Plan([*plan.pull, weigh * (now - want) / words], step, ridge, top)
        both = _total(post, lambda n, p, q=plan: np.concatenate([(n * q.rate(p)) @ p, (n * q.ahead(p)) @ p]), 2 * k)
        reached, now = both[:k], both[k:]
        if np.abs(reached - want).max() <= CLOSE * words:
            break
    return plan, reached


def _posteriors(model: Classifier):
    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 2048):
                part = batch.slice(a, 2048)
                n, x = features(part.column(1), model.words)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n), pa.array(model.posterior(x).tolist(), pa.list_(pa.float64()))], names=["doc_id", "n_tokens", "posterior"])

    return run


def copies(rate, *seed):
    """Whole part of the rate, plus one with the chance of its fraction, however small."""
    draw = F.pmod(F.xxhash64(*seed, F.lit(44)), F.lit(1 << 52)) / float(1 << 52)
    return (F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")).cast("long")


def prepare(docs: DataFrame, labelled: DataFrame, goal, top: float = math.inf):
    """``(classifier, plan, posteriors)`` or ``None`` without two domains; ``goal(domains, totals)`` gives target totals."""
    model = fit(docs, labelled)
    if model is None:
        return None
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    post = stage(d.mapInArrow(_posteriors(model), "doc_id long, n_tokens long, posterior array<double>"), "posteriors")
    wanted: list[np.ndarray] = []

    def asked(totals):
        wanted.append(np.asarray(goal(model.domains, totals), float))
        return wanted[-1]

    plan, reached = solve(post, len(model.domains), asked, top)
    for want in wanted:
        off = np.abs(reached - want) > CLOSE * max(reached.sum(), 1.0)
        tell = log.warning if off.any() else log.info
        tell("mixing reached %s", ", ".join(f"{d}: {r:.0f} of {w:.0f} words" for d, r, w in zip(model.domains, reached, want)))
    return model, plan, post


def by_weight(weights: dict[str, float], budget: float | None = None):
    """Targets that share ``budget`` words (all words there are, by default) by ``weights``."""
    def goal(domains, totals):
        if lost := sorted(k for k, w in weights.items() if w > 0 and k not in domains):
            raise ValueError(f"no labelled text for the domains {lost}")
        w = np.array([weights.get(d, 0.0) for d in domains])
        return (sum(totals) if budget is None else budget) * w / max(w.sum(), 1e-12)

    return goal


def mix(docs: DataFrame, labelled: DataFrame, goal, top: float = math.inf) -> DataFrame:
    """``doc_id, n_tokens, domains, posterior, rate, copies`` per row."""
    ready = prepare(docs, labelled, goal, top)
    if ready is None:
        d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("long").alias("n_tokens"))
        return d.select("doc_id", "n_tokens", F.array().cast("array<string>").alias("domains"), F.array().cast("array<double>").alias("posterior"),
                        F.lit(1.0).alias("rate"), F.lit(1).cast("long").alias("copies"))
    model, plan, post = ready

    def rates(batches):
        for batch in batches:
            p = np.array(batch.column(2).flatten()).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(plan.rate(p))], names=["doc_id", "n_tokens", "posterior", "rate"])

    out = post.mapInArrow(rates, "doc_id long, n_tokens long, posterior array<double>, rate double")
    return out.select("doc_id", "n_tokens", F.array(*map(F.lit, model.domains)).alias("domains"), "posterior", "rate", copies(F.col("rate"), F.col("doc_id")).alias("copies"))


def mixed(docs: DataFrame, labelled: DataFrame, goal, top: float = math.inf) -> DataFrame:
    """The rows of ``docs``, each as often as its copies say, with all their columns."""
    ready = prepare(docs, labelled, goal, top)
    if ready is None:
        return docs
    model, plan, _ = ready

    def run(batch):
        out = [np.zeros(0)]
        for a in range(0, batch.num_rows, 2048):
            _, x = features(batch.column(0).slice(a, 2048), model.words)
            out.append(plan.rate(model.posterior(x)))
        return [pa.array(np.concatenate(out))]

    rows = carried(docs, run, "rate double", F.col("text").cast("string").alias("text"))
    n = copies(F.col("rate"), F.col("row").getField("doc_id"))
    return rows.withColumn("copies", n).where("copies > 0").select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("row.*")
