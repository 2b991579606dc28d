"""Quality classifier: a sparse ensemble of rules.

1. Every whole text gets statistics (lengths, shares of symbols, capitals, digits
   and marks, lines, repeats).
2. Boosted trees are fitted on the statistics of labelled rows; every path from a
   root to a node is a conjunction of bounds, a rule.
3. Logistic regression with an L1 penalty on the rules keeps few of them.  The
   penalty is the strongest whose loss on a held-back part of the labelled rows
   is within a standard error of the least.
4. The rules left are compiled to one Spark column expression over the statistics,
   so scoring is a projection.

Only ``labelled`` rows teach; labels are never inputs of a score.  Fitting reads
at most about ``SAMPLE`` labelled rows, drawn per label by a hash of id and text;
the rest covers all rows and whole texts.

Null texts count as empty; an empty text has all statistics zero and a score like
any.  Labels join by id: several labels of an id count as 1 if any is, rows with a
null id or label are left out, every row of a repeated id is labelled.  With one
label only, or none, every score is the smoothed share of label 1 (one half
without any).  Repeated rows score alike, an empty table gives an empty result,
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcflow.llm.langid import least_hash, shares
from cdcflow.llm.quality import MEASURED, measure
from cdcflow.llm.trees import Model, Tree, boost
from cdcflow.llm.words import Words, chunks

SAMPLE = 12_000     # labelled rows that the rules are fitted on, about; drawn per label
ROUNDS = 24         # boosted trees that rules are taken from
DEPTH = 3
RARE = 0.005        # a rule holds in this share of the rows at least, and fails in as many
PENALTIES = 24      # tried from the strongest down, each 0.75 of the one before

STATS = ["words", "chars_per_word", "symbols_per_word", "upper_share", "digit_share", "mark_share", "shout_share", "bar_share", "other_share",
         "words_per_line", "dup_line_share", "repeat_share", "distinct_share", "short_share", "long_share"]

_KINDS = {"digit": b"0123456789", "mark": b".,;:'\"()-?/_=+@~`^{}\\", "shout": b"!", "bar": b"|"}
_FLAGS = {k: np.isin(np.arange(256), list(v)).astype(np.int64) for k, v in _KINDS.items()}
_OTHER = np.array([b >= 0xC0 for b in range(256)], np.int64)  # first bytes of other than ASCII


def statistics(column: pa.Array) -> np.ndarray:
    """A row of ``STATS`` per whole text."""
    m = dict(zip(MEASURED, (x.to_numpy().astype(float) for x in measure(column))))
    more: dict[str, list[np.ndarray]] = {k: [] for k in (*_FLAGS, "other", "distinct", "short", "long")}
    for a, b, data, offsets in chunks(column):
        def per_text(flags, at=offsets):
            total = np.concatenate([[0], np.cumsum(flags)])
            return total[at[1:]] - total[at[:-1]]

        for k, flags in _FLAGS.items():
            more[k].append(per_text(flags[data]))
        more["other"].append(per_text(_OTHER[data]))
        w = Words(data, offsets)
        size = w.end - w.start
        more["short"].append(per_text(size <= 3, w.first))
        more["long"].append(per_text(size >= 12, w.first))
        owner = np.repeat(np.arange(b - a), w.count)
        order = np.lexsort((h := w.hashes(), owner))
        h, owner = h[order], owner[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
        more["distinct"].append(np.bincount(owner[new], minlength=b - a))
    n = {k: np.concatenate(v).astype(float) if v else np.zeros(0) for k, v in more.items()}
    words, chars, lines = np.maximum(m["n_words"], 1), np.maximum(m["word_chars"], 1), np.maximum(m["n_lines"], 1)
    return np.stack([m["n_words"], m["word_chars"] / words, m["n_symbols"] / words, m["n_upper"] / chars, n["digit"] / chars, n["mark"] / chars, n["shout"] / words,
                     n["bar"] / words, n["other"] / chars, m["n_words"] / lines, m["n_dup_lines"] / lines, m["n_repeat_words"] / words, n["distinct"] / words,
                     n["short"] / words, n["long"] / words], 1)


@dataclass(frozen=True)
class Rule:
    """Bounds on statistics: ``low < x`` and ``x <= high`` for each."""

    bounds: tuple[tuple[int, float, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for f, low, high in self.bounds:
            out &= (x[:, f] > low) & (x[:, f] <= high)
        return out

    def column(self) -> Column:
        out = None
        for f, low, high in self.bounds:
            for part in ([F.col(STATS[f]) > F.lit(low)] if low > -np.inf else []) + ([F.col(STATS[f]) <= F.lit(high)] if high < np.inf else []):
                out = part if out is None else out & part
        return out

    def __str__(self) -> str:
        parts = [f"{f'{low:.4g} < ' if low > -np.inf else ''}{STATS[f]}{f' <= {high:.4g}' if high < np.inf else ''}" for f, low, high in self.bounds]
        return " and ".join(parts)


def paths(tree: Tree, edges: list[np.ndarray]) -> list[Rule]:
    """A rule for every node of a tree but its root."""
    out, todo = [], [(0, {})]
    while todo:
        node, bounds = todo.pop()
        if bounds:
            out.append(Rule(tuple((f, *bounds[f]) for f in sorted(bounds))))
        if tree.left[node] > 0:
            f, cut = int(tree.feature[node]), float(edges[tree.feature[node]][tree.split[node]])
            low, high = bounds.get(f, (-np.inf, np.inf))
            todo.append((int(tree.left[node]), {**bounds, f: (low, min(high, cut))}))
            todo.append((int(tree.left[node]) + 1, {**bounds, f: (max(low, cut), high)}))
    return out


def rules_of(model: Model, x: np.ndarray, rare: float = RARE) -> list[Rule]:
    """The distinct rules of all trees; of rules that hold in the same rows, the shortest."""
    seen: dict[bytes, Rule] = {}
    for rule in sorted({r for t in model.trees for r in paths(t, model.edges)}, key=lambda r: (len(r.bounds), r.bounds)):
        has = rule.holds(x)
        if rare <= has.mean() <= 1 - rare:
            seen.setdefault(min(np.packbits(has).tobytes(), np.packbits(~has).tobytes()), rule)
    return list(seen.values())


def lasso(z: np.ndarray, y: np.ndarray, penalty: float, start: tuple[np.ndarray, float], steps: int = 400) -> tuple[np.ndarray, float]:
    """Logistic weights with an L1 penalty, by accelerated proximal gradient; the intercept is free."""
    n = len(y)
    rate = 4 * n / (np.linalg.norm(z, 2) ** 2 + n)
    w, b = start
    v, c, t = w.copy(), b, 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(z @ v + c)))
        nw = v - rate * (z.T @ (p - y) / n)
        nw = np.sign(nw) * np.maximum(np.abs(nw) - rate * penalty, 0)
        nb = c - rate * float((p - y).mean())
        u = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v, c = nw + (t - 1) / u * (nw - w), nb + (t - 1) / u * (nb - b)
        moved = max(np.abs(nw - w).max(initial=0), abs(nb - b))
        w, b, t = nw, nb, u
        if moved < 1e-6:
            break
    return w, b


def losses(z: np.ndarray, y: np.ndarray, w: np.ndarray, b: float) -> np.ndarray:
    s = z @ w + b
    return np.logaddexp(0, s) - y * s


@dataclass
class Ensemble:
    """``score = 1 / (1 + exp(-(base + sum of weights of the rules that hold)))``."""

    base: float
    rules: list[Rule] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for rule, w in zip(self.rules, self.weights):
            total = total + np.where(rule.holds(x), w, 0.0)
        return 1 / (1 + np.exp(-total))

    def column(self) -> Column:
        """The score as an expression over columns named as ``STATS``."""
        total = F.lit(self.base)
        for rule, w in zip(self.rules, self.weights):
            total = total + F.when(rule.column(), F.lit(w)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def __str__(self) -> str:
        return "\n".join([f"{self.base:+.3f}", *[f"{w:+.3f}  {r}" for r, w in sorted(zip(self.rules, self.weights), key=lambda p: -abs(p[1]))]])


def ensemble(x: np.ndarray, y: np.ndarray) -> Ensemble:
    """Rules from trees, sparse weights by lasso; every third row is held back to choose the penalty."""
    share = (y.sum() + 1) / (len(y) + 2)
    plain = Ensemble(float(np.log(share / (1 - share))))
    if min(y.sum(), len(y) - y.sum()) < 2:
        return plain
    back = np.arange(len(y)) % 3 == 2
    both = len(set(y[~back])) == 2

    def rules(rows):
        return rules_of(boost(x[rows], y[rows], ROUNDS, DEPTH), x[rows])

    def path(found, rows):
        # columns of spread one, so the penalty means the same for frequent and for rare rules
        z = np.stack([r.holds(x) for r in found], 1).astype(float)
        mean, spread = z[rows].mean(0), z[rows].std(0) + 1e-9
        z = (z - mean) / spread
        most = np.abs(z[rows].T @ (y[rows] - y[rows].mean())).max() / rows.sum()
        at = (np.zeros(z.shape[1]), float(np.log(y[rows].mean() / (1 - y[rows].mean()))))
        for k in range(PENALTIES):
            at = lasso(z[rows], y[rows], most * 0.75**k, at)
            yield z, at, mean, spread

    chosen = PENALTIES // 2
    if both and (found := rules(~back)):
        tried = [losses(z[back], y[back], w, b) for z, (w, b), _, _ in path(found, ~back)]
        means = np.array([t.mean() for t in tried])
        best = int(means.argmin())
        chosen = int(np.flatnonzero(means <= means[best] + tried[best].std() / max(back.sum(), 1) ** 0.5)[0])
    every = np.ones(len(y), bool)
    found = rules(every)
    if not found:
        return plain
    for k, (_, (w, b), mean, spread) in enumerate(path(found, every)):
        if k == chosen:
            break
    raw = w / spread
    keep = np.flatnonzero(np.abs(w) > 1e-9)
    return Ensemble(float(b - (raw * mean).sum()), [found[k] for k in keep], [float(raw[k]) for k in keep])


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = statistics(batch.column(batch.num_columns - 1))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *[pa.array(x[:, k]) for k in range(x.shape[1])]], names=[*batch.schema.names[:-1], *STATS])


def measured(rows: DataFrame) -> DataFrame:
    """The statistics of ``rows``, whose last column is ``text``, beside the other columns."""
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(_measured, ", ".join([kept, *[f"{s} double" for s in STATS]]))


def fit(docs: DataFrame, labelled: DataFrame, sample: int = SAMPLE) -> Ensemble:
    """``labelled`` has ``doc_id, label`` (1 good, 0 bad); only those rows are learnt from."""
    known = labelled.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("label") == 1).cast("int").alias("label")).dropna()
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    sizes = {str(r["label"]): r["count"] for r in d.select("doc_id").join(known, "doc_id").groupBy("label").count().collect()}  # two rows at most
    if not sizes:
        return Ensemble(0.0)
    some = known.where(F.pmod(F.xxhash64("doc_id", "label", F.lit(13)), F.lit(1 << 30)) < least_hash(F.col("label").cast("string"), shares(sizes, sample), 1 << 30))
    drawn = d.join(F.broadcast(some), "doc_id")  # about sample ids
    # ids that repeat without end are cut at twice the sample, by hash
    rows = measured(drawn.select(F.xxhash64("doc_id", "text", F.lit(13)).alias("place"), "label", "text")).dropDuplicates(["place"]).orderBy("place").limit(2 * sample).collect()
    x = np.array([r[2:] for r in rows], float).reshape(-1, len(STATS))
    y = np.array([r["label"] for r in rows], float)
    model = ensemble(x, y)
    if len(sizes) == 2 and len(y):
        # labels count as often as in the whole table, whatever share of each was drawn
        drawn = {"0": max(1.0, float((y == 0).sum())), "1": max(1.0, float(y.sum()))}
        model.base += float(np.log(sizes["1"] / drawn["1"]) - np.log(sizes["0"] / drawn["0"]))
    return model


def score(docs: DataFrame, model: Ensemble, *keep: Column) -> DataFrame:
    """``keep`` columns of ``docs``, its statistics, ``score`` and ``predicted``: a row per row."""
    rows = docs.select(*keep, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    out = measured(rows).withColumn("score", model.column())
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
