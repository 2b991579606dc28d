"""Quality rules with risk-controlled cutoffs.

Every text gets integer signals (words, characters in words, symbols, repeated
lines, words inside repeated five-word windows) and ratios of them.  Fixed base
rules reject first.  For the rest, each rule "ratio above its cutoff rejects"
gets a cutoff per stratum from labelled holdout rows: a cutoff is allowed only
when the exact (Clopper-Pearson) upper bound of the share of good rows it
rejects is at most ``alpha`` divided by the number of rules, so that all rules
together reject at most ``alpha`` of a stratum's good rows.  Multiple testing: the
cutoffs of a rule are tested in fixed order, from the one that rejects least,
until one fails (no further correction needed), and the error ``delta`` is divided
among strata and rules (Bonferroni).  The last allowed cutoff is used.  Without enough labelled rows none is allowed and the rule rejects
nothing in that stratum.

Null texts have no words.  A text with no words fails the base rule.  Rows repeat
as they are, extra columns are ignored, an empty table gives an empty result.
Labels join by id; conflicting labels of one id count as good if any is.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcflow.llm.store import carried, stage
from cdcflow.llm.words import Words, chunks, mix, text_buffers

ALPHA = 0.02           # largest share of good rows that all rules may reject in a stratum
DELTA = 0.05           # chance that any of the bounds fails
STRATA = 64            # strata of their own; rarer ones are pooled
GRID = 64              # cutoffs tried per rule
SYMBOLS = b"#*$%&|<>"
SPACES = " \t\n\v\f\r"

SIGNALS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[list(SYMBOLS)] = 1
_UPPER = np.zeros(256, np.int64)
_UPPER[65:91] = 1
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_POINT = np.array([not 0x80 <= b < 0xC0 for b in range(256)])


def repeat_words(words: Words) -> np.ndarray:
    """Per text, the words covered by five-word windows found twice or more in that text."""
    sh, first = words.shingles(lower=False)
    per = np.diff(first)
    docs = np.repeat(np.arange(len(per)), per)
    long = words.count[docs] >= 5
    at = np.flatnonzero(long)
    if not len(at):
        return np.zeros(len(per), np.int64)
    key = mix(sh[at] ^ mix(docs[at].astype(np.uint64) + np.uint64(77)))
    order = np.argsort(key, kind="stable")
    k = key[order]
    same = np.zeros(len(k), bool)
    same[1:] = k[1:] == k[:-1]
    twice = same.copy()
    twice[:-1] |= same[1:]
    hit = at[order[twice]]
    word = words.first[docs[hit]] + (hit - first[docs[hit]])
    cover = np.zeros(len(words.start) + 1, np.int64)
    np.add.at(cover, word, 1)
    np.add.at(cover, word + 5, -1)
    total = np.concatenate([[0], np.cumsum(np.cumsum(cover[:-1]) > 0)])
    return total[words.first[1:]] - total[words.first[:-1]]


def line_counts(text: str) -> tuple[int, int]:
    """Lines with a word, and those of them equal to an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return len(lines), len(lines) - len(set(lines))


MEASURED = ["n_lines", "n_upper", *SIGNALS]


def measure(column: pa.Array) -> list[pa.Array]:
    """The integer signals of a batch of texts, in the order of ``MEASURED``."""
    out: dict[str, list[np.ndarray]] = {k: [] for k in MEASURED}

    def per_text(flags, offsets):
        total = np.concatenate([[0], np.cumsum(flags)])
        return total[offsets[1:]] - total[offsets[:-1]]

    for _, _, data, offsets in chunks(column):
        w = Words(data, offsets)
        out["n_words"].append(w.count)
        out["word_chars"].append(per_text(_POINT[data] & ~_SPACE[data], offsets))
        out["n_symbols"].append(per_text(_SYMBOL[data], offsets))
        out["n_upper"].append(per_text(_UPPER[data], offsets))
        out["n_repeat_words"].append(repeat_words(w))
        raw = data.tobytes()
        lines = [line_counts(raw[x:y].decode()) for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        out["n_lines"].append(np.array([x for x, _ in lines], np.int64))
        out["n_dup_lines"].append(np.array([y for _, y in lines], np.int64))
    return [pa.array(np.concatenate(v).astype(np.int64) if v else np.zeros(0, np.int64)) for v in out.values()]


def _signals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *measure(batch.column(2))], names=["doc_id", "stratum", *MEASURED])


def signals(docs: DataFrame, stratum: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of signals per row of ``docs``."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(stratum.cast("string"), F.lit("")).alias("stratum"), F.col(text_col).cast("string").alias("text"))
    return d.mapInArrow(_signals, "doc_id long, stratum string, " + ", ".join(f"{m} long" for m in MEASURED))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)


def rules() -> dict[str, Column]:
    """Ratios in thousandths; a higher one is worse."""
    words, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "symbols_per_word": F.floor(F.col("n_symbols") * 1000 / words),
        "dup_lines": F.floor(F.col("n_dup_lines") * 1000 / F.greatest(F.col("n_lines"), F.lit(1))),
        "upper_share": F.floor(F.col("n_upper") * 1000 / chars),
        "chars_per_word": F.floor(F.col("word_chars") * 100 / words),
        "lines_per_word": F.floor(F.col("n_lines") * 1000 / words),
    }


def binomial_cdf(k: int, n: int, p: float) -> float:
    if p <= 0:
        return 1.0
    if p >= 1:
        return float(k >= n)
    i = np.arange(0, k + 1)
    lg = np.vectorize(math.lgamma)
    logs = math.lgamma(n + 1) - lg(i + 1) - lg(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
    top = logs.max()
    return float(min(1.0, math.exp(top) * np.exp(logs - top).sum()))


def allowed(k: int, n: int, alpha: float, level: float) -> bool:
    """The exact upper bound of the rate after ``k`` of ``n``, at error ``level``, is at most ``alpha``."""
    return n > 0 and k <= alpha * n and binomial_cdf(k, n, alpha) <= level


def cutoffs(sig: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA, grid: int = GRID) -> dict[tuple[str, str], int]:
    """``(stratum, rule) -> cutoff`` from labelled rows (``doc_id, quality``) that pass the base rules.

    Only counts per stratum, rule and observed ratio on a fixed grid reach the driver.
    """
    good = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    names = list(rules())
    held = sig.where(~base_failed()).join(good, "doc_id").select("stratum", "quality", *[c.alias(r) for r, c in rules().items()])
    # grid: powers of a fixed step above 1, so a bounded number of cells
    step = math.log(1.12)
    cell = lambda c: F.least(F.lit(grid * 2 - 1), F.ceil(F.log1p(F.col(c)) / step)).cast("int")
    long = held.select("stratum", "quality", F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), cell(r).alias("cell")) for r in names])).alias("x")).select("stratum", "quality", "x.*")
    counts = long.groupBy("stratum", "rule", "cell").agg(F.count("*").alias("n"), F.sum((F.col("quality") == 1).cast("long")).alias("good"))
    rows = counts.collect()  # at most strata x rules x cells rows; strata are pooled before
    strata = sorted({r["stratum"] for r in rows})
    tests = max(1, len(strata) * len(names))
    out: dict[tuple[str, str], int] = {}
    for s in strata:
        for r in names:
            mine = sorted(((x["cell"], x["n"], x["good"]) for x in rows if x["stratum"] == s and x["rule"] == r), reverse=True)
            total = sum(g for _, _, g in mine)
            lost, best, gain = 0, None, 0
            for c, n, g in mine:  # reject cells >= c, from the worst down
                lost += g
                gain += n - g
                if not allowed(lost, total, alpha / len(names), delta / tests):
                    break
                if gain:
                    best = c
            if best is not None:
                # the least ratio whose cell is ``best`` or above
                guess = max(0, math.ceil(math.exp((best - 1) * step) - 1) - 1)
                out[(s, r)] = next(v for v in range(guess, guess + 4) if math.ceil(math.log1p(v) / step) >= best)
    return out


def pooled(docs: DataFrame, column: str = "lang", strata: int = STRATA) -> Column:
    """The column with all but its ``strata`` most frequent values pooled."""
    top = docs.groupBy(column).count().orderBy(F.desc("count"), column).limit(strata).collect()
    names = [r[0] for r in top if r[0] is not None]
    return F.when(F.col(column).isin(names), F.col(column)).otherwise(F.lit("")) if names else F.lit("")


def verdict(cut: dict[tuple[str, str], int]) -> list[Column]:
    """The name of each rule whose cutoff a row of signals reaches."""
    failed = []
    for name, value in rules().items():
        hit = F.lit(False)
        for (s, r), c in sorted(cut.items()):
            if r == name:
                hit = hit | ((F.col("stratum") == s) & (value >= c))
        failed.append(F.when(hit, F.lit(name)))
    return failed


def judged(sig: DataFrame, cut: dict[tuple[str, str], int]) -> DataFrame:
    out = sig.withColumn("base_failed", base_failed()).withColumn("failed_rules", F.array_compact(F.array(*verdict(cut))))
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """``doc_id``, signals, ``base_failed``, ``failed_rules`` and ``kept``: a row per row of ``docs``."""
    sig = stage(signals(docs, pooled(docs, stratum)), "signals")
    return judged(sig, cutoffs(sig, labels, alpha, delta))


def keep(docs: DataFrame, labels: DataFrame, stratum: str = "lang", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns.

    Texts are read twice, so they are neither joined nor written in between.
    """
    pool = pooled(docs, stratum)
    cut = cutoffs(stage(signals(docs, pool), "signals"), labels, alpha, delta)
    rows = carried(docs, lambda b: [b.column(0), *measure(b.column(1))], "stratum string, " + ", ".join(f"{m} long" for m in MEASURED),
                   F.coalesce(pool.cast("string"), F.lit("")).alias("stratum"), F.col("text").cast("string").alias("text"))
    return judged(rows, cut).where("kept").select("row.*")
