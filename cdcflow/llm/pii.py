"""Personal data: base patterns plus boosted candidates.

Base kinds (e-mail, IP address, card, phone) are fixed patterns with checks; their
spans are always kept.  High-recall generators propose further, overlapping
spans (unsigned phone numbers, national ids, bank accounts, spelled-out
e-mails, any long digit group).  Boosted trees score those from format and
context features; they are fitted on the candidates of all texts, with base matches that
pass their checks and proposals that overlap one as positives, and those that
only fail as negatives.  Candidates are counted by their features (numbers above
255 as 255); trees need the counts only, which are summed by the tasks where there
are more than ``LOCAL``.  A threshold (a multiple of 1 / ``GRID``) is set on all
held-out candidates so that the lower confidence bound of precision reaches
``PRECISION``; without enough candidates nothing is added.

Offsets are code points, ends exclusive.  Null texts are empty and have none.
Rows repeat as they are, extra columns are ignored, an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcflow.llm.store import carried, stage
from cdcflow.llm.trees import VALUES, Counted, Model, Tree, boost_counted

LOCAL = 1 << 17      # distinct features up to which the driver adds up the counts
GRID = 1 << 16
PRECISION = 0.9

BASE = ["email", "ip", "card", "phone"]
KINDS = [*BASE, "account", "national_id", "number"]

# Fixed patterns, written so that scanning stays linear.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_EXTRA = [
    ("email", re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}(?: at | ?\(at\) ?| ?\[at\] ?)[A-Za-z0-9-]{1,63}(?:(?: dot | ?\(dot\) ?| ?\[dot\] ?|\.)[A-Za-z]{2,24}){1,4}(?![A-Za-z0-9])")),
    ("phone", re.compile(r"(?<![0-9+(])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")),
    ("national_id", re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")),
    ("account", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?![A-Za-z0-9])")),
    ("number", re.compile(r"(?<![0-9.+-])[0-9](?:[ ().-]?[0-9]){8,18}(?![0-9])")),
]
_CUES = frozenset("tel phone call mobile cell fax telefon tarjeta carte card visa iban ssn account konto ip host server mail email e-mail contact kontakt".split())


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last, i = 0, text.find("@")
    while i >= 0:
        j = i
        while j > last and text[j - 1] in _LOCAL:
            j -= 1
        m = _DOMAIN.match(text, i + 1) if j < i else None
        if m:
            last = m.end()
            yield j, last
        i = text.find("@", max(i + 1, last))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_matches(text: str) -> list[tuple[str, int, int, bool]]:
    """``(kind, start, end, passes)`` of the base patterns."""
    out = [("email", a, b, True) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            out.append(("ip", m.start(), m.end(), all(map(_small, m.group().split(".")))))
        for m in _CARD.finditer(text):
            d = _digits(m.group())
            out.append(("card", m.start(), m.end(), 14 <= len(d) <= 19 and luhn(d)))
        if "+" in text:
            for m in _PHONE.finditer(text):
                out.append(("phone", m.start(), m.end(), 10 <= len(_digits(m.group())) <= 15))
    return out


def proposals(text: str) -> list[tuple[str, int, int]]:
    """Further candidate spans; they may overlap."""
    if not _DIGIT.search(text):
        found = _EXTRA[:1] if " at " in text or "(at)" in text or "[at]" in text else []
    else:
        found = _EXTRA
    return [(k, m.start(), m.end()) for k, p in found for m in p.finditer(text)]


def features(text: str, start: int, end: int) -> list[float]:
    s = text[start:end]
    groups = re.findall(r"[0-9]+", s)
    lens = [len(g) for g in groups] or [0]
    d = "".join(groups)
    before, after = text[max(0, start - 32) : start], text[end : end + 16]
    cue = any(w.strip(".,:;()=").lower() in _CUES for w in before.split()[-3:])
    return [
        end - start, len(d), len(groups), max(lens), min(lens), float(13 <= len(d) <= 19 and luhn(d)), float(s.startswith("+")),
        s.count("."), s.count("-"), s.count(" "), float("(" in s), float("@" in s or " at " in s or "(at)" in s or "[at]" in s), sum(c.isalpha() for c in s),
        float(len(groups) == 4 and all(map(_small, groups))), float(cue), float(before[-1:].isalnum()), float(after[:1].isalnum()), float(before[-1:] in "=:#/_-"),
    ]


def labelled(text: str) -> list[tuple[int, int, bool]]:
    """``(start, end, good)`` of base matches and of the proposals that overlap one."""
    base = sorted((a, b, good) for _, a, b, good in base_matches(text))
    starts = [a for a, _, _ in base]
    reach = list(accumulate((b for _, b, _ in base), max))
    passing = list(accumulate((b if good else -1 for _, b, good in base), max))
    near = [(a, b, bisect_left(starts, b) - 1) for _, a, b in proposals(text)]  # the last that starts before its end
    return base + [(a, b, passing[i] > a) for a, b, i in near if i >= 0 and reach[i] > a]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labelled candidates of texts, counted by features; a third of the ids is held out."""
    for batch in batches:
        n, good = Counter(), Counter()
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py() or ""
            if found := labelled(text):
                held = hashlib.sha256(str(doc).encode()).digest()[0] % 3 == 0
                for a, b, ok in found:
                    key = held, bytes(min(int(v), VALUES - 1) for v in features(text, a, b))
                    n[key] += 1
                    good[key] += ok
        held, x = zip(*n) if n else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.bool_()), pa.array(x, pa.binary()), pa.array(n.values(), pa.int64()), pa.array([good[k] for k in n], pa.int64())],
                                         names=["held", "x", "n", "good"])


def _rows(batch: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x = b"".join(batch.column(0).to_pylist())
    return np.frombuffer(x, np.uint8).reshape(batch.num_rows, -1), *(np.asarray(batch.column(i).to_numpy()) for i in (1, 2))


def threshold(score: np.ndarray, good: np.ndarray, precision: float = PRECISION, n: np.ndarray | None = None) -> float | None:
    """The lowest score from which the Wilson lower bound of precision reaches ``precision``;
    ``n`` candidates of each score, ``good`` of them so."""
    at = np.argsort(-score, kind="stable")
    hits, n = np.cumsum(good[at]), np.cumsum(np.ones(len(at)) if n is None else n[at])
    z, p = 1.96, hits / n
    low = (p + z * z / (2 * n) - z * np.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    ends = np.flatnonzero((low >= precision) & np.append(np.diff(score[at]) != 0, True))
    return float(score[at][ends[-1]]) if len(ends) else None


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", local: int = LOCAL) -> tuple[Model, float] | None:
    """Boosted trees and their threshold from the candidates of all texts; ``None`` without two classes."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counts = d.where(F.col("text").rlike("[0-9@]")).mapInArrow(_counted, "held boolean, x binary, n long, good long")
    counts = stage(counts.groupBy("held", "x").agg(F.sum("n").alias("n"), F.sum("good").alias("good")), "candidates")
    size = {r.held: r for r in counts.groupBy("held").agg(F.count("*").alias("rows"), F.sum("n").alias("n"), F.sum("good").alias("good")).collect()}
    if len(size) < 2 or not 0 < size[False].good < size[False].n:
        return None
    mine, held = (counts.where(F.col("held") == side).select("x", "n", "good") for side in (False, True))
    width = len(features("", 0, 0))

    def total(model: Model, tree: Tree) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    g, h = Counted(*_rows(batch)).sums(model, tree).reshape(2, -1)
                    at = np.flatnonzero(h)
                    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(g[at]), pa.array(h[at])], names=["at", "g", "h"])

        out = np.zeros((2, len(tree.value), width, VALUES), np.int64)
        parts = mine.mapInArrow(run, "at long, g long, h long").groupBy("at").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow()
        out.reshape(2, -1)[:, parts.column(0).to_numpy()] = parts.column(1).to_numpy(), parts.column(2).to_numpy()
        return out

    if size[False].rows <= local:
        total = Counted(*_rows(mine.toArrow())).sums
    model = boost_counted(total, width, size[False].good / size[False].n)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, n, good = _rows(batch) if batch.num_rows else (np.zeros((0, width), np.uint8), *[np.zeros(0, np.int64)] * 2)
            yield pa.RecordBatch.from_arrays([pa.array(np.floor(model.score(x) * GRID).astype(np.int64)), pa.array(n), pa.array(good)], names=["score", "n", "good"])

    cells = held.mapInArrow(scored, "score long, n long, good long").groupBy("score").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).toArrow()  # GRID rows at most
    score, n, good = (cells.column(i).to_numpy() for i in range(3))
    cut = threshold(score / GRID, good, n=n)
    return None if cut is None else (model, cut)


def find(text: str, fitted: tuple[Model, float] | None) -> tuple[list, list]:
    """``(base spans, all spans)`` of ``(start, kind number, end)`` in order."""
    base = sorted((a, KINDS.index(k), b) for k, a, b, good in base_matches(text) if good)
    more = []
    if fitted and (offered := proposals(text)):
        score = fitted[0].score(np.array([features(text, a, b) for _, a, b in offered]))
        ranked = sorted((-s, a, KINDS.index(k), b) for s, (k, a, b) in zip(score, offered) if s >= fitted[1])
        taken = list(base)
        for _, a, k, b in ranked:  # best first; a span that touches a kept one adds nothing
            if all(b <= x or y <= a for x, _, y in taken):
                taken.append((a, k, b))
                more.append((a, k, b))
    return base, sorted(base + more)


def span_text(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def redact(text: str, spans) -> str:
    """``text`` with every run of overlapping spans replaced by its first kind's name."""
    out, at, end = [], 0, -1
    for a, k, b in spans:
        if a >= end:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
            end = b
        end = max(end, b)
        at = end
    return "".join(out) + text[at:]


RESULT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, redacted string"


def scan(docs: DataFrame, fitted: tuple[Model, float] | None, with_text: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, digest and spans per row; ``redacted`` only ``with_text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            rows = []
            for value in batch.column(1):
                text = value.as_py()
                base, spans = find(text, fitted) if text else ([], [])
                n = [sum(k == i for _, k, _ in base) for i in range(len(BASE))]
                sha = hashlib.sha256(span_text(base).encode()).hexdigest() if base else nothing
                rows.append((*n, sha, span_text(spans), (redact(text, spans) if spans else text) if with_text else None))
            cols = list(zip(*rows)) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64()) for c in cols[:4]], *[pa.array(c, pa.string()) for c in cols[4:]]],
                                             names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "redacted"])

    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return d.mapInArrow(run, RESULT)


def redacted(docs: DataFrame, fitted: tuple[Model, float] | None, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of its texts replaced by its kind; all columns and rows stay, null texts too."""

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        out = []
        for value in batch.column(0):
            text = value.as_py()
            spans = find(text, fitted)[1] if text else []
            out.append(redact(text, spans) if spans else text)
        return [pa.array(out, pa.string())]

    rows = carried(docs, run, "clean string", F.col(text_col).cast("string").alias("text"))
    return rows.select(*[F.col("clean").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns])
