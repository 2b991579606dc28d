"""Secret scans: candidates by pattern, false positives removed by a random forest.

Candidates are known key formats, values assigned to a telling name, and any long
run of key characters with a digit.  A forest scores them from length, character
classes and transitions between them, entropy, the share of letters that
dictionary words cover, the document's path and the neighbouring words.  It is
fitted on labelled findings (``doc_id, start, end, secret``); where none are
given, findings of fixed formats count as secrets and all others as false
positives; of either kind a bounded sample over all documents is taken.  Spans are scored whole, joined ones also by the
spans they are made of, and the best score counts.  The dictionary is the most frequent words of all
documents.

Offsets are code points, ends exclusive.  Null texts have no candidates.  Rows
repeat as they are, extra columns are ignored, an empty table gives an empty
result; without findings of both kinds every candidate is reported with a null
score and kept.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcflow.llm.store import stage
from cdcflow.llm.trees import Model, forest

SAMPLE_FINDINGS = 20_000   # findings fitted on, at most; half of either kind, by hash over all documents
DICTIONARY = 4_000         # words it holds, at most
LEAST = 5                  # findings of either kind below which nothing is fitted
KEEP = 0.5                 # forest score from which a candidate stands

# Fixed patterns of key formats and telling names.
_FORMATS = re.compile(r"(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])|gh[pousr]_[A-Za-z0-9]{36,}|sk-[A-Za-z0-9]{20,}|xox[abprs]-[A-Za-z0-9-]{10,}"
                      r"|eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}|-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----")
_ASSIGNED = re.compile(r"(?i)\b(?:pass(?:word|wd)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credential)[\"']?[ ]?[:=][ ]?[\"']?([^\s\"']{6,}+)")
_RUN = re.compile(r"(?<![A-Za-z0-9_+/=-])(?=[A-Za-z0-9_+/=-]*[0-9])[A-Za-z0-9_+/=-]{12,}")
_ANY = re.compile(r"[0-9]|AKIA|ASIA|[:=]|gh[pousr]_|sk-|xox|eyJ|-----BEGIN")
_HEX = re.compile(r"[0-9a-f]{16,}|[0-9A-F]{16,}")
_CUES = frozenset("password passwd pwd secret token key apikey api_key access_key auth bearer credential private".split())
_WORD = re.compile(r"[^\W\d_]{2,}")


def candidates(text: str) -> list[tuple[int, int]]:
    """Spans in order, overlapping ones joined."""
    return [span for span, _ in joined(text)]


def joined(text: str) -> list[tuple[tuple[int, int], list[tuple[int, int]]]]:
    """Spans in order, overlapping ones joined, each with the spans it is made of and itself."""
    if not _ANY.search(text):
        return []
    spans = [m.span() for m in _FORMATS.finditer(text)] + [m.span(1) for m in _ASSIGNED.finditer(text)] + [m.span() for m in _RUN.finditer(text)]
    out: list[tuple[int, int]] = []
    parts: list[list[tuple[int, int]]] = []
    for a, b in sorted(set(spans)):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
            parts[-1].append((a, b))
        else:
            out.append((a, b))
            parts.append([(a, b)])
    return [(span, p if span in p else [span, *p]) for span, p in zip(out, parts)]


def known_format(text: str, a: int, b: int) -> bool:
    """Whether a finding has a fixed key format, or is a long hexadecimal value assigned to a telling name."""
    s = text[a:b]
    if _FORMATS.search(s):
        return True
    m = _ASSIGNED.search(text, max(0, a - 32), b)
    return bool(m and _HEX.search(s))


def covered(s: str, words: frozenset[str]) -> float:
    """Share of the letters of ``s`` that words of the dictionary cover, longest first from the left."""
    low, hit, n, i = s.lower(), 0, sum(c.isalpha() for c in s), 0
    while i < len(low):
        for k in range(min(12, len(low) - i), 2, -1):
            if low[i : i + k] in words:
                hit += k
                i += k
                break
        else:
            i += 1
    return hit / n if n else 0.0


def features(text: str, a: int, b: int, path: str, words: frozenset[str]) -> list[float]:
    s = text[a:b]
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "s" for c in s]
    moves = Counter(zip(kinds, kinds[1:]))
    n = len(s)
    entropy = -sum(k / n * math.log2(k / n) for k in Counter(s).values())
    before, after = text[max(0, a - 40) : a], text[b : b + 24]
    near = [w.lower() for w in re.split(r"[^A-Za-z_]+", before) if w][-3:]
    parts = [p for p in re.split(r"[/\\.]", path.lower()) if p]
    return [
        b - a, *(kinds.count(k) / n for k in "duls"), *(moves[(x, y)] / n for x in "dul" for y in "dul" if x != y), entropy, covered(s, words),
        float(any(w in _CUES for w in near)), float(bool(re.search(r"[:=][\s\"']*$", before))), float(before[-1:] in "\"'"), float(after[:1] in "\"'"),
        float("/" in s), float("@" in s or after[:1] == "@"), float("." in after[:2] and after[1:2].isalnum()), float(bool(_HEX.fullmatch(s))),
        len(parts), float(any(p in ("test", "tests", "example", "examples", "docs", "fixtures") for p in parts)),
        sum(w in words for w in near) / max(1, len(near)), float(before[-1:] == "+" or s[:1] == "+"),
    ]


@dataclass
class Scanner:
    model: Model
    words: frozenset[str]

    def score(self, text: str, path: str, found: list[tuple[tuple[int, int], list[tuple[int, int]]]]) -> list[float]:
        """The best score among the parts of each span."""
        if not found:
            return []
        each = self.model.score(np.array([features(text, a, b, path, self.words) for _, parts in found for a, b in parts]))
        return np.maximum.reduceat(each, np.cumsum([0, *(len(parts) for _, parts in found[:-1])])).tolist()


def _view(docs: DataFrame, id_col: str, text_col: str, path_col: str | None) -> DataFrame:
    path = F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col and path_col in docs.columns else F.lit("")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), path.alias("path"))


def dictionary(docs: DataFrame, most: int = DICTIONARY) -> frozenset[str]:
    """The most frequent words of all documents."""
    word = F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}{3,12})"), F.lit(1))).alias("word")
    rows = docs.select(word).groupBy("word").count().orderBy(F.desc("count"), "word").limit(most).collect()
    return frozenset(r["word"] for r in rows)


def fit(docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> Scanner | None:
    """A scanner from labelled findings (``doc_id, start, end, secret``) or, without them, from fixed formats."""
    d = _view(docs, id_col, text_col, path_col)
    words = dictionary(d)
    if labelled is None:
        some = d.select("doc_id", "text", "path", F.lit(None).cast("array<struct<start:long,end:long,secret:boolean>>").alias("known"))
    else:
        given = labelled.select(F.col("doc_id").cast("long").alias("doc_id"), F.struct(F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), F.col("secret").cast("boolean").alias("secret")).alias("k"))
        given = given.dropna(subset=["doc_id"])
        few = [given.where(F.col("k.secret") == kind).orderBy(F.xxhash64("doc_id", "k"), "doc_id", "k").limit(SAMPLE_FINDINGS // 2) for kind in (True, False)]
        some = d.join(F.broadcast(few[0].union(few[1]).groupBy("doc_id").agg(F.collect_list("k").alias("known"))), "doc_id").select("doc_id", "text", "path", "known")

    most = SAMPLE_FINDINGS // 2

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {0: [], 1: []}  # findings of either kind by rank, the least ones
        worst = {0: 1 << 63, 1: 1 << 63}

        def trim(secret: int):
            held[secret].sort()
            del held[secret][most:]
            if len(held[secret]) == most:
                worst[secret] = held[secret][-1][0]

        for batch in batches:
            for doc, text, path, known in zip(*batch.columns):
                doc, text, path, known = doc.as_py(), text.as_py() or "", path.as_py(), known.as_py()
                found = [(a, b, known_format(text, a, b)) for _, parts in joined(text) for a, b in parts] if known is None else [(k["start"], k["end"], k["secret"]) for k in known]
                for a, b, secret in found:
                    if secret is not None and 0 <= a < b <= len(text):
                        low = max(0, a - 40)
                        cut = text[low : b + 24]
                        rank = int.from_bytes(hashlib.blake2b(f"{doc} {a} {b} {cut}".encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)
                        rows = held[int(secret)]
                        if rank <= worst[int(secret)]:
                            rows.append((rank, cut, a - low, b - low, path))
                            if len(rows) >= 2 * most:
                                trim(int(secret))
        for secret, rows in held.items():
            trim(secret)
            for k in range(0, len(rows), 1024):
                part = rows[k : k + 1024]
                x = [features(cut, a, b, path, words) for _, cut, a, b, path in part]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), pa.array([secret] * len(part), pa.int64()), pa.array([r[0] for r in part], pa.int64())], names=["x", "secret", "rank"])

    found = stage(some.mapInArrow(learn, "x array<double>, secret long, rank long"), "findings")
    rows = [r for kind in (0, 1) for r in found.where(F.col("secret") == kind).orderBy("rank", "x").limit(most).collect()]
    rows.sort(key=lambda r: (r["secret"], r["x"]))
    y = np.array([r["secret"] for r in rows], float)
    if min((y == 1).sum(), (y == 0).sum()) < LEAST:
        return None
    x = np.array([r["x"] for r in rows])
    # secrets are rare: repeat them so that both kinds weigh alike
    times = max(1, int((y == 0).sum() // max(1, (y == 1).sum())))
    at = np.concatenate([np.arange(len(y)), np.tile(np.flatnonzero(y == 1), times - 1)])
    return Scanner(forest(x[at], y[at]), words)


def scan(docs: DataFrame, scanner: Scanner | None, keep: float = KEEP, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """``doc_id, start, end, value_sha256, score, secret`` per candidate; the value itself is not repeated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text, path in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                text = text.as_py()
                if text and (found := joined(text)):
                    scores = scanner.score(text, path.as_py(), found) if scanner else [None] * len(found)
                    rows += [(doc, a, b, hashlib.sha256(text[a:b].encode()).hexdigest(), s, s is None or s >= keep) for ((a, b), _), s in zip(found, scores)]
            cols = list(zip(*rows)) if rows else [[]] * 6
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["doc_id", "start", "end", "value_sha256", "score", "secret"])

    return _view(docs, id_col, text_col, path_col).mapInArrow(run, "doc_id long, start long, end long, value_sha256 string, score double, secret boolean")
