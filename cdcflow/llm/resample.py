"""Importance resampling towards a target distribution, over hashed word runs.

Features of a text are its runs of one to three consecutive words (A-Z lowered),
hashed by CRC-32 into buckets.  A bucket's gain is the log ratio of its share in
the target texts and in the corpus; a text's weight is the sum of the gains of
its features, and a Gumbel draw from its id makes the ranking a sample without
replacement.

Method: an Aho-Corasick dictionary.

1. The most frequent distinct words of both tables (``WORDS`` at most, a bounded
   broadcast) are keys of an automaton, each between two delimiters, so that a
   key can only match a whole word.  A key's payload is the CRC and the length
   of its word.
2. Scanning a text emits one payload per word of the dictionary.  Words that the
   dictionary lacks get their CRC from their own bytes, so results do not depend
   on the dictionary.
3. The CRC of a run follows from adjacent payloads alone: appending ``n`` bytes
   to a text is a linear map of its CRC (a table lookup), xor the CRC of what is
   appended.  No run is ever built as a text.

The corpus is scanned twice, once to count buckets (a vector per task) and once to
score; scored rows are short, and are ranked by ranges of the score.

Null and empty texts have no features and weight 0.  Words of invalid UTF-8 are
taken by their bytes.  A null id draws as the text ``42:`` and comes last among
equal scores; rows that repeat are ranked one after the other.  Empty tables give
empty results; an empty target has T = 0.  Extra columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcflow.llm.order import numbered
from cdcflow.llm.store import stage
from cdcflow.llm.words import chunks

BUCKETS = 10_000
WORDS = 1 << 15        # words of the dictionary, at most
LEAST_WORDS = 20       # a drawn document has so many
SHARE = 5              # per cent of those documents that are drawn
SEED = 42
_HELD = 1 << 18        # distinct words a task holds before it hands counts on
_DIRECT = 64           # appended lengths with a table of their own

# bytes to lower-cased word bytes, every delimiter to a space
_FOLD = bytes((b + 32 if 65 <= b <= 90 else b) if 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
_FOLD_ARRAY = np.frombuffer(_FOLD, np.uint8)


def _one_byte() -> np.ndarray:
    """``table[j, b]``: what byte ``j`` of a CRC becomes when a zero byte is appended (no pre- or post-inversion)."""
    word = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        word = np.where(word & 1, (word >> 1) ^ np.uint32(0xEDB88320), word >> 1)
    shifted = np.arange(256, dtype=np.uint32)
    return np.stack([word, shifted, shifted << np.uint32(8), shifted << np.uint32(16)])


def _map(table: np.ndarray, x: np.ndarray) -> np.ndarray:
    return table[0, x & 255] ^ table[1, (x >> np.uint32(8)) & 255] ^ table[2, (x >> np.uint32(16)) & 255] ^ table[3, x >> np.uint32(24)]


def _tables() -> tuple[np.ndarray, np.ndarray]:
    one = _one_byte()
    few = [np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * j) for j in range(4)])]
    for _ in range(_DIRECT):
        few.append(np.stack([_map(one, row) for row in few[-1]]))
    twice = [one]
    for _ in range(31):
        twice.append(np.stack([_map(twice[-1], row) for row in twice[-1]]))
    return np.stack(few), np.stack(twice)


_FEW, _TWICE = _tables()


def extend(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The part that each CRC adds to the CRC of its text with ``n`` more bytes."""
    m = np.minimum(n, _DIRECT)
    out = (_FEW[m, 0, crc & 255] ^ _FEW[m, 1, (crc >> np.uint32(8)) & 255] ^ _FEW[m, 2, (crc >> np.uint32(16)) & 255] ^ _FEW[m, 3, crc >> np.uint32(24)])
    far = np.flatnonzero(n > _DIRECT)
    if len(far):
        rest, x = n[far] - _DIRECT, out[far]
        for k in range(int(rest.max()).bit_length()):
            x = np.where((rest >> k) & 1, _map(_TWICE[k], x), x)
        out[far] = x
    return out


class Scanner:
    """The automaton over the dictionary; ``words`` are lower-cased bytes."""

    def __init__(self, words: list[bytes]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()  # a payload is a Python integer of 56 bits
        for w in words:  # one character per byte, so that places are byte offsets
            self.automaton.add_word(f" {w.decode('latin-1')} ", crc32(w) << 24 | len(w))
        self.filled = bool(words)
        if self.filled:
            self.automaton.make_automaton()

    def payloads(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(crc, length, first)`` of the words of consecutive texts, text ``d`` at ``first[d]:first[d + 1]``."""
        texts = len(offsets) - 1
        # texts side by side, a space before each and one at the end
        flat = np.full(len(data) + texts + 1, 32, np.uint8)
        flat[np.arange(len(data)) + np.repeat(np.arange(1, texts + 1), np.diff(offsets))] = _FOLD_ARRAY[data]
        inside = (flat != 32).astype(np.int8)
        step = np.diff(inside)
        start, end = np.flatnonzero(step == 1) + 1, np.flatnonzero(step == -1) + 1
        first = np.searchsorted(start, offsets + np.arange(texts + 1))
        crc, known = np.zeros(len(start), np.uint32), np.zeros(len(start), bool)
        raw = flat.tobytes()
        if self.filled and len(start):
            found = list(self.automaton.iter(raw.decode("latin-1")))
            if found:
                found = np.array(found, np.int64)
                at = np.searchsorted(end, found[:, 0])
                crc[at] = found[:, 1] >> 24
                known[at] = True
        for k in np.flatnonzero(~known).tolist():
            crc[k] = crc32(raw[start[k] : end[k]])
        return crc, end - start, first

    def buckets(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per run length, ``(bucket, first)`` of all runs of every text."""
        crc, length, first = self.payloads(data, offsets)
        count = np.diff(first)
        yield (crc % np.uint32(BUCKETS)).astype(np.int64), first
        # the same words with a space before them
        spaced = crc ^ extend(np.full(len(crc), crc32(b" "), np.uint32), length)
        run = crc
        for words in (2, 3):
            a, b = run[: len(crc) - words + 1], words - 1
            run = extend(a, length[b:] + 1) ^ spaced[b:]
            per = np.maximum(count - b, 0)
            begin = np.concatenate([[0], np.cumsum(per)])
            whole = np.repeat(first[:-1] - begin[:-1], per) + np.arange(begin[-1])
            yield (run[whole] % np.uint32(BUCKETS)).astype(np.int64), begin


_SCANNERS: dict[str, Scanner] = {}


def _scanner(key: str, words) -> Scanner:
    """One scanner per Python worker and dictionary."""
    if key not in _SCANNERS:
        _SCANNERS.clear()
        _SCANNERS[key] = Scanner(words.value)
    return _SCANNERS[key]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter[bytes] = Counter()

    def hand_on():
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

    for batch in batches:
        for _, _, data, offsets in chunks(batch.column(0)):
            raw = data.tobytes().translate(_FOLD)
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                seen.update(raw[a:b].split())
            if len(seen) >= _HELD:
                yield hand_on()
                seen.clear()
    if seen:
        yield hand_on()


def _texts(table: DataFrame) -> DataFrame:
    return table.select(F.col("text").cast("string").alias("text"))


def dictionary(corpus: DataFrame, target: DataFrame, words: int = WORDS) -> list[bytes]:
    """The most frequent words of both tables, ``words`` at most.

    Counts fall into cells of about a tenth; the cells from the top that hold no more
    than ``words`` words together are taken, so a few hundred cells and at most
    ``words`` words reach the driver, whatever the vocabulary.
    """
    counts = _texts(corpus).unionByName(_texts(target)).mapInArrow(_count_words, "word binary, n long")
    held = stage(counts.groupBy("word").agg(F.sum("n").alias("n")).select("word", F.floor(F.log2(F.col("n")) * 8).cast("int").alias("cell")), "vocabulary")
    least, left = None, words
    for r in sorted(held.groupBy("cell").count().collect(), reverse=True):
        if r["count"] > left:
            break
        least, left = r["cell"], left - r["count"]
    return [] if least is None else sorted(bytes(r["word"]) for r in held.where(F.col("cell") >= least).select("word").collect())


def bucket_counts(table: DataFrame, key: str, words) -> np.ndarray:
    """Features per bucket over all texts; a task adds its texts up first."""

    def part(batches):
        total = np.zeros(BUCKETS, np.int64)
        scanner = _scanner(key, words)
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(0)):
                for bucket, _ in scanner.buckets(data, offsets):
                    total += np.bincount(bucket, minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])

    out = np.zeros(BUCKETS, np.int64)
    for r in _texts(table).mapInArrow(part, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's shares, each with one more in every bucket."""
    s_all, t_all = float(corpus.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, key: str, words) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` per row."""

    def run(batches):
        scanner = _scanner(key, words)
        for batch in batches:
            for a, b, data, offsets in chunks(batch.column(1)):
                n_words, features, weight = None, np.zeros(b - a, np.int64), np.zeros(b - a, np.int64)
                for bucket, first in scanner.buckets(data, offsets):
                    total = np.concatenate([[0], np.cumsum(gain[bucket])])
                    n_words = np.diff(first) if n_words is None else n_words
                    features += np.diff(first)
                    weight += total[first[1:]] - total[first[:-1]]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *map(pa.array, (n_words.astype(np.int64), features, weight))],
                                                 names=["doc_id", "n_words", "n_features", "weight"])

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return d.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, share: int = SHARE, least_words: int = LEAST_WORDS, seed: int = SEED, words: int = WORDS) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` per row of ``docs``; ``rank`` is null where not drawn.

    ``share`` per cent (rounded down) of the documents of ``least_words`` words or more are drawn.
    """
    spark = docs.sparkSession
    key, vocabulary = uuid.uuid4().hex, spark.sparkContext.broadcast(dictionary(docs, target, words))
    gain = gains(bucket_counts(docs, key, vocabulary), bucket_counts(target, key, vocabulary))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = stage(weighed(docs, gain, key, vocabulary).withColumn("score", F.col("weight") + noise), "scored")
    may = F.col("n_words") >= least_words
    drawn = (scored.where(may).count() * share) // 100
    ranked = numbered(scored, [], [F.when(may, 0).otherwise(1), F.desc("score"), F.asc_nulls_last("doc_id"), F.col("n_features"), F.col("weight")], "scored")
    return ranked.select("doc_id", "n_words", "n_features", "weight", "score", F.when(may & (F.col("pos") < drawn), F.col("pos") + 1).alias("rank"))
