"""Best-two-fit packing of tokenised texts into fixed-length sequences.

Texts become ids of a public byte-level BPE file (a parameter) plus an end id.
A text longer than a sequence is cut into whole-sequence pieces, its first piece
taking the remainder; whole-sequence pieces are sequences of their own.  All
other pieces are dealt by hash into shards of about ``SHARD`` pieces and packed
there from their lengths alone: a bin takes the largest piece left, then greedily
the largest that fits; if a gap remains, the bin's smallest piece is replaced by
the two unpacked pieces whose sum fits the widened gap most tightly.  A shard
leaves at most a few part-filled bins, so the share lost does not grow.

Null texts are empty (one end id).  Repeated rows and ids are packed as often as
they come; extra columns are ignored; an empty table gives an empty result.
Special-token strings in a text are ordinary text.
"""

from __future__ import annotations

import functools
import json
import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcflow.llm.store import stage

SEQ_LEN = 1024
EOS = 2
SHARD = 16384
CACHE = 400_000       # words in each of the two generations that a worker remembers

# The byte-level alphabet of GPT-2-style files: printable bytes stand for
# themselves, the others for the code points from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


class Encoder:
    """``ids(text)`` as little-endian uint32 bytes, equal to the tokenizer's own.

    Pieces of a text are independent of one another, so ids are remembered per
    space-delimited word; unseen words go through the file's BPE model.  Two
    generations of words are held; the older is dropped when the newer is full.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tok = Tokenizer.from_file(path if os.path.sep in path else public_tokenizers.path(path))
        self.tok.encode_special_tokens = True
        self.merge = self._merger()
        self.pieces = regex.compile(public_tokenizers.PATTERN).findall
        # white space that does not stand alone between words, and controls on which regex libraries differ
        self.runs = regex.compile(r"\s\s|^\s|\s$").search
        self.controls = regex.compile("[\x1c-\x1f\x85]").search
        self.marks: dict[str, bytes] = {}
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.line = self.piece("\n")

    def _merger(self):
        """Ids of a piece's bytes.  Where the file numbers its tokens in merge order, a
        rank-based encoder over the file's own vocabulary gives the same ids sooner."""
        import tiktoken

        merges = json.loads(self.tok.to_str())["model"]["merges"]
        vocab = self.tok.get_vocab()
        ids = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in merges]
        plain = {c: b for b, c in _BYTES.items()}
        if ids == sorted(set(ids)) and all(c in vocab and vocab[c] < ids[0] for c in plain):
            special = set(t.content for t in self.tok.get_added_tokens_decoder().values())
            ranks = {bytes(map(plain.__getitem__, t)): i for t, i in vocab.items() if t not in special}
            return tiktoken.Encoding("file", pat_str=r".+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        model = self.tok.model.tokenize
        return lambda raw: [t.id for t in model("".join(map(_BYTES.__getitem__, raw)))]

    def piece(self, p: str) -> bytes:
        return array("I", self.merge(p.encode())).tobytes()

    def mark(self, c: str) -> bytes:
        """Ids of a character that follows a word."""
        got = self.marks.get(c)
        if got is None:
            got = b"".join(map(self.piece, self.pieces("a" + c)[1:]))
            if len(self.marks) < 4096:
                self.marks[c] = got
        return got

    def learn(self, key: str) -> bytes:
        """Ids of a word with the space before it; of one without, for a key that starts with a space."""
        got = self.old.get(key)
        if got is None:
            if key.isalpha():
                got = self.piece(" " + key)
            elif key[:-1].isalpha() and not key[-1].isspace():  # a word and one mark
                got = self.word(key[:-1]) + self.mark(key[-1])
            else:
                got = self.split(key[1:] if key[:1] == " " else " " + key)
        if len(self.new) >= CACHE:
            self.old, self.new = self.new, {}
        if len(key) < 64:
            self.new[key] = got
        return got

    def split(self, text: str) -> bytes:
        return b"".join(map(self.piece, self.pieces(text)))

    def word(self, key: str) -> bytes:
        return self.new.get(key) or self.learn(key)

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        if self.controls(text):
            return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if self.runs(text):
            word = self.word  # pieces with the space before them are words
            return b"".join([word(p[1:]) if p[0] == " " and p[1:].isalpha() else word(" " + p) if not p.isspace() else self.piece(p) for p in self.pieces(text)])
        out = []
        known, learn, line = self.new.get, self.learn, self.line
        for part in text.split("\n"):
            first, *rest = part.split(" ")
            out += (line, self.word(" " + first))
            known = self.new.get
            out += [known(w) or learn(w) for w in rest]
        return b"".join(out[1:])


@functools.cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


PIECES = "doc_id long, piece long, start long, length long, ids_crc32 long, ids binary"


def _cutter(path: str, seq_len: int, eos: int, with_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        end = np.array([eos], "<u4").tobytes()
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = enc.ids(text.as_py() or "") + end
                total = len(ids) // 4
                at, k = 0, 0
                while at < total:
                    n = (total % seq_len or seq_len) if k == 0 else seq_len
                    part = ids[4 * at : 4 * (at + n)]
                    rows.append((doc, k, at, n, zlib.crc32(part), part if with_ids else None))
                    at, k = at + n, k + 1
            cols = list(zip(*rows)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols[:5]] + [pa.array(cols[5], pa.binary())],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    return cut


def pack_lengths(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """``(bin, offset)`` of every length (1..size) by best-two-fit."""
    lengths = np.asarray(lengths, np.int64)
    order = np.argsort(lengths, kind="stable")
    edges = np.searchsorted(lengths[order], np.arange(size + 2))
    left = [order[edges[n] : edges[n + 1]].tolist() for n in range(size + 1)]
    mask = sum(1 << n for n in range(1, size + 1) if left[n])
    flip = sum(1 << (size - n) for n in range(1, size + 1) if left[n])
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)

    def take(n: int) -> int:
        nonlocal mask, flip
        row = left[n].pop()
        if not left[n]:
            mask &= ~(1 << n)
            flip &= ~(1 << (size - n))
        return row

    def give(n: int, row: int) -> None:
        nonlocal mask, flip
        left[n].append(row)
        mask |= 1 << n
        flip |= 1 << (size - n)

    def two(low: int, high: int) -> tuple[int, int] | None:
        """The pair left with the largest sum in ``(low, high]``."""
        for t in range(high, low, -1):
            both = mask & (flip >> (size - t))
            while both:
                a = both.bit_length() - 1
                if 2 * a != t or len(left[a]) > 1:
                    return a, t - a
                both &= ~(1 << a)
        return None

    k = 0
    while mask:
        held: list[tuple[int, int]] = []
        gap = size
        while fits := mask & ((1 << (gap + 1)) - 1):
            n = fits.bit_length() - 1
            held.append((n, take(n)))
            gap -= n
        if gap and len(held) > 1:
            n, row = held[-1]  # greedy filling takes ever smaller ones
            if pair := two(n, gap + n):
                held.pop()
                held += [(x, take(x)) for x in pair]
                give(n, row)
        at = 0
        for n, row in held:
            bins[row], offsets[row] = k, at
            at += n
        k += 1
    return bins, offsets


def pack(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", seq_len: int = SEQ_LEN, eos: int = EOS,
         with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset`` per piece.

    ``ids`` (little-endian uint32) is null unless ``with_ids``.
    """
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    cut = stage(d.mapInArrow(_cutter(tokenizer, seq_len, eos, with_ids), PIECES), "pieces")
    whole = (cut.where(F.col("length") == seq_len)
             .withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long")))
    part = cut.where(F.col("length") < seq_len)
    shards = max(1, -(-part.count() // SHARD))
    part = part.withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "ids_crc32"], kind="stable")
        bins, offsets = pack_lengths(pdf["length"].to_numpy(), seq_len)
        return pdf.drop(columns="shard").assign(sequence_id=int(pdf["shard"].iloc[0]) * 2**32 + bins, offset=offsets)

    packed = part.groupBy("shard").applyInPandas(fill, PIECES + ", sequence_id long, offset long")
    return packed.unionByName(whole)


def sequences(pieces: DataFrame) -> DataFrame:
    """``sequence_id, length, ids``: the token ids of whole sequences from ``pack(with_ids=True)``."""
    parts = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"), F.sum("length").alias("length"))
    joined = F.aggregate("p", F.lit(b"").cast("binary"), lambda acc, x: F.concat(acc, x["ids"]))
    return parts.select("sequence_id", "length", joined.alias("ids"))
