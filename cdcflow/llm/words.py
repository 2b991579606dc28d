"""Vectorised word and shingle hashing over Arrow text columns.

Words are maximal runs of bytes other than space and 0x09-0x0D (UTF-8 keeps
multi-byte characters clear of those), so offsets work on the raw buffers of a
whole Arrow batch without building Python strings.  A null text is empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SHINGLE = 5
CHUNK_BYTES = 1 << 20

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_MULT = _rng.integers(0, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_POW: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse modulo 2**64."""
    if len(_POW["up"]) <= n:
        for name, base in (("up", _BASE), ("down", _BASE_INV)):
            steps = np.full(max(n + 1, CHUNK_BYTES + 1), base, np.uint64)
            steps[0] = 1
            _POW[name] = np.cumprod(steps, dtype=np.uint64)
    up, down = _POW["up"], _POW["down"]
    if n > 8 * CHUNK_BYTES:  # a very long text: don't keep its tables
        _POW.update(up=up[: CHUNK_BYTES + 1].copy(), down=down[: CHUNK_BYTES + 1].copy())
    return up, down


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """Words of consecutive texts: ``start``/``end`` byte offsets into ``data``,
    ``first[d]:first[d + 1]`` the words of text ``d``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        n = len(data)
        word = ~_SPACE[data]
        before = np.empty(n, bool)
        after = np.empty(n, bool)
        if n:
            before[0] = False
            before[1:] = word[:-1]
            after[-1] = False
            after[:-1] = word[1:]
            cuts = offsets[1:-1]
            cuts = cuts[(cuts > 0) & (cuts < n)]
            before[cuts] = False
            after[cuts - 1] = False
        self.start = np.flatnonzero(word & ~before)
        self.end = np.flatnonzero(word & ~after) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)

    def hashes(self, lower: bool = True) -> np.ndarray:
        """A 64-bit hash per word (A-Z folded to a-z when ``lower``)."""
        n = len(self.data)
        up, down = _powers(n)
        total = np.empty(n + 1, np.uint64)
        total[0] = 0
        np.cumsum((_BYTE_LOWER if lower else _BYTE)[self.data] * up[:n], out=total[1:])
        return mix((total[self.end] - total[self.start]) * down[self.start])

    def shingles(self, lower: bool = True, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
        """``(hash, first)``: the k-word windows of every text in order, text ``d`` at
        ``first[d]:first[d + 1]``.  A text of 1..k-1 words has one for its whole sequence."""
        h = self.hashes(lower)
        m = len(h)
        short = np.flatnonzero((self.count > 0) & (self.count < k))
        per = np.maximum(self.count - (k - 1), 0)
        per[short] = 1
        first = np.concatenate([[0], np.cumsum(per)])
        out = np.empty(first[-1], np.uint64)
        if m >= k:
            full = h[: m - k + 1] * _MULT[0]
            for j in range(1, k):
                full = full + h[j : m - k + 1 + j] * _MULT[j]
            at = np.repeat(self.first[:-1] - first[:-1], per) + np.arange(first[-1])
            out[:] = full[np.minimum(at, m - k)]
        for d in short:
            a, b = self.first[d], self.first[d + 1]
            out[first[d]] = (h[a:b] * _MULT[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
        return mix(out), first


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string column; nulls are empty."""
    column = column.cast(pa.large_string()) if column.type != pa.large_string() else column
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array, max_bytes: int = CHUNK_BYTES, max_rows: int = 1 << 14):
    """``(row_from, row_to, bytes, offsets)`` over groups of rows of about
    ``max_bytes`` (a longer text comes alone); bounds the working memory."""
    data, offsets = text_buffers(column)
    n, a = len(offsets) - 1, 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + max_bytes, "right")) - 1
        b = min(n, max(b, a + 1), a + max_rows)
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b
