"""Vectorised words, word hashes and shingle hashes of Arrow text batches.

A word is a maximal run of bytes other than space and \\x09-\\x0D; these are
ASCII, so the split is done on the UTF-8 bytes without decoding. Hashes are
64-bit polynomials over a fixed random byte table (mod 2**64, final mix), so
equal words have equal hashes on every executor. Work arrays are built for
blocks of bytes, so memory stays near a few bytes per input byte however long
one text is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BLOCK = 1 << 19
_U = np.uint64
_M1, _M2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
_P = _U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit (splitmix64 steps)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _M1
    x ^= x >> _U(27)
    x *= _M2
    x ^= x >> _U(31)
    return x


def _inverse(p: int) -> int:
    return pow(p, -1, 1 << 64)


class Hasher:
    """Byte tables and powers, built once per task."""

    def __init__(self) -> None:
        self.table = mix(np.arange(1, 257, dtype=np.uint64) * _U(0xD1B54A32D192ED03))
        self._grow(BLOCK + 1)

    def _grow(self, n: int) -> None:
        up, down = np.full(n, _P), np.full(n, _U(_inverse(int(_P))))
        up[0] = down[0] = 1
        self.up, self.down = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)

    def words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of each ``data[starts[i]:ends[i]]`` (ascending, disjoint)."""
        out = np.empty(len(starts), dtype=np.uint64)
        i = 0
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK, side="right")))
            lo, hi = int(starts[i]), int(ends[j - 1])
            if hi - lo >= len(self.up):
                self._grow(hi - lo + 1)
            acc = np.zeros(hi - lo + 1, dtype=np.uint64)
            np.cumsum(self.table[data[lo:hi]] * self.up[: hi - lo], out=acc[1:])
            s, e = starts[i:j] - lo, ends[i:j] - lo
            out[i:j] = (acc[e] - acc[s]) * self.down[s]
            i = j
        return mix(out)


def buffers(texts) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string array; nulls count as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    off = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset: texts.offset + len(texts) + 1] \
        if len(texts) else np.zeros(1, dtype=np.int64)
    raw = texts.buffers()[2] if len(texts) else None
    data = np.frombuffer(raw, dtype=np.uint8)[off[0]: off[-1]] if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data, off - off[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    upper = (data >= 65) & (data <= 90)
    return data + (upper.astype(np.uint8) << 5)


def split_words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte bounds of all words; document i has the
    words ``first[i]:first[i+1]``."""
    if not len(data):
        z = np.zeros(0, dtype=np.int64)
        return z, z, np.zeros(len(off), dtype=np.int64)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    cut = np.zeros(len(data) + 1, dtype=bool)   # a document starts here
    cut[off] = True
    inside = ~blank
    begin = inside.copy()
    begin[1:] &= blank[:-1] | cut[1:-1]
    stop = inside.copy()
    stop[:-1] &= blank[1:] | cut[1:-1]
    starts = np.flatnonzero(begin)
    ends = np.flatnonzero(stop) + 1
    return starts, ends, np.searchsorted(starts, off)


def windows(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive items of ``h`` (all positions;
    runs across documents are left to the caller to drop)."""
    if len(h) < n:
        return np.zeros(0, dtype=np.uint64)
    acc = np.zeros(len(h) - n + 1, dtype=np.uint64)
    for j in range(n):
        acc *= _P
        acc += h[j: len(h) - n + 1 + j]
    return mix(acc)
