"""An FM-index over integer sequences in numpy, for runs of bounded length.

The sequences are joined with separator 0 and their suffixes sorted by their
first ``depth`` symbols. The Burrows-Wheeler transform is kept in a wavelet
tree: one packed bit plane per bit of the alphabet, with block counts, so
occurrences of a symbol before a row cost a constant number of steps per
plane. Backward search extends many patterns at once.

Besides the tree the index keeps, for every class of suffixes with an equal
start of ``n`` symbols, its rows and its first position in the text. That is
what matching statistics cut off at ``n`` need: after a window of ``n``
symbols is matched, one more symbol on the left gives the rows of a run of
``n + 1``; dropping the last symbol is the class these rows lie in.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64


class BitPlane:
    def __init__(self, bits: np.ndarray) -> None:
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(len(bits) // 64 + 1, dtype="<u8")
        words.view(np.uint8)[: len(packed)] = packed
        self.words = words
        self.before = np.zeros(len(words), dtype=np.int64)
        np.cumsum(np.bitwise_count(words[:-1]), out=self.before[1:])

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Set bits among the first ``i``."""
        w = i >> 6
        low = (_U(1) << (i & 63).astype(np.uint64)) - _U(1)
        return self.before[w] + np.bitwise_count(self.words[w] & low)


class WaveletTree:
    def __init__(self, symbols: np.ndarray, size: int) -> None:
        self.planes: list[tuple[int, BitPlane, int]] = []
        at = symbols.astype(np.int64)
        for shift in range(max(1, int(size - 1).bit_length()) - 1, -1, -1):
            bit = (at >> shift) & 1 == 1
            self.planes.append((shift, BitPlane(bit), int(len(bit) - bit.sum())))
            at = np.concatenate([at[~bit], at[bit]])
        every = np.arange(size, dtype=np.int64)
        self.first = self._down(every, np.zeros(size, dtype=np.int64))

    def _down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for shift, plane, zeros in self.planes:
            ones = plane.ones(i)
            i = np.where((symbol >> shift) & 1 == 1, zeros + ones, i - ones)
        return i

    def before(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs among the first ``i`` rows."""
        return self._down(symbol, i) - self.first[symbol]


class FmIndex:
    def __init__(self, words: np.ndarray, lengths: np.ndarray, n: int) -> None:
        """``words``: the sequences one after the other, sequence k of
        ``lengths[k]`` values; ``n``: length of the windows to be searched."""
        self.n = n
        self.alphabet, code = np.unique(words, return_inverse=True)
        ends = np.cumsum(lengths) + np.arange(len(lengths))
        self.starts = ends - lengths
        text = np.zeros(len(words) + len(lengths), dtype=np.int64)
        where = np.ones(len(text), dtype=bool)
        where[ends] = False
        text[where] = code + 1
        self.size = len(self.alphabet) + 1
        rank, depth, last, last_depth = text, 1, text, 1
        while depth < n + 1:
            step = min(depth, n + 1 - depth)
            key = rank * (int(rank.max()) + 1)
            key[: len(key) - step] += rank[step:]
            last, last_depth = rank, depth
            depth += step
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            new = np.empty(len(key), dtype=bool)
            new[0] = False
            new[1:] = ordered[1:] != ordered[:-1]
            rank = np.empty(len(key), dtype=np.int64)
            rank[order] = np.cumsum(new)
        suffix = order if n else np.arange(len(text))
        # rows whose first n symbols differ from the row before
        tail = np.zeros(len(text) + n, dtype=np.int64)
        tail[: len(text)] = last
        head, rest = last[suffix], tail[suffix + n - last_depth]
        new = np.ones(len(text), dtype=bool)
        new[1:] = (head[1:] != head[:-1]) | (rest[1:] != rest[:-1])
        self.class_of = np.cumsum(new) - 1
        self.class_low = np.flatnonzero(new)
        self.class_high = np.append(self.class_low[1:], len(text))
        self.class_first = np.minimum.reduceat(suffix, self.class_low)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.size))])[:-1]
        self.tree = WaveletTree(text[suffix - 1], self.size)
        self.rows = len(text)

    def codes(self, words: np.ndarray) -> np.ndarray:
        """Symbols of ``words``; -1 for one that the index does not hold."""
        at = np.minimum(np.searchsorted(self.alphabet, words), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == words, at + 1, -1)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One backward step: the rows of symbol + pattern."""
        known = symbol > 0
        s = np.where(known, symbol, 0)
        lo = self.smaller[s] + self.tree.before(s, low)
        hi = self.smaller[s] + self.tree.before(s, high)
        return np.where(known, lo, 0), np.where(known, hi, 0)

    def first_positions(self, words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Matching statistics cut off at ``n``: for every window of ``n``
        words of the streamed sequences, in order, the first text position
        at which the index holds it, or -1. Sequences are read right to left,
        all at once."""
        n = self.n
        code = self.codes(words)
        base = np.cumsum(lengths) - lengths
        count = np.maximum(lengths - n + 1, 0)
        out_base = np.cumsum(count) - count
        out = np.full(int(count.sum()), -1, dtype=np.int64)
        live = np.flatnonzero(count > 0)
        left = lengths[live] - 1                    # next symbol to read
        have = np.zeros(len(live), dtype=np.int64)  # length of the match so far
        low, high = np.zeros(len(live), dtype=np.int64), np.full(len(live), self.rows, dtype=np.int64)
        while len(live):
            full = have == n
            if full.any():                          # drop the last symbol of a full window
                c = self.class_of[low[full]]
                low[full], high[full] = self.class_low[c], self.class_high[c]
            lo, hi = self.extend(code[base[live] + left], low, high)
            hit = hi > lo
            have = np.where(hit, np.minimum(have + 1, n), have)
            low, high = np.where(hit, lo, low), np.where(hit, hi, high)
            done = hit & (have == n)
            if done.any():
                k = live[done]
                out[out_base[k] + left[done]] = self.class_first[self.class_of[low[done]]]
            left = np.where(hit, left - 1, left)
            if not hit.all():
                # no window holds this run: start again with windows that end
                # one symbol before the end of the run that failed
                miss = ~hit
                end = np.where(full, left + n, left + have)[miss] - 1
                left[miss] = end
                have[miss], low[miss], high[miss] = 0, 0, self.rows
                gone = np.zeros(len(live), dtype=bool)
                gone[miss] = end < n - 1
            else:
                gone = np.zeros(len(live), dtype=bool)
            keep = (left >= 0) & ~gone
            live, left, have, low, high = live[keep], left[keep], have[keep], low[keep], high[keep]
        return out
