"""Runs of bytes (words) in Arrow text batches and their CRC-32, vectorised.

CRC-32 is linear: crc(A + B) is crc(A) pushed through len(B) zero bytes, xor
crc(B). So the checksum of joined words follows from those of the words with
four table lookups, without building the joined text.
"""

from __future__ import annotations

import zlib

import numpy as np


def runs(inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): maximal runs of set positions within documents
    ``off[i]:off[i+1]``; document i has the runs ``first[i]:first[i+1]``."""
    if not len(inside):
        z = np.zeros(0, dtype=np.int64)
        return z, z, np.zeros(len(off), dtype=np.int64)
    cut = np.zeros(len(inside) + 1, dtype=bool)
    cut[off] = True
    begin, stop = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1] | cut[1:-1]
    stop[:-1] &= ~inside[1:] | cut[1:-1]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(stop) + 1, np.searchsorted(starts, off)


class Crc32:
    """CRC-32 (as ``zlib.crc32``) of many byte slices and of their joins."""

    NEAR, BITS = 64, 48

    def __init__(self) -> None:
        table = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
        self.table = table
        step = (np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32)[:, None] * np.uint32(8))).astype(np.uint32)
        near = [step]
        for _ in range(self.NEAR):
            step = table[step & 255] ^ (step >> 8)
            near.append(step)
        self.near = np.stack(near)                          # by number of zero bytes
        power = [near[1]]                                   # by powers of two
        for _ in range(self.BITS):
            power.append(self._push(power[-1], power[-1]))
        self.power = power

    @staticmethod
    def _push(lanes: np.ndarray, crc: np.ndarray) -> np.ndarray:
        return lanes[0][crc & 255] ^ lanes[1][(crc >> 8) & 255] ^ lanes[2][(crc >> 16) & 255] ^ lanes[3][crc >> 24]

    def push(self, crc: np.ndarray, zeros: np.ndarray) -> np.ndarray:
        """Each ``crc`` through its number of zero bytes."""
        base = np.minimum(zeros, self.NEAR) * 1024
        flat = self.near.reshape(-1)
        out = flat[base + (crc & 255)] ^ flat[base + 256 + ((crc >> 8) & 255)] \
            ^ flat[base + 512 + ((crc >> 16) & 255)] ^ flat[base + 768 + (crc >> 24)]
        far = np.flatnonzero(zeros > self.NEAR)
        if len(far):
            left, x = zeros[far] - self.NEAR, out[far]
            for k in range(int(left.max()).bit_length()):
                x = np.where((left >> k) & 1 == 1, self._push(self.power[k], x), x)
            out[far] = x
        return out

    def slices(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """CRC-32 of each ``data[starts[i]:ends[i]]``; byte k of all slices at once."""
        size = ends - starts
        order = np.argsort(-np.minimum(size, self.NEAR + 1).astype(np.int16), kind="stable")
        at = starts[order]
        alive = len(at) - np.cumsum(np.bincount(np.minimum(size, self.NEAR), minlength=self.NEAR + 1))
        crc = np.full(len(at), 0xFFFFFFFF, dtype=np.uint32)
        for k in range(self.NEAR):
            n = int(alive[k])
            if not n:
                break
            now = crc[:n]
            crc[:n] = self.table[(now ^ data[at[:n] + k]) & 255] ^ (now >> 8)
        out = np.empty(len(at), dtype=np.uint32)
        out[order] = crc ^ np.uint32(0xFFFFFFFF)
        for i in np.flatnonzero(size > self.NEAR):
            out[i] = zlib.crc32(data[starts[i]:ends[i]])
        return out
