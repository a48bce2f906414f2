"""A bit table of bounded size that tells which hashes may be in a set.

False positives only cost work: every use is followed by an exact join or search.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BITS = 1 << 28


def bit_table(hashes: DataFrame, column: str, count: int) -> np.ndarray:
    """Bit table of a column of 64-bit hashes (``count`` of them), two bits
    each; at most ``MAX_BITS`` bits, so it may be broadcast. Bits are gathered
    by partial aggregation."""
    bits = 1 << int(np.clip(16 * max(count, 1), 1 << 16, MAX_BITS) - 1).bit_length()
    place = F.explode(F.array(F.col(column).bitwiseAND(F.lit(bits - 1)),
                              F.shiftrightunsigned(column, 32).bitwiseAND(F.lit(bits - 1))))
    got = (hashes.select(place.alias("at")).select(F.shiftrightunsigned("at", 6).alias("word"),
                                                  F.expr("shiftleft(1L, cast(at & 63 as int))").alias("bit"))
           .groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow())
    out = np.zeros(bits >> 6, dtype=np.int64)
    out[got["word"].to_numpy()] = got["bit"].to_numpy()
    return out.view(np.uint64)


def in_table(table: np.ndarray, v: np.ndarray) -> np.ndarray:
    mask = np.uint64(len(table) * 64 - 1)
    ok = np.ones(len(v), dtype=bool)
    for at in (v & mask, (v >> np.uint64(32)) & mask):
        ok &= (table[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
    return ok
