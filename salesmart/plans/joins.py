"""Join strategy helpers: broadcast only behind a proven size bound.

A side is broadcast when one aggregation proves it has at most ``max_rows``
rows *and* at most ``max_bytes`` bytes of row data: rows are counted and the
byte length of every string or binary value plus the fixed width of the other
columns summed. Every task sends one row of partial sums, so checking a big
side costs a scan of the joined columns and shuffles none of its rows. Otherwise the join is
left to a shuffle (sort-merge, or AQE's runtime conversion, which measures the
real shuffle size). Nothing is ever broadcast on a guess.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Default bounds for broadcasting a (projected) side: a key set of a million
# bigints is 8 MB; wide dimension rows stop at 128 MB of row data (the hash
# relation built from it takes about twice that per executor).
DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 128 << 20


# Bytes per value of the fixed-width types.
FIXED_WIDTH = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8,
    T.FloatType: 4, T.DoubleType: 8, T.DateType: 4, T.TimestampType: 8, T.TimestampNTZType: 8,
    T.NullType: 1,
}


def _value_bytes(name: str, t: T.DataType) -> Column:
    c = F.col(f"`{name}`")
    if isinstance(t, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0))
    if isinstance(t, T.DecimalType):
        return F.lit(8 if t.precision <= 18 else 16)
    width = FIXED_WIDTH.get(type(t))
    if width is not None:
        return F.lit(width)
    # nested or other types: the length of the value's JSON text
    return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))


def _row_bytes(df: DataFrame) -> Column:
    """Byte size of one row's data: exact for strings and binaries, the fixed
    width for numbers, dates and times, the JSON text length otherwise."""
    parts = [_value_bytes(f.name, f.dataType) for f in df.schema.fields]
    return reduce(lambda a, b: a + b, parts, F.lit(0))


def size_sums(df: DataFrame) -> DataFrame:
    """One row: number of rows ``n`` and bytes ``b`` of ``df``, by partial sums."""
    return df.agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(df)).alias("b"))


def size_at_most(df: DataFrame, max_rows: int, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes of
    row data (one aggregation)."""
    if max_rows <= 0:
        return False
    got = size_sums(df).first()
    return got.n <= max_rows and (got.b or 0) <= max_bytes


def small_enough(frames: list[DataFrame], max_rows: int,
                 max_bytes: int = DEFAULT_BROADCAST_BYTES) -> list[bool]:
    """``size_at_most`` for several frames, run as concurrent Spark jobs."""
    if max_rows <= 0:
        return [False] * len(frames)
    if len(frames) == 1:
        return [size_at_most(frames[0], max_rows, max_bytes)]
    with ThreadPoolExecutor(max_workers=len(frames)) as pool:
        return list(pool.map(lambda f: size_at_most(f, max_rows, max_bytes), frames))


def hint_if(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """(df with a broadcast hint if its size is proven small, whether it was hinted)."""
    if size_at_most(df, max_rows):
        return F.broadcast(df), True
    return df, False


def semi_join(fact: DataFrame, keys: DataFrame, fact_col: str, key_col: str,
              max_rows: int = DEFAULT_BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """Keep ``fact`` rows whose ``fact_col`` occurs in ``keys[key_col]``.

    The key set is broadcast when bounded (no shuffle of the fact side),
    otherwise a shuffled left-semi join runs; AQE splits a skewed fact
    partition of a semi join. Returns (result, broadcast_used).
    """
    k = keys.select(F.col(key_col).alias(fact_col)).where(F.col(fact_col).isNotNull())
    k, small = bounded_broadcast(k, max_rows)
    return fact.join(k, fact_col, "left_semi"), small


def key_set(keys: DataFrame, fact_col: str, key_col: str) -> DataFrame:
    return keys.select(F.col(key_col).alias(fact_col)).where(F.col(fact_col).isNotNull())


def semi_join_all(fact: DataFrame, checks, max_rows: int = DEFAULT_BROADCAST_ROWS,
                  small: list[bool] | None = None) -> tuple[DataFrame, bool]:
    """Apply several semi joins; ``checks`` is a list of (keys_df, fact_col, key_col).

    The key sets' size bounds are checked concurrently (or taken from
    ``small``). Returns (result, all_broadcast).
    """
    sets = [key_set(k, fc, kc) for k, fc, kc in checks]
    if small is None:
        small = small_enough(sets, max_rows)
    out = fact
    for ks, (_, fact_col, _), sm in zip(sets, checks, small):
        out = out.join(hint_if(ks, sm), fact_col, "left_semi")
    return out, all(small)


def require_unique(df: DataFrame, key: str, what: str) -> None:
    """Raise if ``key`` is not unique in ``df`` (duplicate dimension keys would
    multiply fact rows in the inner joins; NULL keys never join). One
    aggregation job."""
    dup = df.where(F.col(key).isNotNull()).groupBy(key).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"{what}: key {key}={dup[0][0]!r} occurs {dup[0][1]} times")


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Bag union by column name (duplicates kept, types widened)."""
    return reduce(lambda a, b: a.unionByName(b), frames)
