"""Importance resampling of documents towards a target distribution.

Words are runs of 0-9, letters (A-Z lower-cased) and all characters above
U+007F. A text's features are its runs of one to three consecutive words,
hashed to buckets (CRC-32 of the words joined by one space). A bucket's gain is
the log ratio of its share in the target texts and in all documents; a
document's weight is the sum of its features' gains. With Gumbel noise from
the document's id added, the highest scores are a draw without replacement in
proportion to the weights.

1. Bucket counts of the documents and of the target: one row of partial sums
   per bucket and task, summed by Spark. The gains are one array of fixed size.
2. Scores: one pass that adds up the gains of each text; written once.
3. The cutoff is found by weighted median-of-medians: every block of rows of a
   partition gives the median of its undecided keys, weighted by their number;
   the weighted median of these is the next pivot. At least a quarter of the
   undecided rows are discarded each round, whatever their order. The same
   pass counts the rows above the pivot and takes the medians of both sides,
   so a round is one scan; the undecided rows are rewritten as they shrink, so
   all scans together read a few times the keys. When at most ``FINISH`` keys
   are left, the driver takes the cutoff key among them.
4. The winners are range-partitioned by key and sorted; a rank is the place in
   the partition plus the sizes of earlier partitions. All other rows get no
   rank; nothing is joined.

Keys are (score descending, doc_id ascending, NULL ids last, row number), a
total order: ties and repeated rows are cut exactly, repeated rows count as
rows of their own. A NULL ``doc_id`` takes the noise of an empty id. NULL and
empty texts have no features and weight 0. Texts are read whole. An empty
table gives an empty result, an empty target gains that are all computed from
T = 0. Input columns with the names of the new ones are replaced.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.llm.common import SLICE_BYTES, map_batches, saved
from salesmart.llm.runs import Crc32, runs
from salesmart.llm.wordhash import buffers, lower_ascii

BUCKETS, SEED, PERCENT, LEAST_WORDS = 10_000, 42, 5, 20
#: Rows per block that gives one median; keys left for the driver.
BLOCK, FINISH = 1 << 18, 4096

NEW = [T.StructField(n, T.LongType()) for n in ("n_words", "n_features", "weight", "score")]


class Features:
    """Buckets of the features of a batch of texts."""

    def __init__(self, buckets: int) -> None:
        self.buckets, self.crc = buckets, Crc32()

    def __call__(self, texts) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """(first word of each document, [(first word, bucket) of the runs of
        one, two and three words])"""
        data, off = buffers(texts)
        data = lower_ascii(data)
        word = (data >= 0x80) | ((data >= 97) & (data <= 122)) | ((data >= 48) & (data <= 57))
        starts, ends, first = runs(word, off)
        size = ends - starts
        one = self.crc.slices(data, starts, ends)
        blank = np.full(len(one), self.crc.slices(np.array([32], np.uint8), np.array([0]), np.array([1]))[0] if len(one) else 0, np.uint32)
        spaced = self.crc.push(blank, size) ^ one               # of a space and the word
        left = np.repeat(first[1:], np.diff(first)) - np.arange(len(one))   # words from here to the document's end
        out, crc, at = [], one, np.arange(len(one))
        for n in (1, 2, 3):
            if n > 1:
                ok = left[at] >= n
                at, crc = at[ok], crc[ok]
                last = at + (n - 1)
                crc = self.crc.push(crc, size[last] + 1) ^ spaced[last]
            out.append((at, (crc % np.uint32(self.buckets)).astype(np.int64)))
        return first, out


def bucket_counts(texts: DataFrame, column: str, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket over all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = Features(buckets), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            rows = max(1, -(-batch.num_rows // max(1, -(-batch.nbytes // SLICE_BYTES))))
            for i in range(0, batch.num_rows, rows):
                for _, bucket in features(batch.column(0).slice(i, rows))[1]:
                    total += np.bincount(bucket, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])
    got = (texts.select(F.col(f"`{column}`").cast("string").alias("text")).mapInArrow(run, "bucket long, n long")
           .groupBy("bucket").agg(F.sum("n").alias("n")).toArrow())
    out = np.zeros(buckets, dtype=np.int64)
    out[got["bucket"].to_numpy()] = got["n"].to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the ratio of smoothed shares, per bucket."""
    s_all, t_all, n = float(source.sum()), float(target.sum()), float(len(source))
    return np.array([math.floor(1000 * math.log((float(t) + 1) * (s_all + n) / ((float(s) + 1) * (t_all + n))))
                     for s, t in zip(source.tolist(), target.tolist())], dtype=np.int64)


def noise(seed: int, doc_id: int | None) -> int:
    """floor(1000 x Gumbel noise) from the id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, seed: int = SEED, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``_row`` (the kept columns), ``_id``, the new columns and a row number, written once."""
    gain_b = docs.sparkSession.sparkContext.broadcast(gain)
    new = {f.name for f in NEW} | {"rank"}
    names = [c for c in (docs.columns if keep is None else keep) if c.lower() not in new]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col("doc_id").cast("long").alias("_id"),
                       F.col(f"`{text}`").cast("string").alias("_text"))
    schema = T.StructType([rows.schema["_row"], rows.schema["_id"], *NEW])

    def start():
        gain_of = gain_b.value
        features = Features(len(gain_of))

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            first, parts = features(batch.column(2))
            each = np.zeros(int(first[-1]), dtype=np.int64)
            for at, bucket in parts:
                each[at] += gain_of[bucket]
            total = np.concatenate([[0], np.cumsum(each)])
            weight = total[first[1:]] - total[first[:-1]]
            words = np.diff(first)
            found = words + np.maximum(words - 1, 0) + np.maximum(words - 2, 0)
            luck = np.fromiter((noise(seed, i) for i in batch.column(1).to_pylist()), np.int64, batch.num_rows)
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *map(pa.array, (words, found, weight, weight + luck))],
                                              names=schema.fieldNames())
        return step
    return saved(map_batches(rows, schema, start).withColumn("_n", F.monotonically_increasing_id()), "scores")


#: A key as columns that sort ascending, best first.
KEY = ["_score", "_id_null", "_id_low", "_n"]


def _keys(rows: DataFrame) -> DataFrame:
    return rows.select((-F.col("score")).alias("_score"), F.col("_id").isNull().cast("long").alias("_id_null"),
                       F.coalesce("_id", F.lit(0)).alias("_id_low"), "_n")


def _before(key: tuple[int, ...]) -> F.Column:
    """Whether a row's key is at or before ``key``."""
    out = F.col(KEY[-1]) <= F.lit(key[-1])
    for c, v in reversed(list(zip(KEY[:-1], key[:-1]))):
        out = (F.col(c) < F.lit(v)) | ((F.col(c) == F.lit(v)) & out)
    return out


def _medians(keys: DataFrame, pivot: tuple[int, ...] | None) -> list[tuple[int, int, tuple[int, ...]]]:
    """(side, size, median key) of every block's rows at or before the pivot
    (side 0) and after it (side 1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def report(block: list[np.ndarray]) -> pa.RecordBatch:
            cols = [np.concatenate([b[i] for b in block]) for i in range(len(KEY))]
            order = np.lexsort(cols[::-1])
            cut = len(order)
            if pivot is not None:
                first = np.zeros(len(order), dtype=bool)
                equal = np.ones(len(order), dtype=bool)
                for c, v in zip(cols, pivot):
                    first |= equal & (c < v)
                    equal &= c == v
                cut = int((first | equal).sum())
            sides = [(side, hi - lo, order[(lo + hi - 1) // 2]) for side, lo, hi in ((0, 0, cut), (1, cut, len(order))) if hi > lo]
            return pa.RecordBatch.from_arrays([pa.array([s for s, _, _ in sides], pa.int64()), pa.array([n for _, n, _ in sides], pa.int64()),
                                               *[pa.array([int(c[i]) for _, _, i in sides], pa.int64()) for c in cols]], names=["side", "size", *KEY])
        block, n = [], 0
        for batch in batches:
            block.append([np.asarray(c) for c in batch.columns])
            n += batch.num_rows
            if n >= BLOCK:
                yield report(block)
                block, n = [], 0
        if n:
            yield report(block)
    schema = ", ".join(f"{c} long" for c in ["side", "size", *KEY])
    return [(r[0], r[1], tuple(r[2:])) for r in keys.select(*KEY).mapInArrow(run, schema).collect()]


def weighted_median(found: list[tuple[int, tuple[int, ...]]]) -> tuple[int, ...]:
    """The key at which half of the total size is reached."""
    found = sorted(found, key=lambda x: x[1])
    half, seen = sum(n for n, _ in found) / 2, 0
    for n, key in found:
        seen += n
        if seen >= half:
            return key
    raise ValueError("no keys")


def cutoff(rows: DataFrame, take: int, finish: int = FINISH) -> tuple[int, ...] | None:
    """The key of the ``take``-th best of ``rows`` (as ``scored`` gives them);
    None if nothing is to be taken."""
    if take <= 0:
        return None
    keys = _keys(rows)
    found = [(n, key) for _, n, key in _medians(keys, None)]
    left = stored = sum(n for n, _ in found)
    if take >= left:
        return tuple([2**63 - 1] * len(KEY))
    while left > finish:
        pivot = weighted_median(found)
        sides = _medians(keys, pivot)
        best = sum(n for side, n, _ in sides if side == 0)
        if best == take:
            return pivot
        side = 0 if best > take else 1
        take -= 0 if best > take else best
        left = best if side == 0 else left - best
        found = [(n, key) for s, n, key in sides if s == side]
        keys = keys.filter(_before(pivot) if side == 0 else ~_before(pivot))
        if left * 4 < stored:
            keys, stored = saved(keys, "undecided"), left
    return sorted(tuple(r) for r in keys.collect())[take - 1]


def ranked(winners: DataFrame) -> DataFrame:
    """``winners`` with ``rank`` 1, 2, 3... in key order."""
    order = [F.col("score").desc(), F.col("_id").asc_nulls_last(), F.col("_n")]
    spread = winners.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id())
    spread = saved(spread, "winners").withColumn("_part", F.shiftright("_place", 33))
    sizes = sorted((r[0], r[1]) for r in spread.groupBy("_part").count().collect())
    before = np.concatenate([[0], np.cumsum([n for _, n in sizes])]).tolist()
    if not sizes:
        return spread.withColumn("rank", F.lit(None).cast("long"))
    parts = winners.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(sizes, before)], "_part long, _before long")
    return spread.join(F.broadcast(parts), "_part").withColumn(
        "rank", F.col("_before") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)) + 1)


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED,
             buckets: int = BUCKETS, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """All rows of ``docs`` (columns ``keep``, or all) with ``n_words``,
    ``n_features``, ``weight``, ``score`` and ``rank`` (NULL: not drawn)."""
    gain = gains(bucket_counts(docs, text, buckets), bucket_counts(target, "text", buckets))
    rows = scored(docs, gain, seed, text, keep)
    able = F.col("n_words") >= least_words
    take = percent * rows.filter(able).count() // 100
    last = cutoff(rows.filter(able), take)
    names = ["_row.*", *[f.name for f in NEW], "rank"]
    if last is None:
        return rows.withColumn("rank", F.lit(None).cast("long")).select(*names)
    keyed = rows.select("*", *[c.alias(f"{n}") for n, c in zip(KEY[:-1], (
        -F.col("score"), F.col("_id").isNull().cast("long"), F.coalesce("_id", F.lit(0))))])
    won = able & _before(last)
    return ranked(keyed.filter(won).select(*rows.columns)).select(*names).unionByName(
        keyed.filter(~won).withColumn("rank", F.lit(None).cast("long")).select(*names))


def drawn(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn documents with all their columns, ranked."""
    return resample(docs, target, **options).filter("rank is not null")
