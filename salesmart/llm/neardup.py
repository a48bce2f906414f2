"""Near-duplicate documents by MinHash with tensored banding.

A document is the set of its distinct 5-word shingles (A-Z lower-cased); a
text of fewer words is one shingle. Documents whose sets have similarity at
least ``percent`` / 100 are linked, and links are confirmed on the full sets.

*Table keys.* Two small collections of ``SIDE`` bands of ``ROWS`` minhashes
each are computed, 2 x SIDE x ROWS minhashes in all; every pair (band of the
first, band of the second) is a table key, so SIDE x SIDE tables cost about
the square root of the minhashes they would need one by one. At similarity s
a pair shares a key with probability (1 - (1 - s^ROWS)^SIDE)^2: 0.99999 at
0.85 and 0.9999 at 0.8 with the values below. Bands that nobody else has are
dropped before keys are formed, keys that nobody else has before they are kept.

*Classes.* Documents with equal sets are one class, collapsed before any
join, so a group of copies costs one member.

*Links.* First each member of a table key is compared with the key's smallest
member, which connects most of every group with as many pairs as members.
What may still be missing are links between different components of one key.
A link needs s of each set to be shared, so shingles that occur in no other
candidate bound every pair; members without enough shared shingles leave, and
the others of a key are compared by blocks of ``BLOCK`` members on these
bounds. Each set also has the parity of its shingles in ``BITS`` bits: two
sets differ in at least as many shingles as their bits differ in, so a pair
whose bits differ too much is no link. A pair that passes at its first common
key is verified.

NULL texts, empty texts and texts without a word have the empty set and no
link. Rows with a NULL ``doc_id`` are returned with NULL component and kept.
Rows repeated with equal doc_id are one document (its sets are linked through
the common id). Other columns are not read. Empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.llm.common import map_batches, saved
from salesmart.llm.components import components
from salesmart.llm.wordhash import Hasher, buffers, lower_ascii, mix, split_words, windows

SHINGLE, SIDE, ROWS = 5, 10, 2
BLOCK = 1024
#: Parity bits per set, a multiple of 64; tight for up to about as many shingles.
BITS = 1024
#: Candidate ids up to this number are broadcast (8 bytes each); more are joined by shuffle.
BROADCAST_IDS = 1_000_000

SKETCH = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_shingles", T.LongType()),
    T.StructField("key_a", T.LongType()), T.StructField("key_b", T.LongType()),
    T.StructField("bands", T.ArrayType(T.LongType())),
])


class Shingler:
    def __init__(self, k: int) -> None:
        self.k, self.hash = k, Hasher()

    def __call__(self, texts) -> list[np.ndarray]:
        """Sorted distinct shingle hashes per text."""
        data, off = buffers(texts)
        data = lower_ascii(data)
        starts, ends, first = split_words(data, off)
        h = self.hash.words(data, starts, ends)
        w = windows(h, self.k)
        out = []
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= self.k:
                out.append(np.unique(w[a:b - self.k + 1]))
            elif b > a:                       # the whole sequence is one shingle of its own length
                acc = np.uint64(b - a)
                out.append(mix(np.array([np.bitwise_xor.reduce(mix(h[a:b] + np.arange(b - a, dtype=np.uint64))) ^ acc])))
            else:
                out.append(np.zeros(0, np.uint64))
        return out


def minhash_multipliers(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) | np.uint64(1)


def signature(shingles: np.ndarray, mult: np.ndarray) -> np.ndarray:
    """One minhash per multiplier (32 bits)."""
    best = np.full(len(mult), np.uint64(1 << 32), dtype=np.uint64)
    for i in range(0, len(shingles), 1 << 15):
        part = (shingles[i:i + (1 << 15), None] * mult) >> np.uint64(32)
        best = np.minimum(best, part.min(axis=0))
    return best


def sketches(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """Set size, set fingerprint and the 2 x SIDE band hashes per document."""
    def start():
        shingle, mult = Shingler(k), minhash_multipliers(2 * SIDE * ROWS)

        def step(batch):
            sets = shingle(batch.column(1))
            n = np.array([len(s) for s in sets], dtype=np.int64)
            sig = np.zeros((len(sets), len(mult)), dtype=np.uint64)
            key = np.zeros((len(sets), 2), dtype=np.uint64)
            for i, s in enumerate(sets):
                if len(s):
                    sig[i] = signature(s, mult)
                    key[i] = mix(s).sum(), np.bitwise_xor.reduce(mix(s ^ np.uint64(0x5DEECE66D)))
            band = np.zeros((len(sets), 2 * SIDE), dtype=np.uint64)
            for r in range(ROWS):
                band = band * np.uint64(0x9E3779B97F4A7C15) + sig[:, r::ROWS]
            band = mix(band)
            flat = pa.array(band.reshape(-1).view(np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * (2 * SIDE)), flat)
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(key[:, 0].view(np.int64)),
                                               pa.array(key[:, 1].view(np.int64)), lists], names=SKETCH.fieldNames())
        return step
    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), SKETCH, start)


def shingle_sets(docs: DataFrame, ids: DataFrame, count: int, k: int) -> DataFrame:
    """``doc_id, shingles`` of the documents in ``ids`` (distinct)."""
    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    picked = own.join(F.broadcast(ids) if count <= BROADCAST_IDS else ids, "doc_id", "left_semi")

    def start():
        shingle = Shingler(k)

        def step(batch):
            sets = shingle(batch.column(1))
            off = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
            return pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(off), pa.array(flat))],
                                              names=["doc_id", "shingles"])
        return step
    return map_batches(picked, "doc_id long, shingles array<long>", start)


def table_keys(classes: DataFrame) -> DataFrame:
    """``class, key, li, ri``: pairs of a first-side and a second-side band
    (their numbers ``li``, ``ri``) that the class shares with other classes."""
    bands = classes.select("class", F.posexplode("bands").alias("i", "band"))
    # a band with one class only is dropped; sums are partial, hot bands collapse
    shared = bands.groupBy("i", "band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("i", "band")
    kept = bands.join(shared, ["i", "band"]).groupBy("class").agg(
        F.collect_list(F.when(F.col("i") < SIDE, F.struct("i", "band"))).alias("left"),
        F.collect_list(F.when(F.col("i") >= SIDE, F.struct("i", "band"))).alias("right"))
    return kept.select("class", F.explode("left").alias("l"), "right").select("class", "l", F.explode("right").alias("r")) \
        .select("class", F.xxhash64("l.i", "l.band", "r.i", "r.band").alias("key"),
                F.col("l.i").alias("li"), (F.col("r.i") - SIDE).alias("ri"))


def shared_keys(keys: DataFrame) -> DataFrame:
    """``keys`` that several classes have, with the smallest class (``lead``).
    One shuffle; a group's rows are buffered by Spark, which spills them."""
    group = Window.partitionBy("key")
    return keys.withColumns({"lead": F.min("class").over(group), "_n": F.count(F.lit(1)).over(group)}) \
        .filter("_n > 1").drop("_n")


def parity_bits(sets: DataFrame) -> DataFrame:
    """``class, n_shingles, bits``: in how many shingles (odd or even) each of
    ``BITS`` places occurs; equal shingles of two sets cancel out."""
    def start():
        def step(batch):
            lists = batch.column(1)
            off = lists.offsets.to_numpy().astype(np.int64)
            flat = np.asarray(lists.values).view(np.uint64)[off[0]:off[-1]]
            n = np.diff(off)
            at = np.repeat(np.arange(len(n)), n) * BITS + (mix(flat) % np.uint64(BITS)).astype(np.int64)
            odd = (np.bincount(at, minlength=len(n) * BITS) & 1).astype(bool)
            words = np.packbits(odd).view(np.int64)
            bits = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * (BITS // 64)), pa.array(words))
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), bits], names=["class", "n_shingles", "bits"])
        return step
    return map_batches(sets.select("class", "shingles"), "class long, n_shingles long, bits array<long>", start)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those (a, b) whose full sets have similarity of at least ``percent``."""
    one = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa")), "a")
    two = one.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb")), "b")
    both = F.size(F.array_intersect("sa", "sb"))
    return two.withColumn("_both", both).filter(
        100 * F.col("_both") >= percent * (F.size("sa") + F.size("sb") - F.col("_both"))).select("a", "b")


def residual_pairs(keys: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that share a table key and may be linked.

    ``members``: class, component, n_shingles, shared (shingles that another
    candidate has), bands, bits. Keys whose members are all of one component are
    done; the others are dealt out as pairs of blocks.
    """
    rows = keys.join(members, "class")
    open_keys = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("x"),
                                        F.max("component").alias("y")).filter("x <> y").select("key", "n")
    rows = rows.join(open_keys, "key").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")) \
        .withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    dealt = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "block",
        "li", "ri", "class", "component", "n_shingles", "shared", "bands", "bits")
    dealt = dealt.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q")

    def run(batches):
        work = BlockPairs(percent)
        for batch in batches:
            yield from work.add(batch)
        yield from work.finish()
    return dealt.mapInArrow(run, "a long, b long").distinct()


class BlockPairs:
    """Compares the members of (key, block, block) runs of sorted batches."""

    def __init__(self, percent: int) -> None:
        self.percent, self.rest = percent, None

    def add(self, batch: pa.RecordBatch):
        table = pa.Table.from_batches([batch])
        if self.rest is not None:
            table = pa.concat_tables([self.rest, table])
        at = np.stack([table[c].to_numpy() for c in ("key", "p", "q")])
        cut = np.flatnonzero((at[:, 1:] != at[:, :-1]).any(axis=0)) + 1
        if not len(cut):
            self.rest = table
            return
        self.rest = table.slice(int(cut[-1]))
        yield self.compare(table.slice(0, int(cut[-1])), np.concatenate([[0], cut]))

    def finish(self):
        if self.rest is not None and self.rest.num_rows:
            yield self.compare(self.rest, np.array([0, self.rest.num_rows]))

    @staticmethod
    def matrix(lists: pa.ChunkedArray, width: int) -> np.ndarray:
        lists = lists.combine_chunks()
        return (lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists).flatten().to_numpy().reshape(-1, width)

    def near(self, bits: np.ndarray, n: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Pairs that the parity bits allow: |a| + |b| - 2 |both| >= bits that differ."""
        ok = np.ones(len(i), dtype=bool)
        for lo in range(0, len(i), 1 << 16):
            x, y = i[lo:lo + (1 << 16)], j[lo:lo + (1 << 16)]
            apart = np.bitwise_count((bits[x] ^ bits[y]).view(np.uint64)).sum(axis=1, dtype=np.int64)
            size = n[x] + n[y]
            ok[lo:lo + (1 << 16)] = (100 + self.percent) * (size - apart) >= 2 * self.percent * size
        return ok

    def compare(self, table: pa.Table, cut: np.ndarray) -> pa.RecordBatch:
        cls, comp, n, shared, p, q, block = (table[c].to_numpy() for c in (
            "class", "component", "n_shingles", "shared", "p", "q", "block"))
        bands, bits = self.matrix(table["bands"], 2 * SIDE), self.matrix(table["bits"], BITS // 64)
        li, ri = table["li"].to_numpy(), table["ri"].to_numpy()
        out_a, out_b = [], []
        for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist()):
            idx = np.arange(lo, hi)
            if p[lo] == q[lo]:
                left = right = idx
            else:
                left, right = idx[block[lo:hi] == p[lo]], idx[block[lo:hi] == q[lo]]
            if not len(left) or not len(right):
                continue
            # |both| <= min(shared) and a link needs (100 + t) |both| >= t (|a| + |b|)
            t = self.percent
            ok = (comp[left][:, None] != comp[right][None]) & (
                (100 + t) * np.minimum(shared[left][:, None], shared[right][None]) >= t * (n[left][:, None] + n[right][None]))
            if p[lo] == q[lo]:
                ok &= cls[left][:, None] < cls[right][None]
            x, y = np.nonzero(ok)
            if not len(x):
                continue
            i, j = left[x], right[y]
            same = bands[i] == bands[j]
            # each pair is reported at its first common key only
            hit = (same[:, :SIDE].argmax(axis=1) == li[lo]) & (same[:, SIDE:].argmax(axis=1) == ri[lo])
            i, j = i[hit], j[hit]
            near = self.near(bits, n, i, j)
            i, j = i[near], j[near]
            out_a.append(np.minimum(cls[i], cls[j]))
            out_b.append(np.maximum(cls[i], cls[j]))
        a = np.concatenate(out_a) if out_a else np.zeros(0, np.int64)
        b = np.concatenate(out_b) if out_b else np.zeros(0, np.int64)
        if len(a):
            a, b = np.unique(np.stack([a, b]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def near_duplicates(docs: DataFrame, percent: int = 85, k: int = SHINGLE) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``."""
    sketch = saved(sketches(docs, k), "sketches")
    known = sketch.filter("doc_id is not null")
    sets_of = known.filter("n_shingles > 0")
    same = ["key_a", "key_b", "n_shingles"]
    classes = saved(sets_of.groupBy(*same).agg(F.min("doc_id").alias("class"), F.any_value("bands").alias("bands")), "classes")

    keys = saved(shared_keys(table_keys(classes)), "keys")
    pairs = saved(keys.filter("class <> lead").select(F.col("lead").alias("a"), F.col("class").alias("b")).distinct(), "pairs")
    ids = saved(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "candidates")
    sets = saved(shingle_sets(docs, ids, ids.count(), k), "sets")
    links = saved(verified(pairs, sets, percent).distinct(), "links")

    first = components(links)
    member = (ids.withColumnRenamed("doc_id", "class")
              .join(first.withColumnRenamed("node", "class"), "class", "left")
              .withColumn("component", F.coalesce("component", "class")))
    more = saved(verified(open_pairs(keys.drop("lead"), member, classes, sets, percent), sets, percent).distinct(), "links")

    place = classes.select(*same, "class")
    at = known.select("doc_id", *same).join(place, same, "left").select("doc_id", "n_shingles", F.coalesce("class", "doc_id").alias("class"))
    at = saved(at, "places")
    # a doc_id with several texts links their classes
    twice = at.groupBy("doc_id").agg(F.min("class").alias("a"), F.max("class").alias("b")).filter("a <> b").select("a", "b")
    final = components(links.unionByName(more).unionByName(twice))
    out = at.join(final.withColumnRenamed("node", "class"), "class", "left") \
        .groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles"), F.min(F.coalesce("component", "class")).alias("component_id"))
    out = out.withColumn("kept", F.col("component_id") == F.col("doc_id"))
    nameless = sketch.filter("doc_id is null").select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"),
                                                      F.lit(True).alias("kept"))
    return out.unionByName(nameless)


def open_pairs(keys: DataFrame, member: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that may still be linked."""
    rows = keys.join(member, "class")
    unsettled = rows.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y")
    left = saved(keys.join(unsettled.select("key"), "key"), "open")
    named = left.select("class").distinct()
    held = sets.join(named, sets.doc_id == named["class"], "left_semi").select(F.col("doc_id").alias("class"), "shingles")
    alone = held.select("class", F.explode("shingles").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("n"), F.min("class").alias("class")).filter("n = 1") \
        .groupBy("class").agg(F.count(F.lit(1)).alias("alone"))
    about = (classes.select("class", "n_shingles", "bands").join(named, "class").join(member, "class")
             .join(alone, "class", "left")
             .withColumn("shared", F.col("n_shingles") - F.coalesce("alone", F.lit(0))).drop("alone")
             .filter(100 * F.col("shared") >= percent * F.col("n_shingles"))
             .join(parity_bits(held), ["class", "n_shingles"]))
    return residual_pairs(left, about, percent)
