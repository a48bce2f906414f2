"""Substring deduplication with a compressed FM-index per shard.

Every word that lies in a window of ``n`` consecutive words whose word
sequence also starts earlier (smaller ``doc_id``, or earlier in the same
document) is reported. Four passes:

1. *Seeds.* Of each window the smallest hash among its runs of ``SEED`` words
   is chosen (the leftmost of equal ones). Equal windows choose equal seeds,
   so only seeds that occur in two different texts, or twice in one, can
   belong to a repeated window. Seeds are counted with partial sums.
2. *Regions.* The consecutive windows that chose one occurrence of a counted
   seed form a region of at most ``2n - SEED`` words. Regions are routed to
   shards by their seed, so all equal windows meet in one shard; equal regions
   of one batch are sent once, the later ones being repeats already.
3. *Shards.* Each shard builds an FM-index of its regions and streams the
   regions against it; the matching statistics give the first occurrence of
   every window. The regions of a seed in very many are dealt to chunks; every
   pair of chunks is a shard, one indexed and the other streamed, so no shard
   is unbounded.
4. *Spans* of repeated words per document are joined to the texts. Only texts
   that may have spans are shuffled for it, the others stay where they are read.

The counted seeds reach pass 2, and the documents with spans pass 4, as bit
tables of bounded size; their false positives only send more regions to the
shards and more texts to the join. Copies of a whole text are
repeats of the smallest doc_id's and need no search.

NULL and empty texts have no words. A document with a NULL ``doc_id`` is kept
whole and takes no part. Rows repeated with equal doc_id and text are one
document. Rows that share a doc_id but not the text are judged as documents
of that id, each by its own words. An empty table gives an empty result.
Texts are never cut: windows are formed over whole documents.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.llm.bittable import bit_table, in_table
from salesmart.llm.common import map_batches, saved
from salesmart.llm.fmindex import FmIndex
from salesmart.llm.wordhash import Hasher, buffers, mix, split_words, windows

WINDOW, SEED = 20, 8
#: Regions per shard, regions of one seed above which its shard is split; for
#: windows of ``WINDOW`` words, and fewer in proportion where regions are longer.
SHARD, HOT = 10_000, 10_000
#: Bytes of text that a step works on at once (17 MB of work arrays).
SLICE = 1 << 20

REGION = T.StructType([
    T.StructField("shard", T.LongType()), T.StructField("indexed", T.BooleanType()), T.StructField("asked", T.BooleanType()),
    T.StructField("doc_id", T.LongType()), T.StructField("text_key", T.LongType()),
    T.StructField("start", T.LongType()), T.StructField("stop", T.LongType()), T.StructField("words", T.BinaryType()),
])
SPAN = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text_key", T.LongType()),
                     T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])
ALL = 1 << 40


def _sliding_first_min(v: np.ndarray, w: int) -> np.ndarray:
    """Position of the first smallest of ``v[i:i+w]`` for every i."""
    at = np.arange(len(v))
    best, span = v, 1
    while span < w:
        step = min(span, w - span)
        a, b = best[:-step], best[step:]
        later = b < a
        best = np.where(later, b, a)
        at = np.where(later, at[step:], at[:-step])
        span += step
    return at


class Cutter:
    """Words, windows and seeds of a batch of texts."""

    def __init__(self, n: int, seed: int) -> None:
        self.n, self.seed, self.hash = n, min(seed, n), Hasher()

    def __call__(self, texts):
        """(word hashes, first word of each document, chosen seed position
        and document of each window, window's first word, seed hashes)"""
        data, off = buffers(texts)
        starts, ends, first = split_words(data, off)
        h = self.hash.words(data, starts, ends)
        count = np.maximum(np.diff(first) - self.n + 1, 0)
        doc = np.repeat(np.arange(len(count)), count)
        at = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count) + first[:-1][doc]
        seeds = windows(h, self.seed)
        chosen = _sliding_first_min(seeds, self.n - self.seed + 1)[at] if len(at) else at
        return h, first, chosen, doc, at, seeds


def _key(texts: str) -> F.Column:
    return F.xxhash64(F.coalesce(F.col(texts), F.lit("")))


def seed_counts(docs: DataFrame, n: int, seed: int) -> DataFrame:
    """Seeds of different texts or twice in one: ``seed, regions`` (the number
    of documents that choose it, at least 1)."""
    schema = "seed long, text_key long, twice int"

    def start():
        cut = Cutter(n, seed)

        def step(batch):
            _, _, chosen, doc, _, seeds = cut(batch.column(0))
            key = np.asarray(batch.column(1))
            new = np.ones(len(chosen), dtype=bool)
            new[1:] = (chosen[1:] != chosen[:-1]) | (doc[1:] != doc[:-1])
            value, doc = seeds[chosen[new]], doc[new]
            order = np.lexsort((value, doc))
            value, doc = value[order], doc[order]
            new = np.ones(len(value), dtype=bool)
            new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
            begin = np.flatnonzero(new)
            twice = np.diff(np.append(begin, len(value))) > 1
            return pa.RecordBatch.from_arrays(
                [pa.array(value[begin].view(np.int64)), pa.array(key[doc[begin]]), pa.array(twice.astype(np.int32))],
                names=["seed", "text_key", "twice"])
        return step
    rows = map_batches(docs.select("text", "text_key"), schema, start, SLICE)
    return (rows.groupBy("seed").agg(F.min("text_key").alias("a"), F.max("text_key").alias("b"),
                                     F.max("twice").alias("twice"), F.count(F.lit(1)).alias("regions"))
            .filter("a <> b or twice = 1").select("seed", "regions"))


def regions(docs: DataFrame, n: int, seed: int, table: np.ndarray, shards: int, hot: dict[int, int]) -> DataFrame:
    """Regions for the shards; regions that repeat an earlier one of their
    batch have no ``shard`` and no ``words``: all their windows are repeats."""
    spark = docs.sparkSession
    table_b, hot_b = spark.sparkContext.broadcast(table), spark.sparkContext.broadcast(hot)

    def start():
        cut, bits, split = Cutter(n, seed), table_b.value, hot_b.value
        hot_seeds = np.array(list(split), dtype=np.int64).view(np.uint64)
        hot_chunks = np.array(list(split.values()), dtype=np.int64)[np.argsort(hot_seeds)]
        hot_seeds = np.sort(hot_seeds)

        def step(batch):
            h, first, chosen, doc, at, seeds = cut(batch.column(0))
            new = np.ones(len(chosen), dtype=bool)
            new[1:] = (chosen[1:] != chosen[:-1]) | (doc[1:] != doc[:-1])
            begin = np.flatnonzero(new)
            last = np.append(begin[1:], len(chosen)) - 1
            value = seeds[chosen[begin]] if len(begin) else np.zeros(0, np.uint64)
            ok = in_table(bits, value)
            begin, last, value = begin[ok], last[ok], value[ok]
            lo, hi, doc = at[begin], at[last] + n, doc[begin]
            ids, keys = np.asarray(batch.column(2))[doc], np.asarray(batch.column(1))[doc]
            where = lo - first[:-1][doc]
            # content hash: the window hashes at both ends cover the region
            if len(h) >= n:
                w = windows(h, n)
                content = mix(w[lo] ^ mix(w[hi - n] + (hi - lo).astype(np.uint64)))
            else:
                content = np.zeros(0, np.uint64)
            order = np.lexsort((where, ids, content))
            c = content[order]
            head = np.ones(len(c), dtype=bool)
            head[1:] = c[1:] != c[:-1]
            group = np.cumsum(head) - 1
            lead = order[np.flatnonzero(head)]
            boss = lead[group]
            same = (ids[order] == ids[boss]) & (where[order] == where[boss])
            repeat = order[~same]
            # two texts of one doc_id may hold the region at one place
            lead = np.union1d(lead, order[same & (keys[order] != keys[boss])]).astype(np.int64)
            spot = np.minimum(np.searchsorted(hot_seeds, value[lead]), max(len(hot_seeds) - 1, 0))
            is_hot = hot_seeds[spot] == value[lead] if len(hot_seeds) else np.zeros(len(lead), bool)
            chunks = np.where(is_hot, hot_chunks[spot], 1) if len(hot_seeds) else np.ones(len(lead), np.int64)
            # a hot seed's regions are dealt to k chunks; chunk i is searched by chunk j in shard (i, j)
            to = np.repeat(np.arange(len(lead)), 2 * chunks - 1)
            nth = np.arange(len(to)) - np.repeat(np.cumsum(2 * chunks - 1) - (2 * chunks - 1), 2 * chunks - 1)
            lead, is_hot, chunks = lead[to], is_hot[to], chunks[to]
            own = (content[lead] % chunks.astype(np.uint64)).astype(np.int64)
            indexed = nth < chunks
            other = nth - chunks + (nth - chunks >= own)
            grid = np.where(indexed, own * chunks + nth, other * chunks + own)
            asked = ~indexed | (nth == own) | ~is_hot
            shard = np.where(is_hot, -1 - (mix(value[lead] + grid.astype(np.uint64)) >> np.uint64(2)).astype(np.int64),
                             (mix(value[lead]) % np.uint64(shards)).astype(np.int64))
            rows = np.concatenate([repeat, lead]).astype(np.int64)
            begin = where[rows]
            size = (hi - lo)[rows]
            sent = np.arange(len(rows)) >= len(repeat)
            end = np.concatenate([[0], np.cumsum(np.where(sent, size, 0))])
            body = h[np.repeat(lo[lead] - end[len(repeat):-1], size[sent]) + np.arange(end[-1])]
            words = pa.BinaryArray.from_buffers(pa.binary(), len(rows), [
                pa.py_buffer(np.packbits(sent, bitorder="little")), pa.py_buffer((8 * end).astype(np.int32)), pa.py_buffer(body)])
            return pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([np.zeros(len(repeat), np.int64), shard]), mask=~sent),
                *[pa.array(np.concatenate([np.zeros(len(repeat), bool), x])) for x in (indexed, asked)],
                pa.array(ids[rows]), pa.array(keys[rows]), pa.array(begin), pa.array(begin + size), words], names=REGION.fieldNames())
        return step
    return map_batches(docs.select("text", "text_key", "doc_id"), REGION, start, SLICE)


def search_shard(rows: pa.Table, n: int) -> pa.Table:
    """Index the shard's indexed regions, stream those that ask, and report
    the runs of windows whose first occurrence is earlier than their own place."""
    ids, keys = rows["doc_id"].to_numpy(), rows["text_key"].to_numpy()
    start, indexed, asked = rows["start"].to_numpy(), *(rows[c].to_numpy(zero_copy_only=False) for c in ("indexed", "asked"))
    order = np.lexsort((start, ids))
    ids, keys, start, indexed, asked = ids[order], keys[order], start[order], indexed[order], asked[order]
    binary = rows["words"].combine_chunks().take(pa.array(order))
    if isinstance(binary, pa.ChunkedArray):
        binary = binary.combine_chunks()
    off = np.frombuffer(binary.buffers()[1], dtype=np.int32)[binary.offset:binary.offset + len(binary) + 1].astype(np.int64)
    words = np.frombuffer(binary.buffers()[2], dtype=np.uint64)[off[0] // 8: off[-1] // 8]
    lengths = np.diff((off - off[0]) // 8)
    if not indexed.any() or not asked.any():
        return SPAN_ARROW.empty_table()
    index = FmIndex(words[np.repeat(indexed, lengths)], lengths[indexed], n)
    words, lengths = words[np.repeat(asked, lengths)], lengths[asked]
    found = index.first_positions(words, lengths)
    count = lengths - n + 1
    region = np.repeat(np.arange(len(lengths)), count)
    nth = np.arange(len(region)) - np.repeat(np.cumsum(count) - count, count)
    owner = np.maximum(np.searchsorted(index.starts, np.maximum(found, 0), side="right") - 1, 0)
    first_id = ids[indexed][owner]
    first_at = start[indexed][owner] + found - index.starts[owner]
    keys = keys[asked]
    own_id, own_at = ids[asked][region], start[asked][region] + nth
    earlier = (found >= 0) & ((first_id < own_id) | ((first_id == own_id) & (first_at < own_at)))
    run = earlier.copy()
    run[1:] &= ~(earlier[:-1] & (region[1:] == region[:-1]))
    stop = earlier.copy()
    stop[:-1] &= ~(earlier[1:] & (region[1:] == region[:-1]))
    a, b = np.flatnonzero(run), np.flatnonzero(stop)
    return pa.Table.from_arrays([pa.array(own_id[a]), pa.array(keys[region[a]]), pa.array(own_at[a]),
                                 pa.array(own_at[b] + n)], schema=SPAN_ARROW)


SPAN_ARROW = pa.schema([(f, pa.int64()) for f in ("doc_id", "text_key", "start", "stop")])


def repeated_spans(docs: DataFrame, n: int = WINDOW, seed: int = SEED) -> DataFrame:
    """Word spans ``doc_id, text_key, start, stop`` (several per document, they
    may overlap) of windows that start earlier; ``text_key`` is the text's hash."""
    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).filter(
        "doc_id is not null and length(text) > 0").withColumn("text_key", _key("text"))
    seeds = saved(seed_counts(own, n, seed), "seeds")
    total = seeds.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("regions"), F.lit(0)).alias("r")).first()
    # at most (all regions / HOT) seeds: a thousandth of a percent of the words
    longer = (2 * n - min(seed, n)) / (2 * WINDOW - SEED)        # than the regions of the default window
    hot = {r["seed"]: math.ceil(r["regions"] * longer / HOT) for r in seeds.filter(F.col("regions") * longer > HOT).collect()}
    table = bit_table(seeds, "seed", total["n"])
    shards = max(1, math.ceil(total["r"] * longer / SHARD))
    rows = saved(regions(own, n, seed, table, shards, hot), "regions")
    searched = (rows.filter("shard is not null").groupBy("shard")
                .applyInArrow(lambda t: search_shard(t, n), SPAN))
    inner = rows.filter("shard is null").select("doc_id", "text_key", "start", "stop")
    return searched.unionByName(inner)


def copies(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key`` of documents whose text a smaller doc_id has."""
    own = docs.filter("doc_id is not null and length(text) > 0").select(
        F.col("doc_id").cast("long"), _key("text").alias("text_key"), F.sha2("text", 256).alias("sha"))
    first = own.groupBy("sha").agg(F.min("doc_id").alias("_first"), F.max("doc_id").alias("_last")).filter("_first < _last")
    return own.join(first, "sha").filter("doc_id > _first").select("doc_id", "text_key").distinct()


def may_be_in(hashes: DataFrame, column: str) -> tuple[Broadcast, Callable[[F.Column], F.Column]]:
    """The bit table of a long column, and a UDF on such columns: False where
    no row of ``hashes`` has the value."""
    table = hashes.sparkSession.sparkContext.broadcast(bit_table(hashes, column, hashes.count()))

    @F.arrow_udf("boolean")
    def held(v: pa.Array) -> pa.Array:
        return pa.array(in_table(table.value, v.to_numpy().view(np.uint64)))
    return table, held


def remove_repeats(docs: DataFrame, n: int = WINDOW, seed: int = SEED) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept``: the words that
    are not repeats, joined by one space."""
    spans = repeated_spans(docs, n, seed).unionByName(
        copies(docs).withColumns({"start": F.lit(0).cast("long"), "stop": F.lit(ALL)}))
    listed = saved(spans.groupBy("doc_id", "text_key").agg(
        F.collect_list("start").alias("_start"), F.collect_list("stop").alias("_stop"))
        .withColumnsRenamed({"doc_id": "_id", "text_key": "_text_key"}), "spans")
    table, held = may_be_in(listed.select(F.xxhash64("_id", "_text_key").alias("hash")), "hash")
    new = {"n_words", "n_removed", "kept"}
    names = [c for c in docs.columns if c.lower() not in new]
    # a text that is a string is sent once, beside the other columns
    twice = [c for c in names if c.lower() == "text" and docs.schema[c].dataType == T.StringType()]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names if c not in twice]).alias("_row"), F.col("text").cast("string").alias("_text"),
                       F.col("doc_id").cast("long").alias("_of"), _key("text").alias("_key")).withColumn("_hash", F.xxhash64("_of", "_key"))
    some = rows.filter(held("_hash")).join(listed, (F.col("_of") == F.col("_id")) & (F.col("_key") == F.col("_text_key")), "left")
    # the last step drops those of ``some`` from the rows that are not joined: one Python worker per task
    none = rows.withColumns({c: F.lit(None).cast("array<long>") for c in ("_start", "_stop")})
    joined = none.select("_row", "_text", "_start", "_stop", "_hash").union(
        some.select("_row", "_text", "_start", "_stop", F.lit(None).cast("long")))
    schema = T.StructType([joined.schema["_row"], joined.schema["_text"], T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])

    def start():
        def step(batch):
            single = batch.column(4).is_valid()
            hashes = batch.column(4).fill_null(0).to_numpy().view(np.uint64)
            batch = batch.filter(pa.array(~(single.to_numpy(zero_copy_only=False) & in_table(table.value, hashes))))
            total, removed, kept = [], [], []
            for text, a, b in zip(batch.column(1), batch.column(2), batch.column(3)):
                words = text.as_py().encode().split() if text.is_valid else []
                gone = 0
                if a.is_valid and len(words) >= n:
                    mark = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(mark, np.asarray(a.values), 1)
                    np.add.at(mark, np.minimum(np.asarray(b.values), len(words)), -1)
                    keep = np.cumsum(mark[:-1]) <= 0
                    gone = int(len(words) - keep.sum())
                    final = [words[i] for i in np.flatnonzero(keep)]
                else:
                    final = words
                total.append(len(words))
                removed.append(gone)
                kept.append(b" ".join(final))
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())], names=schema.fieldNames())
        return step
    return map_batches(joined, schema, start, SLICE).select(
        *[(F.col("_text") if c in twice else F.col(f"_row.`{c}`")).alias(c) for c in names], "n_words", "n_removed", "kept")
