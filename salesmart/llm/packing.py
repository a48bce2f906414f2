"""Best-fit packing by bin completion.

Documents are tokenised and cut into pieces of at most ``capacity`` ids, then
packed into as few sequences as possible. Piece lengths are small integers,
so the packing problem of any corpus is a histogram of at most ``capacity``
counts: Spark counts it, the driver solves the histogram, Spark assigns the
pieces. The plan is a list of patterns (a filling and how often it is used),
so its size does not grow with the corpus.

The plan is found by bin completion: around the largest remaining length the
undominated fillings are enumerated, least waste first, and used as often as
the counts allow; a branch whose waste exceeds what an improvement may waste
is pruned. Best-fit decreasing gives the first incumbent, and a search that
meets its node limit returns the best plan so far.

NULL and empty texts are documents of the end id alone. A NULL ``doc_id`` is
kept. Repeated rows are packed once each. An empty table packs into no
sequence. Input columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import array
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.llm.common import map_batches, saved

CAPACITY, END_ID = 1024, 2
#: Texts are tokenised in slices of about this many characters.
SLICE = 1 << 20
#: A run of so many characters without (or of nothing but) white space goes
#: to the tokenizers library, whose merges stay near linear on long runs.
LONG_RUN = 4000
#: Pieces numbered in one window group; fillings tried per branch; nodes searched.
RANK_GROUP, BRANCHES, NODES = 50_000, 4, 4000
#: The GPT-2 pre-token pattern that the vocabulary file's ByteLevel step uses (fixed value).
PRETOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()),
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()),
])


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids of a byte-level BPE vocabulary (the content of a tokenizers JSON file)."""

    def __init__(self, spec: str) -> None:
        import tiktoken
        parsed = json.loads(spec)
        letters = byte_letters()
        special = {t["content"] for t in parsed.get("added_tokens", ())}
        ranks = {bytes(letters[c] for c in w): i for w, i in parsed["model"]["vocab"].items() if w not in special}
        self.spec, self.slow = spec, None
        self.fast = tiktoken.Encoding("vocabulary", pat_str=PRETOKENS, mergeable_ranks=ranks, special_tokens={})
        self.run = re.compile(r"\S{%d}|\s{%d}" % (LONG_RUN, LONG_RUN))
        self.cut = re.compile(r"\S(?= \S)")

    def slices(self, text: str) -> Iterator[str]:
        """The text in slices cut before a lone space, where a pre-token
        always begins."""
        at = 0
        while len(text) - at > SLICE:
            m = self.cut.search(text, at + SLICE)
            if m is None:
                break
            yield text[at:m.end()]
            at = m.end()
        yield text[at:] if at else text

    def encode(self, text: str) -> array.array:
        ids = array.array("I")
        for part in self.slices(text):
            if len(part) > LONG_RUN and self.run.search(part):
                if self.slow is None:
                    from tokenizers import Tokenizer
                    self.slow = Tokenizer.from_str(self.spec)
                    self.slow.encode_special_tokens = True
                ids.extend(self.slow.encode(part, add_special_tokens=False).ids)
            else:
                ids.extend(self.fast.encode_ordinary(part))
        return ids


def cut_lengths(n: int, capacity: int) -> list[int]:
    """Piece lengths of a document of ``n`` ids: full pieces after a first
    one that may be shorter."""
    first = n % capacity or capacity
    return [first] + [capacity] * ((n - first) // capacity)


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32``.
    ``vocabulary`` is the path of a tokenizers JSON file on the driver; its
    text (of fixed size) is broadcast."""
    with open(vocabulary, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def start():
        enc = Encoder(spec.value)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            cols: tuple[list, ...] = ([], [], [], [], [])
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = enc.encode(text.as_py() or "")
                ids.append(end_id)
                raw = memoryview(np.asarray(ids, dtype="<u4").tobytes())
                at = 0
                for i, n in enumerate(cut_lengths(len(ids), capacity)):
                    for col, v in zip(cols, (doc_id, i, at, n, zlib.crc32(raw[4 * at:4 * (at + n)]))):
                        col.append(v)
                    at += n
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                names=PIECES.fieldNames())
        return step
    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), PIECES, start)


# -- the plan -----------------------------------------------------------------

Pattern = tuple[tuple[int, ...], int]      # lengths in a sequence, how many such sequences


def best_fit_plan(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing on the histogram: around the largest length, again
    and again the largest length that still fits."""
    left = {n: c for n, c in counts.items() if c > 0}
    out: list[Pattern] = []
    while left:
        fill, room, used = [], capacity, {}
        for n in sorted(left, reverse=True):
            take = min(left[n], room // n)
            if take:
                fill += [n] * take
                used[n] = take
                room -= n * take
        times = min(left[n] // k for n, k in used.items())
        out.append((tuple(fill), times))
        for n, k in used.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
    return out


def fillings(left: dict[int, int], lengths: list[int], room: int, limit: int, nodes: int = 3000) -> list[tuple[int, tuple[int, ...]]]:
    """Undominated fillings of ``room`` from the lengths still left (given in
    descending order), as (waste, lengths): least waste first, then fewest
    pieces. A filling is dominated if a length left over fits into its waste,
    or if one of its lengths can be swapped for a longer one that fits."""
    found: list[tuple[int, int, tuple[int, ...]]] = []
    seen = 0
    exact = 0

    def undominated(fill: list[int], used: dict[int, int], waste: int) -> bool:
        if not waste:
            return True
        spare = [n for n in lengths if left[n] > used.get(n, 0)]
        return not any(n <= waste or any(a < n <= a + waste for a in fill) for n in spare)

    def go(i: int, room: int, fill: list[int], used: dict[int, int]) -> None:
        nonlocal seen, exact
        seen += 1
        if seen > nodes or exact >= limit:
            return
        if room == 0 or i == len(lengths) or not any(n <= room for n in lengths[i:] if left[n] > used.get(n, 0)):
            if undominated(fill, used, room):
                found.append((room, len(fill), tuple(fill)))
                exact += room == 0
            return
        for j in range(i, len(lengths)):
            n = lengths[j]
            if n <= room and left[n] > used.get(n, 0):
                used[n] = used.get(n, 0) + 1
                fill.append(n)
                go(j, room - n, fill, used)
                fill.pop()
                used[n] -= 1
                if seen > nodes or exact >= limit:
                    return

    go(0, room, [], {})
    found.sort()
    return [(w, f) for w, _, f in found[:limit]]


def plan(counts: dict[int, int], capacity: int = CAPACITY, branches: int = BRANCHES, nodes: int = NODES) -> list[Pattern]:
    """Patterns that use every counted piece once, in as few sequences as the
    search finds."""
    counts = {int(n): int(c) for n, c in counts.items() if c > 0}
    if not counts:
        return []
    total = sum(n * c for n, c in counts.items())
    least = max(-(-total // capacity), sum(c for n, c in counts.items() if 2 * n > capacity))
    best = best_fit_plan(counts, capacity)
    bins = sum(k for _, k in best)
    stack: list[tuple[dict[int, int], list[Pattern], int]] = [(counts, [], 0)]
    seen = 0
    while stack and bins > least and seen < nodes:
        seen += 1
        left, done, waste = stack.pop()
        if waste > (bins - 1) * capacity - total:       # cannot become better than the incumbent
            continue
        if not left:
            best, bins = done, sum(k for _, k in done)
            continue
        big = max(left)
        rest = dict(left)
        rest[big] -= 1
        lengths = sorted((n for n, c in rest.items() if c and n <= capacity - big), reverse=True)
        options = fillings(rest, lengths, capacity - big, branches)
        if not options:
            options = [(capacity - big, ())]
        for w, fill in reversed(options):               # the least waste is explored first
            whole = (big, *fill)
            need = {n: whole.count(n) for n in set(whole)}
            times = min(left[n] // k for n, k in need.items())
            after = {n: c - need.get(n, 0) * times for n, c in left.items()}
            stack.append(({n: c for n, c in after.items() if c}, [*done, (whole, times)], waste + w * times))
    return best


def slots(patterns: list[Pattern]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, number of ranks, first sequence, offset): the
    pieces of one length, in rank order, fill the slots in this order."""
    out, sequence, rank = [], 0, {}
    for whole, times in patterns:
        at = 0
        for n in whole:
            out.append((n, rank.get(n, 0), times, sequence, at))
            rank[n] = rank.get(n, 0) + times
            at += n
        sequence += times
    return out


# -- the assignment -----------------------------------------------------------

def ranked(rows: DataFrame, total: int) -> DataFrame:
    """``rows`` with ``rank``: 0, 1, ... among the rows of one length. Rows are
    numbered inside hash groups of bounded size; each group starts after the
    counts of the groups before it, so no length is numbered in one task."""
    groups = max(1, -(-total // RANK_GROUP)) * 4
    dealt = rows.withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))
    sizes = dealt.groupBy("length", "_group").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "_group", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_group").orderBy("doc_id", "piece", "ids_crc32")
    return (dealt.withColumn("_i", F.row_number().over(inside) - 1)
            .join(sizes, ["length", "_group"])
            .withColumn("rank", F.col("_before") + F.col("_i")).drop("_group", "_i", "_before"))


def pack(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``rows`` (pieces; read more than once, so saved by the caller) with
    ``sequence_id`` and ``offset``."""
    spark = rows.sparkSession
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = slots(plan(counts, capacity))
    table = spark.createDataFrame(pa.table({
        name: pa.array([p[i] for p in places], pa.int64())
        for i, name in enumerate(("_length", "_first", "_times", "_sequence", "offset"))}))
    # the plan has at most one slot per piece of a pattern and its size does
    # not follow the corpus: a few thousand rows
    ready = ranked(rows, sum(counts.values()))
    joined = ready.join(F.broadcast(table) if len(places) <= 200_000 else table,
                        (F.col("length") == F.col("_length")) & (F.col("rank") >= F.col("_first"))
                        & (F.col("rank") < F.col("_first") + F.col("_times")))
    return joined.select(*[c for c in rows.columns if c not in ("sequence_id", "offset")],
                         (F.col("_sequence") + F.col("rank") - F.col("_first")).alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Tokenise, cut and pack all documents."""
    return pack(saved(pieces(docs, vocabulary, capacity, end_id), "pieces"), capacity)
