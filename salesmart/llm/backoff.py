"""Language-model scores from a weighted backoff automaton.

The model counts runs of one to three tokens (words with A-Z lower-cased, and
an end after each text) in the training texts. With h a context and h' the
same without its first token, p(w | h) = l c(hw) / c(h) + (1 - l) p(w | h'),
ending at the add-one share of the single token. The weight l depends on the
class of the context: how often it occurs, and for two tokens also how much
more often than their own counts suggest (a passage that is copied, or chance).
The weights are those of largest leave-one-out likelihood of all training
tokens, the counts are of all training texts.

As an automaton: states are known contexts of up to two tokens, an arc is a
known run, its target the longest known suffix, and a failure arc leads to the
context without its first token at the price 1 - l. Reading a text
left to right carries a state; a token without an arc follows failure arcs
until there is one.

No machine holds the whole model. Texts are packed to shards of ``SHARD`` bytes:

1. *Ask.* A shard lists its distinct runs with their own training counts, as
   sorted hashes cut to ranges (deltas of 4 or 5 bytes), each once.
2. *Merge.* All lists of a hash range meet in one group of bounded size. Each
   entry is answered, in the order of its list, with the count that all other
   shards have of it; for most runs that is a zero byte.
3. *Fit.* A shard's texts and answers meet in one row, written once. Every
   shard counts its training tokens by class and likelihood ratio, first for
   the weights of one-token contexts, then for those of two.
4. *Score.* A shard's part of the automaton is built (all runs of its texts
   that the model knows), and its texts are read.
   Long texts are entered at many places at once: a state is the longest known
   suffix of what was read, so it follows from the two tokens before.

Lists grow with the texts, never with one token: a run that is in every text
has one entry per shard. Single tokens are told apart by 64-bit hashes, longer
runs by ``16 + log2(bytes of text)`` bits (64 at most), so one in 2**16 lookups
may be confused with another run at any size. ``base_score`` is exact.

NULL and empty texts are one end token. Rows without a training mark (NULL)
are scored but not learned. Repeated rows count and are scored each. Very long
texts are a shard of their own. An empty table gives an empty result. Input
columns with the names of the new ones are replaced. No text is cut.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.llm.common import saved
from salesmart.llm.wordhash import Hasher, buffers, lower_ascii, mix, split_words

#: Text bytes per shard and per hash range; tokens read in one go.
SHARD, RANGE, SPAN = 4 << 20, 4 << 20, 256

_U = np.uint64
BEGIN, END = _U(0xB1E55ED0B1E55ED1), _U(0xE0D0FE0D0FE0D0FD)   # hashes of the marks

NEW = [T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
       T.StructField("train_tokens", T.LongType()), T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())]
ASKED = "shard long, grams int, part long, width int, size long, deltas binary, counts binary, more binary"
ANSWER = "shard long, grams int, part long, counts binary, more binary, runs long, tokens long"
WHOLE = "shard long, body binary, counts1 binary, more1 binary, counts2 binary, more2 binary, counts3 binary, more3 binary"
SEEN = "kind long, bin long, n long"


# ---- shards ---------------------------------------------------------------

def pack(docs: DataFrame, shard_bytes: int) -> DataFrame:
    """``shard, n_bytes, body``: the rows (``_row, _text, _train``) of about
    ``shard_bytes`` of text as one compressed Arrow table, written once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def bundle(rows: list[pa.RecordBatch], size: int, k: int) -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            whole = pa.Table.from_batches(rows).combine_chunks()
            with pa.ipc.new_stream(sink, whole.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(whole)
            shard = TaskContext.get().partitionId() << 32 | k
            return pa.RecordBatch.from_arrays([pa.array([shard]), pa.array([size]), pa.array([sink.getvalue().to_pybytes()])],
                                              names=["shard", "n_bytes", "body"])
        rows, size, k = [], 0, 0
        for batch in batches:
            step = max(1, batch.num_rows * shard_bytes // (8 * max(batch.nbytes, 1)))
            for i in range(0, batch.num_rows, step):
                part = batch.slice(i, step)
                rows.append(part)
                size += int(buffers(part.column(1))[1][-1])
                if size >= shard_bytes:
                    yield bundle(rows, size, k)
                    rows, size, k = [], 0, k + 1
        if rows:
            yield bundle(rows, size, k)
    return saved(docs.select("_row", "_text", "_train").mapInArrow(run, "shard long, n_bytes long, body binary"), "lm-shards")


class Shard:
    """The distinct runs of a shard's texts. Order k has sorted keys
    ``keys[k]``; a key is the place of the run without its last token in the
    order below, times the number of words, plus the last token's word id."""

    def __init__(self, body: bytes, hasher: Hasher, grams: int = 3) -> None:
        rows = pa.ipc.open_stream(body).read_all().combine_chunks()
        self.rows, self.train = rows["_row"], rows["_train"].combine_chunks().fill_null(False)
        data, off = buffers(rows["_text"])
        data = lower_ascii(data)
        starts, ends, first = split_words(data, off)
        words = np.diff(first)
        self.docs = len(words)
        self.begin = first[:-1] + 2 * np.arange(self.docs)          # place of each text's begin mark
        self.size = words + 2
        seq = np.empty(len(starts) + 2 * self.docs, dtype=np.uint64)
        inner = np.ones(len(seq), dtype=bool)
        inner[self.begin] = inner[self.begin + self.size - 1] = False
        seq[inner] = hasher.words(data, starts, ends)
        seq[self.begin], seq[self.begin + self.size - 1] = BEGIN, END
        del data, starts, ends, inner, rows
        self.doc = np.repeat(np.arange(self.docs, dtype=np.int32), self.size)
        train = np.repeat(self.train.to_numpy(zero_copy_only=False).astype(bool), self.size)
        self.word, self.ids = _distinct(seq)
        self.n = n = len(self.word)
        self.begin_id, self.end_id = (int(np.searchsorted(self.word, x)) for x in (BEGIN, END))
        self.keys, self.counts = {1: np.arange(n)}, {1: np.bincount(self.ids[train & (self.ids != self.begin_id)], minlength=n)}
        more = self.ids[:-1] != self.end_id                         # places with a next token
        self.pair = np.full(len(seq), -1, dtype=np.int32)           # place of (this, next) among the pairs
        self.three = self.pair.copy() if grams > 2 else None        # and with the token after among the runs of three
        self.keys[2], at = _distinct(self.ids[:-1][more].astype(np.int64) * n + self.ids[1:][more])
        self.pair[:-1][more] = at
        self.counts[2] = np.bincount(at[train[:-1][more]], minlength=len(self.keys[2]))
        if grams < 3:
            return
        three = more[:-1] & more[1:]
        self.keys[3], at = _distinct(self.pair[:-2][three].astype(np.int64) * n + self.ids[2:][three])
        self.three[:-2][three] = at
        self.counts[3] = np.bincount(at[train[:-2][three]], minlength=len(self.keys[3]))

    def hashes(self, grams: int) -> np.ndarray:
        """Of the runs; equal in all shards."""
        if grams == 1:
            return self.word
        return self._join(self.hashes(grams - 1)[self.keys[grams] // self.n], self.word[self.keys[grams] % self.n])

    @staticmethod
    def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix(a * _U(0x9E3779B97F4A7C15) + mix(b + _U(0x632BE59BD9B4E019)))

    def ordered(self, grams: int) -> np.ndarray:
        """The runs by hash (equal ones by key): the order of lists and answers."""
        return _order(self.hashes(grams))


def _order(v: np.ndarray) -> np.ndarray:
    """Stable order of values of 0 or more. Places are sorted in the low bits of
    the values (or of their high bits), which is faster than by reference."""
    v = v.astype(np.uint64, copy=False)
    bits = max(len(v) - 1, 0).bit_length()
    low = _U((1 << bits) - 1)
    fits = int(v.max(initial=_U(0))).bit_length() + bits <= 64
    both = v << _U(bits) if fits else v & ~low
    both |= np.arange(len(v), dtype=np.uint64)
    both.sort()
    both &= low
    order = both.astype(np.int32)
    if not fits:
        got = v[order]
        if (got[1:] < got[:-1]).any():                  # values that differ in the replaced bits only
            return np.argsort(v, kind="stable").astype(np.int32)
    return order


def _distinct(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and the place of each value among them."""
    order = _order(v)
    v = v[order]
    new = np.ones(len(v), dtype=bool)
    new[1:] = v[1:] != v[:-1]
    at = np.empty(len(v), dtype=np.int32)
    at[order] = np.cumsum(new, dtype=np.int32) - 1
    return v[new], at


def part_of(h: np.ndarray, parts: int) -> np.ndarray:
    return ((h >> _U(32)) * _U(parts)) >> _U(32)


def part_low(part: np.ndarray, parts: int) -> np.ndarray:
    """The smallest hash of a range."""
    return (((part.astype(np.uint64) << _U(32)) + _U(parts - 1)) // _U(parts)) << _U(32)


def packed_counts(counts: np.ndarray, cut: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Counts between the places ``cut``, one byte each, larger ones (255) in
    a second column."""
    big = counts >= 255
    low = np.minimum(counts, 255).astype(np.uint8)
    high = np.concatenate([[0], np.cumsum(big)])[cut] * 8
    return _binary(low, cut), _binary(counts[big].astype(np.int64).view(np.uint8), high)


def unpacked_counts(low: pa.Array, high: pa.Array) -> np.ndarray:
    out = _bytes(low).astype(np.int64)
    out[out == 255] = _bytes(high).view(np.int64)
    return out


def _binary(data: np.ndarray, cut: np.ndarray) -> pa.Array:
    return pa.BinaryArray.from_buffers(pa.binary(), len(cut) - 1, [None, pa.py_buffer(cut.astype(np.int32)),
                                                                   pa.py_buffer(np.ascontiguousarray(data))])


def _bytes(column: pa.Array) -> np.ndarray:
    """All bytes of a binary array, one value after the other."""
    if not len(column):
        return np.zeros(0, np.uint8)
    off = np.frombuffer(column.buffers()[1], np.int32)[column.offset: column.offset + len(column) + 1]
    if off[0] == off[-1]:
        return np.zeros(0, np.uint8)
    return np.frombuffer(column.buffers()[2], np.uint8)[off[0]: off[-1]].copy()


def asked(shards: DataFrame, parts: int, bits: int) -> DataFrame:
    """The lists of all shards."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for number, body in zip(batch.column(0), batch.column(1)):
                shard = Shard(body.as_py(), hasher)
                for grams in (1, 2, 3):
                    order = shard.ordered(grams)
                    h = shard.hashes(grams)[order]
                    if not len(h):
                        continue
                    part = part_of(h, parts)
                    cut = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(h)]])
                    part = part[cut[:-1]]
                    drop = _U(64 - bits if grams > 1 else 0)
                    h, low = h >> drop, part_low(part, parts) >> drop
                    delta = h.copy()
                    delta[1:] -= h[:-1]
                    delta[cut[:-1]] = h[cut[:-1]] - low
                    width = max(1, -(-int(delta.max()).bit_length() // 8))
                    body_bytes = delta.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].reshape(-1)
                    counts, more = packed_counts(shard.counts[grams][order], cut)
                    n = len(part)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([number.as_py()] * n, pa.int64()), pa.array([grams] * n, pa.int32()), pa.array(part.astype(np.int64)),
                         pa.array([width] * n, pa.int32()), pa.array(np.diff(cut)), _binary(body_bytes, cut * width), counts, more],
                        names=[c.split()[0] for c in ASKED.split(", ")])
    return shards.select("shard", "body").mapInArrow(run, ASKED)


def merge(lists: pa.Table, parts: int, bits: int) -> pa.Table:
    """The answers to all lists of one range, and its distinct and all training runs."""
    lists = lists.combine_chunks()
    col = {c: (lists[c].chunk(0) if lists[c].num_chunks else lists[c].combine_chunks()) for c in lists.column_names}
    grams, part, size = col["grams"][0].as_py(), np.asarray(col["part"]), np.asarray(col["size"])
    width = np.asarray(col["width"])
    cut = np.concatenate([[0], np.cumsum(size)])
    delta = np.zeros((cut[-1], 8), dtype=np.uint8)
    for w in np.unique(width):
        mine = np.flatnonzero(width == w)
        delta[np.repeat(width == w, size), :w] = _bytes(col["deltas"].take(pa.array(mine))).reshape(-1, w)
    run = np.concatenate([[_U(0)], np.cumsum(delta.view("<u8").reshape(-1), dtype=np.uint64)])
    low = part_low(part, parts) >> _U(64 - bits if grams > 1 else 0)
    h = run[1:] - np.repeat(run[cut[:-1]] - low, size)
    own = unpacked_counts(col["counts"], col["more"])
    order = _order(h)
    new = np.ones(len(h), dtype=bool)
    new[1:] = h[order][1:] != h[order][:-1]
    total = np.add.reduceat(own[order], np.flatnonzero(new)) if len(h) else own
    others = np.empty_like(own)
    others[order] = total[np.cumsum(new) - 1]
    others -= own
    counts, more = packed_counts(others, cut)
    n = len(lists)
    return pa.table({
        "shard": pa.concat_arrays([col["shard"].cast(pa.int64()), pa.nulls(1, pa.int64())]),
        "grams": pa.array([grams] * (n + 1), pa.int32()), "part": pa.concat_arrays([col["part"], pa.nulls(1, pa.int64())]),
        "counts": pa.concat_arrays([counts, pa.nulls(1, pa.binary())]), "more": pa.concat_arrays([more, pa.nulls(1, pa.binary())]),
        "runs": pa.array([None] * n + [int((total > 0).sum())], pa.int64()), "tokens": pa.array([None] * n + [int(total.sum())], pa.int64()),
    })


# ---- the model ------------------------------------------------------------

#: Classes of contexts: powers of two of the count, and of its ratio to chance from 2**LOW on.
COUNTS, RATIOS, LOW = 48, 41, -10
#: Likelihood ratios are gathered in quarters of their logarithm, from exp(-BINS / 8) on.
BINS = 400
#: Strength with which a class's weight is drawn to that of all contexts.
PRIOR = 10.0


def count_class(n: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(np.log2(np.maximum(n, 1))).astype(np.int64), 0, COUNTS - 1)


def pair_class(n: np.ndarray, first: np.ndarray, second: np.ndarray, total: int) -> np.ndarray:
    """By the pair's count and its ratio to the one expected by chance."""
    ratio = np.log2(np.maximum(n, 1) * float(max(total, 1)) / (np.maximum(first, 1).astype(float) * np.maximum(second, 1)))
    return count_class(n) * RATIOS + np.clip(np.floor(ratio).astype(np.int64) - LOW, 0, RATIOS - 1)


def ratio_bin(share: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Bin of share / lower; 0 for a share of 0."""
    with np.errstate(divide="ignore"):
        place = np.floor(4 * np.log(share / lower)) + BINS // 2
    return np.where(share > 0, 1 + np.clip(place, 0, BINS - 1), 0).astype(np.int64)


def weights(seen: np.ndarray) -> np.ndarray:
    """The weight of each class that maximises the likelihood, from the number
    of tokens per (class, bin); drawn to the weight of all classes together."""
    ratio = np.concatenate([[0.0], np.exp((np.arange(BINS) - BINS // 2 + 0.5) / 4)])

    def best(n: np.ndarray, prior: np.ndarray | float, strength: float) -> np.ndarray:
        w = np.full(len(n), 0.5)
        for _ in range(60):
            hit = (w[:, None] * ratio / (w[:, None] * ratio + 1 - w[:, None]) * n).sum(axis=1)
            w = np.clip((hit + strength * prior) / (n.sum(axis=1) + strength), 1e-6, 1 - 1e-6)
        return w
    every = best(seen.sum(axis=0, keepdims=True), 0.5, 1.0)[0]
    return best(seen, every, PRIOR)


class Known:
    """A shard with the counts of all training texts: ``counts[k]`` of its
    runs, ``context`` of its words (the begin mark counts as often as the end)."""

    def __init__(self, row: dict, model: dict, hasher: Hasher, grams: int = 3) -> None:
        self.shard = shard = Shard(row["body"], hasher, grams)
        self.model, self.counts = model, {}
        for k in range(1, grams + 1):
            self.counts[k] = shard.counts[k].copy()
            self.counts[k][shard.ordered(k)] += unpacked_counts(*[pa.array([row[f"{c}{k}"]], pa.binary()) for c in ("counts", "more")])
        self.context = self.counts[1].copy()
        self.context[shard.begin_id] = self.context[shard.end_id]

    def observe(self, order: int) -> np.ndarray:
        """Training tokens per (class of the context, bin), without themselves."""
        shard, model = self.shard, self.model
        at = np.flatnonzero((shard.ids != shard.begin_id) & np.repeat(
            shard.train.to_numpy(zero_copy_only=False).astype(bool), shard.size))
        if order == 3:
            at = at[shard.ids[at - 1] != shard.begin_id]
        lower = self.counts[1][shard.ids[at]] / (model["N"] + model["V"])
        times = self.context[shard.ids[at - 1]] - 1
        share = (self.counts[2][shard.pair[at - 1]] - 1) / np.maximum(times, 1)
        kind, size = count_class(times), COUNTS
        if order == 3:
            w = np.where(times > 0, model[2][kind], 0)
            lower = w * share + (1 - w) * lower
            pair = shard.pair[at - 2]
            times = self.counts[2][pair] - 1
            share = (self.counts[3][shard.three[at - 2]] - 1) / np.maximum(times, 1)
            kind, size = pair_class(times, self.context[shard.ids[at - 2]], self.context[shard.ids[at - 1]], model["N"]), COUNTS * RATIOS
        some = times > 0
        place = kind[some] * (BINS + 1) + ratio_bin(share[some], lower[some])
        return np.bincount(place, minlength=size * (BINS + 1)).reshape(size, BINS + 1)


class Automaton:
    """The part of the backoff automaton that a shard's texts can reach.

    States: 0 the empty context, 1 + word, 1 + words + pair. An arc is a known
    run; as a state is a suffix of what was read, the arc for a token is the run
    of one, two or three tokens that ends there: ``arc[k]`` has it for each place
    and states of ``k`` tokens, or -1. Weights are log10 probabilities."""

    def __init__(self, known: Known) -> None:
        shard, counts, one, model = known.shard, known.counts, known.context, known.model
        self.n = n = shard.n
        total = model["N"] + model["V"] + 1
        self.unknown = -math.log10(total)
        arcs = {k: np.flatnonzero(counts[k] > 0) for k in (1, 2, 3)}
        p1 = (counts[1] + 1) / total
        a, b = shard.keys[2] // n, shard.keys[2] % n
        w1 = np.where(one > 0, model[2][count_class(one)], 0)
        w2 = np.where(counts[2] > 0, model[3][pair_class(counts[2], one[a], one[b], model["N"])], 0)
        p2 = w1[a] * counts[2] / np.maximum(one[a], 1) + (1 - w1[a]) * p1[b]
        self.fail = np.concatenate([np.zeros(1 + n, dtype=np.int32), np.where(one[b] > 0, 1 + b, 0).astype(np.int32)])
        self.price = np.concatenate([[0.0], np.log10(1 - w1), np.log10(1 - w2)])
        self.known_state = np.concatenate([[True], one > 0, counts[2] > 0])
        ab = shard.keys[3][arcs[3]] // n
        at3 = np.flatnonzero(shard.three >= 0)
        bc = np.empty(len(shard.keys[3]), dtype=np.int32)
        bc[shard.three[at3]] = shard.pair[at3 + 1]
        bc = bc[arcs[3]]
        del a, b
        p3 = w2[ab] * counts[3][arcs[3]] / np.maximum(counts[2][ab], 1) + (1 - w2[ab]) * p2[bc]
        del ab
        self.weight = np.log10(np.concatenate([p1[arcs[1]], p2[arcs[2]], p3]))
        self.target = np.concatenate([1 + arcs[1], 1 + n + arcs[2], 1 + n + bc]).astype(np.int32)
        del bc, p2, p3
        self.arc = np.full((3, len(shard.ids)), -1, dtype=np.int32)
        before = 0
        for k, run in ((1, shard.ids), (2, shard.pair[:-1]), (3, shard.three[:-2])):
            number = np.full(len(counts[k]) + 1, -1, dtype=np.int32)      # the last is that of places without a run
            number[arcs[k]] = before + np.arange(len(arcs[k]))
            self.arc[k - 1, k - 1:] = number[run]
            before += len(arcs[k])

    def state(self, shard: Shard, at: np.ndarray) -> np.ndarray:
        """The state before the token at each place: the longest known suffix."""
        first = at - 1 < shard.begin[shard.doc[at]] + 1
        pair = np.where(first, 0, 1 + self.n + shard.pair[np.maximum(at - 2, 0)].astype(np.int64))
        one = 1 + shard.ids[at - 1].astype(np.int64)
        one = np.where(self.known_state[one], one, 0)
        return np.where(~first & self.known_state[pair], pair, one)

    def read(self, begin: np.ndarray, size: np.ndarray, state: np.ndarray) -> np.ndarray:
        """log10 probability of the tokens at ``begin:begin + size`` from each
        state on; all are read side by side, longest first."""
        out = np.zeros(len(begin))
        rank = np.argsort(-size, kind="stable")
        begin, state = begin[rank], state[rank].copy()
        alive = len(size) - np.cumsum(np.bincount(size, minlength=int(size.max(initial=0)) + 1))
        sums = np.zeros(len(begin))
        for k in range(int(size.max(initial=0))):
            m = int(alive[k])
            place = begin[:m] + k
            todo, at = np.arange(m), state[:m].copy()
            while len(todo):
                arc = self.arc[(at > 0).astype(np.int8) + (at > self.n), place[todo]]
                hit = arc >= 0
                done, arc = todo[hit], arc[hit]
                sums[done] += self.weight[arc]
                state[done] = self.target[arc]
                todo, at = todo[~hit], at[~hit]
                root = at == 0                          # no arc anywhere: an unknown token
                sums[todo[root]] += self.unknown
                state[todo[root]] = 0
                todo, at = todo[~root], at[~root]
                sums[todo] += self.price[at]
                at = self.fail[at]
        out[rank] = sums
        return out


def gather(rows: pa.Table) -> pa.Table:
    """One row of a shard's body and its answers, in the order of their ranges."""
    grams, part = rows["grams"].to_numpy(), rows["part"].to_numpy()
    row = {"shard": rows["shard"][0].as_py(), "body": rows["body"][int(np.flatnonzero(grams == 0)[0])].as_py()}
    for k in (1, 2, 3):
        mine = np.flatnonzero(grams == k)
        mine = pa.array(mine[np.argsort(part[mine], kind="stable")])
        for c in ("counts", "more"):
            row[f"{c}{k}"] = b"".join(rows[c].take(mine).to_pylist())
    return pa.table({c: pa.array([v], pa.int64() if c == "shard" else pa.binary()) for c, v in row.items()})


def each_shard(whole: DataFrame, run: Callable[[dict, Hasher], pa.Table], schema: T.StructType | str) -> DataFrame:
    """``run`` on one row of ``whole`` at a time."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for i in range(batch.num_rows):
                yield from run(batch.slice(i, 1).to_pylist()[0], hasher).to_batches()
    return whole.mapInArrow(step, schema)


def observe_shard(row: dict, model: dict, order: int, hasher: Hasher) -> pa.Table:
    """``kind, bin, n`` of all of a shard's training tokens."""
    seen = Known(row, model, hasher, order).observe(order)
    kind, bin_ = np.nonzero(seen)
    return pa.table([pa.array(kind), pa.array(bin_), pa.array(seen[kind, bin_])], names=["kind", "bin", "n"])


def read_shard(row: dict, model: dict, span: int, hasher: Hasher) -> pa.Table:
    """Score the texts of a shard from its body and its answers."""
    known = Known(row, model, hasher)
    shard = known.shard
    token = shard.ids != shard.begin_id
    of, count = shard.doc[token], known.counts[1][shard.ids[token]]
    base = np.bincount(of, np.log10((count + 1) / (model["N"] + model["V"] + 1)), shard.docs)
    met = np.bincount(of[count > 0], minlength=shard.docs)
    del token, of, count
    automaton = Automaton(known)
    pieces = -(-(shard.size - 1) // span)                       # of each text, without its begin mark
    doc = np.repeat(np.arange(shard.docs), pieces)
    begin = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * span
    size = np.minimum(shard.size[doc] - 1 - begin, span)
    begin += shard.begin[doc] + 1
    score = np.bincount(doc, automaton.read(begin, size, automaton.state(shard, begin)), shard.docs)
    return pa.table([shard.rows, pa.compute.invert(shard.train), pa.array(shard.size - 1), pa.array(met, pa.int64()),
                     pa.array(np.full(shard.docs, model["N"], np.int64)), pa.array(base), pa.array(score)],
                    names=["_row", *[f.name for f in NEW]])


def score(docs: DataFrame, train: Column, text: str = "text", keep: list[str] | None = None, shard_bytes: int = SHARD,
          range_bytes: int = RANGE, span: int = SPAN, fit_shards: int | None = None) -> DataFrame:
    """All rows of ``docs`` (columns ``keep``, or all) with the columns of
    ``NEW``; the model is learned from the rows that ``train`` marks. With
    ``fit_shards`` the weights are fitted on so many shards only."""
    new = {f.name for f in NEW}
    names = [c for c in (docs.columns if keep is None else keep) if c.lower() not in new]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col(f"`{text}`").cast("string").alias("_text"),
                       train.alias("_train"))
    shards = pack(rows, shard_bytes)
    size = shards.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    parts, bits = max(1, -(-size // range_bytes)), min(64, 16 + max(size, 1).bit_length())
    answers = saved(asked(shards, parts, bits).groupBy("grams", "part").applyInArrow(lambda t: merge(t, parts, bits), ANSWER), "lm-answers")
    totals = answers.filter("shard is null and grams = 1").agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("runs"), F.lit(0))).first()
    model = {"N": totals[0], "V": totals[1], 2: np.zeros(COUNTS), 3: np.zeros(COUNTS * RATIOS)}
    nothing = [F.lit(None).cast("binary").alias(c) for c in ("counts", "more")]
    both = shards.select("shard", F.lit(0).alias("grams"), F.lit(0).cast("long").alias("part"), "body", *nothing).unionByName(
        answers.filter("shard is not null").select("shard", "grams", "part", F.lit(None).cast("binary").alias("body"), "counts", "more"))
    whole = saved(both.groupBy("shard").applyInArrow(gather, WHOLE), "lm-whole")
    fitted = whole
    if fit_shards is not None:
        chosen = [r[0] for r in shards.select("shard").orderBy(F.xxhash64("shard")).limit(fit_shards).collect()]
        fitted = whole.filter(F.col("shard").isin(chosen))

    def observed(order: int, model: dict) -> DataFrame:
        asked_for = ["body", *[f"{c}{k}" for k in range(1, order + 1) for c in ("counts", "more")]]
        return each_shard(fitted.select(*asked_for), lambda row, hasher: observe_shard(row, model, order, hasher), SEEN)
    for order in (2, 3):
        got = observed(order, dict(model)).groupBy("kind", "bin").agg(F.sum("n").alias("n")).toArrow()
        seen = np.zeros((len(model[order]), BINS + 1))
        seen[got["kind"].to_numpy(), got["bin"].to_numpy()] = got["n"].to_numpy()
        model[order] = weights(seen)
    schema = T.StructType([rows.schema["_row"], *NEW])
    return each_shard(whole, lambda row, hasher: read_shard(row, model, span, hasher), schema).select(
        "_row.*", *[f.name for f in NEW])
