"""Spelling variants of a corpus's words, with a variable-length gram index.

Words are runs of ASCII letters (A-Z lower-cased) and U+00C0-U+00FF. Two words
are near if one inserted, deleted or replaced character makes them equal.

1. *Words* are counted with partial sums; rare and short ones go.
2. *Gram dictionary.* Words are padded with one mark at either end. The grams
   of ``Q_MIN`` to ``Q_MAX - 1`` symbols are counted over all words; those
   above a frequency are the inner nodes of the dictionary. A gram is extended
   while it is frequent, so the infrequent ones stay short and the lists of the
   frequent ones are split. The frequency grows with the words, which bounds
   the dictionary to ``DICTIONARY`` entries (a count of ``m`` grams holds at
   most m / f of frequency f); only this is broadcast.
3. *Decomposition.* At every place the longest gram is taken; grams inside an
   earlier one are left out.
4. *Bounds.* For an edit after ``e`` symbols, with ``r`` symbols behind it, the
   grams that start ``Q_MAX`` or more before the edit, and those that end
   ``Q_MAX`` or more behind it, cannot be affected: no lookup there reads the
   edited symbol, and no gram that does is long enough to swallow one of them.
   All other grams may be affected. So near words have the unaffected grams
   of some (e, r) in common, all of them, at equal distances from the word's
   beginning or end. ``Q_MAX`` is half of the shortest padded word, so at
   least one gram is always unaffected.
5. *List merging.* The inverted lists of all unaffected grams of an (e, r) are
   merged at once: their intersection is the list of one combined key. A word
   of l characters is in at most 2 l such lists, and in at most a few hundred
   if it is very long (places are then rounded to steps).
6. *Verification* by edit distance within each merged list. A list of more
   than ``LIST`` words is dealt to lists of words that agree but for one
   character removed; that is exact as well, and bounds the work by the alphabet.

A word's form is its near word of largest count (ties: smallest in code-point
order) if that is at least ``RATIO`` times as frequent; roots follow the forms
by pointer jumping, in a number of rounds bounded by the largest count.

NULL and empty texts have no words; repeated rows count again; a NULL
``doc_id`` is as good as any other. Texts are read whole. An empty table gives
an empty result. Only ``doc_id`` and the text are read, so other columns may
have any name.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import map_batches, saved
from salesmart.llm.runs import Crc32, runs
from salesmart.llm.wordhash import buffers, lower_ascii, mix

LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5
Q_MIN, Q_MAX = 2, (LEAST_LENGTH + 2) // 2
FREQUENT, DICTIONARY = 50, 1 << 20
LIST, FINE = 256, 64

_U = np.uint64
BEGIN, END = 1, 2       # marks; no letter has these codes


def word_counts(docs: DataFrame, text: str = "text", least_length: int = LEAST_LENGTH, typo_every: int = 0) -> DataFrame:
    """``word, n`` of all words of at least ``least_length`` characters.

    With ``typo_every`` k, an occurrence loses one character if k divides the
    CRC-32 h of ``<doc_id>:<word>``: the one at place h modulo its length."""
    def start():
        crc = Crc32()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            data, off = buffers(batch.column(1))
            data = lower_ascii(data)
            high = data == 0xC3                     # leads U+00C0-U+00FF and nothing else
            letter = ((data >= 97) & (data <= 122)) | high
            letter[1:] |= high[:-1]
            starts, ends, first = runs(letter, off)
            leads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            length = leads[ends] - leads[starts]
            long = length >= least_length
            doc = np.repeat(np.arange(len(off) - 1), np.diff(first))[long]
            starts, ends, length = starts[long], ends[long], length[long]
            extra: list[str] = []
            if typo_every:
                ids = batch.column(0).to_pylist()
                prefix = np.array([0 if i is None else zlib.crc32(f"{i}:".encode()) for i in ids], dtype=np.uint32)
                known = np.array([i is not None for i in ids], dtype=bool)
                h = crc.push(prefix[doc], ends - starts) ^ crc.slices(data, starts, ends)
                typo = (h % np.uint32(typo_every) == 0) & known[doc]
                for k in np.flatnonzero(typo):
                    if length[k] > least_length:
                        word, at = data[starts[k]:ends[k]].tobytes().decode(), int(h[k]) % int(length[k])
                        extra.append(word[:at] + word[at + 1:])
                starts, ends = starts[~typo], ends[~typo]
            size = ends - starts
            to = np.concatenate([[0], np.cumsum(size)])
            body = data[np.repeat(starts - to[:-1], size) + np.arange(to[-1])]
            words = pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(to.astype(np.int64)), pa.py_buffer(body))
            found = pa.concat_arrays([words, pa.array(extra, pa.large_string())]).value_counts()
            return pa.RecordBatch.from_arrays([found.field(0).cast(pa.string()), found.field(1)], names=["word", "n"])
        return step
    rows = docs.select("doc_id", F.col(f"`{text}`").cast("string").alias("text"))
    return map_batches(rows, "word string, n long", start).groupBy("word").agg(F.sum("n").alias("n"))


class Padded:
    """A batch of words as symbols, one byte each, with marks at both ends."""

    def __init__(self, words: pa.Array) -> None:
        raw = [bytes([BEGIN]) + w.encode("latin-1") + bytes([END]) for w in words.to_pylist()]
        self.length = np.fromiter(map(len, raw), np.int64, len(raw))
        self.off = np.concatenate([[0], np.cumsum(self.length)])
        self.symbols = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64)
        self.word = np.repeat(np.arange(len(raw)), self.length)
        self.place = np.arange(len(self.symbols)) - self.off[self.word]
        self.left = self.length[self.word] - self.place

    def grams(self, q: int) -> np.ndarray:
        """Code of the gram of ``q`` symbols at every place (0: none fits)."""
        code = np.zeros(len(self.symbols), dtype=np.uint64)
        for k in range(q):
            code[: len(code) - k] = (code[: len(code) - k] << _U(8)) | self.symbols[k:]
        return np.where(self.left >= q, code | _U(q << 56), _U(0))


def gram_dictionary(words: DataFrame, frequent: int = FREQUENT, limit: int = DICTIONARY) -> np.ndarray:
    """Sorted codes of the frequent grams of fewer than ``Q_MAX`` symbols."""
    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            p = Padded(batch.column(0))
            code, n = np.unique(np.concatenate([p.grams(q) for q in range(Q_MIN, Q_MAX)]), return_counts=True)
            some = code > 0
            return pa.RecordBatch.from_arrays([pa.array(code[some].view(np.int64)), pa.array(n[some])], names=["gram", "n"])
        return step
    total = words.agg(F.coalesce(F.sum(F.length("word") + 1), F.lit(0))).first()[0] * (Q_MAX - Q_MIN)
    least = max(frequent, -(-total // limit))
    got = map_batches(words.select("word"), "gram long, n long", start).groupBy("gram").agg(F.sum("n").alias("n")) \
        .filter(F.col("n") > least).select("gram").toArrow()
    return np.sort(got["gram"].to_numpy().view(np.uint64))


def decompose(p: Padded, dictionary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in the batch, length, code) of the variable grams of all words."""
    length, code = np.full(len(p.symbols), Q_MIN), p.grams(Q_MIN)
    growing = p.left > Q_MIN
    for q in range(Q_MIN, Q_MAX):
        spot = np.minimum(np.searchsorted(dictionary, code), max(len(dictionary) - 1, 0))
        growing &= (dictionary[spot] == code) if len(dictionary) else False
        longer = p.grams(q + 1)
        growing &= longer > 0
        length, code = np.where(growing, q + 1, length), np.where(growing, longer, code)
    able = p.left >= Q_MIN
    end = np.where(able, np.arange(len(length)) + length, 0)
    reach = np.concatenate([[0], np.maximum.accumulate(end)[:-1]])   # ends of earlier grams; words do not overlap
    chosen = np.flatnonzero(able & (end > reach))
    return chosen, length[chosen], code[chosen]


def merged_lists(p: Padded, dictionary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, word, role): the merged lists each word is in. Role 1: one of the
    word's characters is replaced or deleted; role 2: one is inserted."""
    at, length, code = decompose(p, dictionary)
    of, end = p.word[at], at + length
    begin = np.searchsorted(of, np.arange(len(p.length) + 1))
    front = mix(code * _U(3) + mix(p.place[at].astype(np.uint64) + _U(1 << 33)))
    back = mix(code * _U(5) + mix(p.left[at].astype(np.uint64) + _U(1 << 34)))
    front = np.concatenate([[_U(0)], np.cumsum(front, dtype=np.uint64)])
    back = np.concatenate([[_U(0)], np.cumsum(back, dtype=np.uint64)])
    out = []
    for role in (1, 2):
        holes = p.length - 2 if role == 1 else p.length - 1
        word = np.repeat(np.arange(len(holes)), holes)
        e = np.arange(len(word)) - np.repeat(np.cumsum(holes) - holes, holes) + 1
        both = p.length[word] - (1 if role == 1 else 0)          # e + r
        step = 1 + both // FINE
        r = both - e
        e, r = e - e % step, r - r % step
        last = np.searchsorted(at, p.off[word] + e - Q_MAX, side="right")          # starts Q_MAX before the edit
        last = np.maximum(last, begin[word])
        next_ = np.maximum(np.searchsorted(at, p.off[word + 1] - r, side="left"),
                           np.searchsorted(end, p.off[word + 1] - r + Q_MAX, side="left"))
        next_ = np.minimum(next_, begin[word + 1])
        key = mix(front[last] - front[begin[word]] + mix(back[begin[word + 1]] - back[next_] + _U(1)) + both.astype(np.uint64) * _U(0x9E3779B97F4A7C15))
        key_word = np.unique(np.stack([word.astype(np.uint64), key]), axis=1) if len(key) else np.zeros((2, 0), np.uint64)
        out.append((key_word[1], key_word[0].astype(np.int64), np.full(key_word.shape[1], role, np.int32)))
    return tuple(np.concatenate(x) for x in zip(*out))


def _lists(words: DataFrame, dictionary: np.ndarray) -> DataFrame:
    """``key, word, n, role``."""
    grams_b = words.sparkSession.sparkContext.broadcast(dictionary)

    def start():
        dictionary = grams_b.value

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            key, word, role = merged_lists(Padded(batch.column(0)), dictionary)
            rows = pa.array(word)
            return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column(0).take(rows), batch.column(1).take(rows),
                                               pa.array(role)], names=["key", "word", "n", "role"])
        return step
    return map_batches(words.select("word", "n"), "key long, word string, n long, role int", start, 64 << 10)


def near_pairs(words: DataFrame, frequent: int = FREQUENT, most: int = LIST) -> DataFrame:
    """``word, near, near_n``: every near word of every word, once."""
    lists = saved(_lists(words, gram_dictionary(words, frequent)), "gram-lists")
    hot = saved(lists.groupBy("key").count().filter(F.col("count") > most).select("key"), "hot-lists")
    removed = F.transform(F.sequence(F.lit(1), F.length("word")), lambda i: F.concat(
        F.substring("word", F.lit(1), i - 1), F.substring("word", i + 1, F.length("word"))))
    dealt = lists.join(hot, "key", "left_semi").withColumn("rest", F.explode(
        F.when(F.col("role") == 1, F.array_distinct(removed)).otherwise(F.array("word"))))
    every = lists.join(hot, "key", "left_anti").withColumn("rest", F.lit("")).unionByName(dealt)
    a = every.filter("role = 1").select("key", "rest", "word", "n")
    b = every.select("key", "rest", F.col("word").alias("near"), F.col("n").alias("near_n"), "role")
    pairs = a.join(b, ["key", "rest"]).filter(((F.col("role") == 2) | (F.col("word") < F.col("near")))
                                              & (F.levenshtein("word", "near", 1) == 1))
    once = pairs.groupBy("word", "near").agg(F.first("n").alias("n"), F.first("near_n").alias("near_n"))
    sides = F.explode(F.array(F.struct("word", "near", "near_n"),
                              F.struct(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n"))))
    return once.select(sides.alias("s")).select("s.*")


def roots(forms: DataFrame, rounds: int) -> DataFrame:
    """``word, root`` of the words that have a form (``word, form``)."""
    up = forms.select("word", F.col("form").alias("root"))
    for _ in range(rounds):
        further = up.select(F.col("word").alias("root"), F.col("root").alias("further"))
        up = saved(up.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
    return up


def variant_groups(docs: DataFrame, text: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
                   ratio: int = RATIO, typo_every: int = 0) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word that occurs at
    least ``least_count`` times."""
    if least_length < LEAST_LENGTH or ratio < 2:
        raise ValueError(f"words of at least {LEAST_LENGTH} characters and a ratio of at least 2")
    words = saved(word_counts(docs, text, least_length, typo_every).filter(F.col("n") >= least_count), "words")
    best = near_pairs(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    found = words.join(best, "word", "left")
    clear = -F.col("best.less") >= ratio * F.col("n")
    found = saved(found.select("word", F.when(clear, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                               F.when(clear, -F.col("best.less")).alias("form_n")), "forms")
    top = found.agg(F.max("n")).first()[0] or 1
    longest = math.floor(math.log(max(top / max(least_count, 1), 1), ratio)) + 1        # each form is ratio times its word
    up = roots(found.filter("form is not null"), max(1, math.ceil(math.log2(longest + 1))))
    return found.join(up, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
