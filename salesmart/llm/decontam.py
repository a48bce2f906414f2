"""Benchmark decontamination by template windows.

Texts and benchmark items are turned into templates: words are case-folded
and stripped of outer punctuation; numbers, units after a number and names (a
capitalised word inside a sentence) become typed placeholders, their values
are the template's slots; a run of names or of numbers is one placeholder.
Characters of scripts without spaces are words. Every run of ``WINDOW``
template symbols is hashed, and the document's windows are hash-joined with
the items'. An item shorter than the window is one window of its own length.

Each text is read three times: ``TYPED`` as above, ``FOLDED`` without names,
so letter case does not matter, and ``EXACT``, every word by its folded form
alone. The first two leave out windows of which less than half are plain
words (two at least) and items of fewer than ``LEAST`` words; ``EXACT`` leaves out nothing, so
number- and name-heavy passages and items of one word up are found if copied.

Windows of one document, item and reading that lie on one diagonal (document
position minus item position), or on diagonals at most ``GAP`` apart (words
put in, left out or split), are one alignment. Equal item values (numbers and
names; units are not compared) should meet equal document values; slots that
differ from their item value's most frequent document value are torn and do
not count as matched. An alignment with more torn slots than one and than
``TORN`` of its slots is dropped; where that befalls all ``TYPED`` alignments
of a document and item, the other readings do not count either. What remains
is a leak if it covers at least ``MIN_WORDS`` words, or ``SHARE`` of a
shorter item: ``verbatim`` if all slot values are equal, else
``re-parameterised``.

A bit table of the items' windows, of bounded size, keeps other windows from
leaving the scan; the join itself is exact. The items' windows are broadcast
up to ``BROADCAST_WINDOWS`` rows and shuffled beyond.

NULL and empty texts match nothing. A NULL ``doc_id`` or ``item_id`` is kept
as it is. Repeated documents or items count once per id. Empty tables give an
empty result. Texts are read whole.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.llm.bittable import bit_table, in_table
from salesmart.llm.common import map_batches, saved
from salesmart.llm.wordhash import Hasher, buffers, mix, split_words

WINDOW, LEAST, MIN_WORDS, SHARE, TORN = 8, 4, 12, 0.8, 0.25
BROADCAST_WINDOWS = 200_000
#: Bytes of text read at once: the three readings hold about 35 bytes for each.
READ_BYTES = 512 << 10
#: Units that become placeholders after a number.
UNITS = ("kg", "g", "mg", "lb", "lbs", "oz", "km", "m", "cm", "mm", "mi", "mile", "miles", "ft", "feet", "foot", "inch",
         "inches", "yard", "yards", "metre", "metres", "meter", "meters", "kilometre", "kilometres", "kilometer",
         "kilometers", "gram", "grams", "kilogram", "kilograms", "pound", "pounds", "ounce", "ounces", "litre", "litres",
         "liter", "liters", "l", "ml", "gallon", "gallons", "second", "seconds", "minute", "minutes", "hour", "hours",
         "day", "days", "week", "weeks", "month", "months", "year", "years", "dollar", "dollars", "euro", "euros",
         "cent", "cents", "usd", "eur", "percent", "kmh", "mph", "degrees")
P = np.uint64(0x9E3779B97F4A7C15)
NUMBER, NAME, UNIT = (np.uint64(x) for x in (0x6E756D, 0x6E616D65, 0x756E6974))

#: The readings of a text: typed names and numbers; typed numbers; exact words.
TYPED, FOLDED, EXACT = 0, 1, 2
#: Diagonals that far apart are one alignment (twice this: a band's width).
GAP = 8
_UNSPACED = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])")

WINDOWS = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("reading", T.IntegerType()), T.StructField("pos", T.IntegerType()),
    T.StructField("word", T.IntegerType()), T.StructField("size", T.IntegerType()), T.StructField("words", T.IntegerType()),
    T.StructField("hash", T.LongType()), T.StructField("slots", T.ArrayType(T.LongType())),
    T.StructField("spans", T.ArrayType(T.IntegerType())),
])


class Reading(NamedTuple):
    """Symbols of a batch of texts; a run of names or numbers may be one symbol."""
    symbol: np.ndarray
    value: np.ndarray      # the words' hash (of a run: of its words in order)
    slot: np.ndarray       # 0 for a plain word
    span: np.ndarray       # words of the symbol
    first: np.ndarray      # first symbol of each text


def char_bytes(head: np.ndarray) -> np.ndarray:
    return 1 + (head >= 0xC0).astype(np.int64) + (head >= 0xE0) + (head >= 0xF0)


def folded(texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """The texts, characters of scripts without spaces set apart, and their
    case-folded form, which has the same white space."""
    data, _ = buffers(texts)
    if not len(data) or data.max() < 0x80:
        return texts, pc.ascii_lower(texts)
    own = [t or "" for t in texts.to_pylist()]
    if data.max() >= 0xE0:
        own = [t if t.isascii() else _UNSPACED.sub(r" \1 ", t) for t in own]
    return pa.array(own, pa.large_string()), pa.array([t.casefold() for t in own], pa.large_string())


def collapsed(symbol, value, slot, first, run) -> Reading:
    """Neighbouring words of one text that are equal symbols and in ``run`` become one."""
    keep = np.ones(len(symbol), dtype=bool)
    if len(symbol):
        keep[1:] = ~(run[1:] & run[:-1] & (symbol[1:] == symbol[:-1]))
        keep[first[:-1][first[:-1] < len(symbol)]] = True
    at = np.flatnonzero(keep)
    group = np.cumsum(keep) - 1
    if len(at) < len(symbol):
        rank = np.arange(len(symbol)) - at[group]
        value = np.add.reduceat(value * np.power(P, rank.astype(np.uint64)), at)
        slot = np.where(run[at], value | np.uint64(1), slot[at])
    return Reading(symbol[at], value, slot, np.diff(np.append(at, len(symbol))), np.searchsorted(at, first))


class Templates:
    """Template words of a batch of texts."""

    def __init__(self) -> None:
        self.hash = Hasher()
        self.punct = np.zeros(256, dtype=bool)
        for lo, hi in ((33, 48), (58, 65), (91, 97), (123, 127)):
            self.punct[lo:hi] = True
        units = [u.encode() for u in UNITS]
        off = np.cumsum([0, *[len(u) for u in units]])
        flat = np.frombuffer(b"".join(units), dtype=np.uint8)
        self.units = np.sort(self.hash.words(flat, off[:-1], off[1:]))

    def __call__(self, texts) -> list[Reading]:
        """TYPED, FOLDED and EXACT readings of the texts."""
        texts, lower = folded(texts)
        data, off = buffers(texts)
        low, low_off = buffers(lower)
        starts, ends, first = split_words(data, off)
        low_starts, low_ends, _ = split_words(low, low_off)
        doc_first = np.zeros(len(starts) + 1, dtype=bool)
        doc_first[first] = True
        last_byte = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
        # a sentence begins at the text's start, after . ! ? : and on a new line
        opens = doc_first[:-1].copy()
        opens[1:] |= np.isin(last_byte[:-1], np.frombuffer(b".!?:", np.uint8))
        lines = np.flatnonzero(data == 10)
        if len(starts) > 1:
            opens[1:] |= np.searchsorted(lines, starts[1:]) > np.searchsorted(lines, ends[:-1])
        a, b = starts.copy(), ends.copy()
        go = np.arange(len(a))
        while len(go):
            go = go[a[go] < b[go]]
            go = go[self.punct[data[a[go]]]]
            a[go] += 1
        go = np.arange(len(a))
        while len(go):
            go = go[a[go] < b[go]]
            go = go[self.punct[data[b[go] - 1]]]
            b[go] -= 1
        full = np.flatnonzero(a < b)
        first = np.searchsorted(full, first)
        # outer punctuation is ASCII, which folding leaves alone
        c, d = (low_starts + (a - starts))[full], (low_ends - (ends - b))[full]
        a, b, opens = a[full], b[full], opens[full]
        value = self.hash.words(low, c, d)
        if not len(a):
            none = np.zeros(0, np.uint64)
            return [Reading(none, none, none, np.zeros(0, np.int64), first)] * 3

        def differ(i, j):
            """Is the character at i another one than the folded text's at j?"""
            i, j = np.minimum(i, len(data) - 1), np.minimum(j, len(low) - 1)
            out, n = np.zeros(len(i), dtype=bool), char_bytes(data[i])
            for k in range(4):
                out |= (k < n) & (data[np.minimum(i + k, len(data) - 1)] != low[np.minimum(j + k, len(low) - 1)])
            return out
        number = (data[a] >= 48) & (data[a] <= 57)
        wide = char_bytes(data[a])
        name = differ(a, c) & (b - a > wide) & ~differ(a + wide, c + char_bytes(low[c])) & ~opens & ~number
        unit = np.zeros(len(a), dtype=bool)
        unit[1:] = number[:-1]
        unit[first[:-1][first[:-1] < len(a)]] = False
        unit &= self.units[np.minimum(np.searchsorted(self.units, value), len(self.units) - 1)] == value
        # odd: compared for consistency; even: a unit
        odd, even = value | np.uint64(1), (value | np.uint64(3)) - np.uint64(1)
        typed = np.where(number, NUMBER, np.where(unit, UNIT, value))
        slot = np.where(number, odd, np.where(unit, even, np.uint64(0)))
        one = np.ones(len(a), dtype=np.int64)
        return [collapsed(np.where(name, NAME, typed), value, np.where(name, odd, slot), first, name | number),
                collapsed(typed, value, slot, first, number),
                Reading(value, value, np.where(name, odd, slot), one, first)]


def template_windows(readings: list[Reading], ids, sizes: dict[int, list[int]], whole: bool, keep=None) -> pa.RecordBatch:
    """Rows of WINDOWS. ``whole``: texts are items; one shorter than the
    window is taken as one window. ``keep``: which hashes to return."""
    cols: list[list[np.ndarray]] = [[] for _ in range(7)]
    slots: list[np.ndarray] = []
    spans: list[np.ndarray] = []
    for reading, r in enumerate(readings):
        symbol, first = r.symbol, r.first
        count = np.diff(first)
        before = np.concatenate([[0], np.cumsum(r.span)])
        words = before[first[1:]] - before[first[:-1]]
        plain = np.concatenate([[0], np.cumsum(r.slot == 0)])
        for size in sizes.get(reading, ()):
            h = sums(symbol, size)
            n = np.maximum(count - size + 1, 0)
            if whole and size < WINDOW:
                n = np.where((count == size) & ((words >= LEAST) | (reading == EXACT)), 1, 0)
            doc = np.repeat(np.arange(len(n)), n)
            at = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n) + first[:-1][doc]
            salt = np.uint64(size + 16 * reading)
            many = plain[at + size] - plain[at]
            options = [(h[at] if len(at) else h[:0], many, np.ones(len(at), dtype=bool), False)]
            if reading == TYPED and not whole and len(at):
                # an item's first word is plain, whatever precedes it in the document
                options.append((h[at] + (r.value[at] - NAME) * np.power(P, np.uint64(size - 1)), many + 1,
                                (symbol[at] == NAME) & (r.span[at] == 1), True))
            for code, share, ok, bare in options:
                value = mix(code + salt)
                if reading != EXACT:
                    ok = ok & (2 * share >= max(size, LEAST))
                if keep is not None:
                    ok = ok & keep(value)
                d, i = doc[ok], at[ok]
                for col, x in zip(cols, (d, np.full(len(d), reading), i - first[:-1][d], before[i] - before[first[:-1][d]],
                                         np.full(len(d), size), words[d], value[ok].view(np.int64))):
                    col.append(x)
                for k in i.tolist():
                    own = r.slot[k:k + size].view(np.int64)
                    if bare:
                        own = own.copy()
                        own[0] = 0
                    slots.append(own)
                    spans.append(r.span[k:k + size])
    doc, reading, pos, word, size, words, value = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in cols)
    offsets = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
    flat, wide = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (slots, spans))
    return pa.RecordBatch.from_arrays(
        [ids.take(pa.array(doc)), *[pa.array(x, pa.int32()) for x in (reading, pos, word, size, words)], pa.array(value, pa.int64()),
         pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int64())),
         pa.ListArray.from_arrays(offsets, pa.array(wide, pa.int32()))], names=WINDOWS.fieldNames())


def sums(h: np.ndarray, n: int) -> np.ndarray:
    """Polynomial of every run of ``n`` symbols, not mixed."""
    acc = np.zeros(max(len(h) - n + 1, 0), dtype=np.uint64)
    for j in range(n if len(acc) else 0):
        acc *= P
        acc += h[j: len(h) - n + 1 + j]
    return acc


def item_windows(items: DataFrame) -> DataFrame:
    sizes = {TYPED: list(range(2, WINDOW + 1)), FOLDED: list(range(2, WINDOW + 1)), EXACT: list(range(1, WINDOW + 1))}

    def start():
        templates = Templates()
        return lambda batch: template_windows(templates(batch.column(1)), batch.column(0), sizes, True)
    own = items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).distinct()
    return map_batches(own, WINDOWS, start, READ_BYTES)


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document and item it leaks: ``doc_id, item_id, position``
    (template word), ``matched_words, item_words, n_slots, changed_slots, kind``."""
    theirs = saved(item_windows(items), "items")
    n = theirs.count()
    sizes: dict[int, list[int]] = {}
    for r in theirs.select("reading", "size").distinct().orderBy("reading", "size").collect():
        sizes.setdefault(r["reading"], []).append(r["size"])
    table = docs.sparkSession.sparkContext.broadcast(bit_table(theirs, "hash", n))

    def start():
        bits, templates = table.value, Templates()
        return lambda batch: template_windows(templates(batch.column(1)), batch.column(0), sizes, False, lambda v: in_table(bits, v))
    ours = map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), WINDOWS, start, READ_BYTES)
    item = theirs.select(F.col("id").alias("item_id"), "reading", F.col("pos").alias("item_pos"), "size", "hash",
                         F.col("words").alias("item_words"), F.col("slots").alias("item_slots"), "spans")
    met = ours.select(F.col("id").alias("doc_id"), "reading", "pos", "word", "size", "hash", "slots").join(
        F.broadcast(item) if n <= BROADCAST_WINDOWS else item, ["hash", "reading", "size"])
    # a match counts for its diagonal and for two bands, which overlap by half
    shift = F.col("pos") - F.col("item_pos")
    bands = F.explode(F.array(*[F.struct(F.lit(k).alias("band"), x.cast("long").alias("diagonal")) for k, x in enumerate(
        (shift, F.floor(shift / (2 * GAP)), F.floor((shift + GAP) / (2 * GAP))))]))
    met = met.select("*", bands.alias("_b")).select("*", "_b.band", "_b.diagonal")
    one = ["doc_id", "item_id", "reading", "band", "diagonal"]
    places = F.explode(F.arrays_zip(F.sequence("item_pos", F.col("item_pos") + F.col("size") - 1).alias("at"),
                                    F.col("item_slots").alias("theirs"), F.col("slots").alias("ours"), F.col("spans").alias("span")))
    words = met.select(*one, "item_words", "word", places.alias("w")).groupBy(*one, "w.at").agg(
        F.max("item_words").alias("item_words"), F.max("w.theirs").alias("theirs"), F.max("w.span").alias("span"),
        F.min("word").alias("word"), F.max(F.struct(F.col("w.theirs") == F.col("w.ours"), F.col("w.ours").alias("ours"))).alias("_best")) \
        .withColumn("ours", F.col("_best.ours"))
    # written once: both counts below read it, and the texts are scanned for it
    words = saved(words.drop("_best"), "aligned")
    size = words.groupBy(*one).agg(F.sum("span").alias("matched_words"), F.max("item_words").alias("item_words"),
                                   F.min("word").alias("_at"), F.sum((F.col("theirs") != 0).cast("int")).alias("n_slots"),
                                   F.sum((F.col("theirs") != F.col("ours")).cast("int")).alias("changed_slots"))
    # an item value's slots that do not meet its most frequent document value
    slots = words.filter("theirs <> 0 and theirs & 1 = 1").groupBy(*one, "theirs", "ours").agg(F.count(F.lit(1)).alias("n")) \
        .groupBy(*one, "theirs").agg(F.sum("n").alias("n"), (F.sum("n") - F.max("n")).alias("torn")) \
        .groupBy(*one).agg(F.sum("n").alias("_slots"), F.sum("torn").alias("_torn")) \
        .select(*[F.col(c).alias(f"_{c}") for c in one], "_slots", "_torn")
    same = [size[c].eqNullSafe(slots[f"_{c}"]) for c in one]
    enough = F.col("matched_words") >= F.least(F.lit(MIN_WORDS), F.ceil(F.col("item_words") * SHARE))
    judged = size.join(slots, same, "left") \
        .withColumn("matched_words", F.col("matched_words") - F.coalesce("_torn", F.lit(0))).filter(enough) \
        .withColumn("_good", F.coalesce(F.col("_torn") <= F.greatest(F.lit(1), F.col("_slots") * TORN), F.lit(True)))
    # where the typed reading aligns and is torn only, the others do not count
    typed, good = F.col("reading") == TYPED, F.col("_good")
    rank = F.struct("matched_words", (-F.col("changed_slots")).alias("_less"), (-F.col("reading")).alias("_reading"),
                    (-F.col("_at")).alias("_early"), "item_words", "n_slots", "changed_slots")
    best = judged.groupBy("doc_id", "item_id").agg(
        F.max(F.when(good, rank)).alias("b"), F.bool_or(typed).alias("_typed"), F.bool_or(typed & good).alias("_held")) \
        .filter("b is not null and (_held or not _typed)")
    return best.select("doc_id", "item_id", (-F.col("b._early")).alias("position"), "b.matched_words", "b.item_words",
                       "b.n_slots", "b.changed_slots",
                       F.when(F.col("b.changed_slots") == 0, "verbatim").otherwise("re-parameterised").alias("kind"))
