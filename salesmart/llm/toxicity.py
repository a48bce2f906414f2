"""Toxicity: a counterfactual-regularised word classifier.

A logistic model over the distinct words of a text and their beginnings (one
or at least two distinct words with it). For every labelled
sentence that names an identity group, counterfactual sentences are made by
swapping the term for each other term and for a neutral word; the squared
change of the log odds, over all features the swap adds or takes away, is
penalised, so a group's name alone cannot make a text toxic. An L1 step removes words without evidence, so long texts do not
gather noise.

Empty and NULL texts have no word and get the intercept's probability.
Repeated rows get equal scores; an empty table gives an empty result. With
labels of one class only the score is a constant.
"""

from __future__ import annotations

import array
import re
from collections import Counter
from collections.abc import Callable, Hashable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.llm.common import add_columns, sample_ids

#: Identity terms that are swapped for one another.
IDENTITY_TERMS = (
    "women", "men", "muslims", "christians", "jews", "hindus", "buddhists", "atheists", "gay", "straight", "lesbian",
    "transgender", "black", "white", "asian", "latino", "african", "european", "immigrants", "refugees", "disabled",
    "deaf", "blind", "old", "young", "muslim", "christian", "jewish", "hindu", "buddhist", "woman", "man",
)
#: Bounds of the learning sample: documents per label, characters of a document, words kept.
PER_LABEL, MAX_CHARS, MAX_WORDS = 2500, 20_000, 4096
#: Lengths of the word beginnings; words remembered by a scoring task.
BEGINNINGS, MEMO = (4, 5, 6, 7), 300_000
_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[.!?\n]+")


def word_features(word: str) -> list[str]:
    return [word, *("<" + word[:n] for n in BEGINNINGS if len(word) >= n)]


def features(words: set[str], known: set[str] | None = None) -> set[str]:
    """Features of a text with the distinct ``words``; a feature of at least
    two of them counts again under its name + "+"."""
    once: set[str] = set()
    twice: set[str] = set()
    for w in words:
        for f in word_features(w):
            if known is None or f in known:
                (twice if f in once else once).add(f)
    return once | {f + "+" for f in twice}


class ToxicModel:
    def __init__(self, weights: dict[str, float], bias: float) -> None:
        self.weights, self.bias = weights, bias
        self.base = {f.rstrip("+") for f in weights}

    def score(self, texts) -> np.ndarray:
        w, base = self.weights, self.base
        hit: dict[str, bool] = {}          # word -> has it a feature of the model
        z = []
        for t in texts:
            words = set(_WORD.findall(t.lower())) if t else ()
            some = set()
            for x in words:
                h = hit.get(x)
                if h is None:
                    h = hit[x] = not base.isdisjoint(word_features(x))
                if h:
                    some.add(x)
            z.append(self.bias + sum(sorted(w.get(f, 0.0) for f in features(some, base))))
            if len(hit) > MEMO:
                hit.clear()
        return 1 / (1 + np.exp(-np.clip(np.array(z, dtype=np.float64), -30, 30)))


def counterfactuals(sentences: list[str], terms: tuple[str, ...] = IDENTITY_TERMS,
                    key: Callable[[set[str], str, str], Hashable] = lambda words, t, other: (t, other)) -> Counter:
    """(term, swapped-in term or "") -> number of labelled sentences in which
    the swap is made ("": a neutral word). ``key`` tells which swaps are
    counted as one."""
    found: Counter = Counter()
    known = set(terms)
    for s in sentences:
        words = set(_WORD.findall(s.lower()))
        for t in words & known:
            found[key(words, t, "")] += 1
            for other in terms:
                if other != t and other not in words:
                    found[key(words, t, other)] += 1
    return found


class Swap:
    """Key of ``counterfactuals``: (term, swapped-in term, features lost,
    features gained), features being the numbers of ``at``. They depend on how
    many words of the sentence share a beginning with either term, so a term
    that shares none gives the same key in every sentence."""

    def __init__(self, at: dict[str, int], terms: tuple[str, ...]) -> None:
        self.at = at
        self.own = {t: frozenset(word_features(t)) for t in terms} | {"": frozenset()}
        self.of_terms = frozenset().union(*self.own.values())
        self.near: dict[str, tuple[str, ...]] = {}        # word -> its features that terms have too
        self.words: set[str] | None = None
        self.count: Counter = Counter()                   # of these features in the sentence at hand
        self.state: tuple = ()
        self.keys: dict[tuple, tuple] = {}

    def __call__(self, words: set[str], t: str, other: str) -> tuple:
        if words is not self.words:
            self.words, self.count = words, Counter()
            for w in words:
                near = self.near.get(w)
                if near is None:
                    near = self.near[w] = tuple(f for f in word_features(w) if f in self.of_terms)
                    if len(self.near) > MEMO:
                        self.near.clear()
                self.count.update(near)
            self.state = tuple(sorted((f, min(n, 3)) for f, n in self.count.items()))
        key = self.keys.get((self.state, t, other))
        if key is None:
            if len(self.keys) > MEMO:
                self.keys.clear()
            gone, new = self.own[t], self.own[other]
            lost, gained = [], []
            for f in sorted(gone ^ new):
                before = self.count[f]
                after = before + (f in new) - (f in gone)
                for name, least in ((f, 1), (f + "+", 2)):
                    if name in self.at and (before >= least) != (after >= least):
                        (lost if before >= least else gained).append(self.at[name])
            key = self.keys[self.state, t, other] = (t, other, tuple(lost), tuple(gained))
        return key


def fit(texts: list[str], y: np.ndarray, terms: tuple[str, ...] = IDENTITY_TERMS, max_words: int = MAX_WORDS,
        penalty: float = 1.0, l1: float = 2e-3, steps: int = 400, rate: float = 0.05) -> ToxicModel:
    """Proximal Adam on logistic loss + ``penalty`` x counterfactual changes."""
    if not len(y) or len(set(y.tolist())) < 2:
        p = (float(y.mean()) if len(y) else 0.0)
        return ToxicModel({}, float(np.log((p + 0.01) / (1.01 - p))))
    n1, n0 = int(y.sum()), int(len(y) - y.sum())
    # first pass: in how many texts of either label each feature is; one text's
    # features are held at a time
    index: dict[str, int] = {}
    uses = (array.array("i"), array.array("i"))
    for t, label in zip(texts, y):
        for f in features(set(_WORD.findall(t.lower()))):
            i = index.setdefault(f, len(index))
            if i == len(uses[0]):
                uses[0].append(0)
                uses[1].append(0)
            uses[int(label)][i] += 1
    neg, pos = np.array(uses[0]), np.array(uses[1])
    gap = np.abs(pos / n1 - neg / n0)
    often = pos + neg >= (3 if len(y) >= 300 else 2)
    words = sorted((f for f, i in index.items() if often[i]), key=lambda f: (-gap[index[f]], f))[:max_words]
    del index, uses
    words = words + [t for t in terms if t not in set(words)]
    at = {w: i for i, w in enumerate(words)}
    base = {w.rstrip("+") for w in words}
    x = np.zeros((len(texts), len(words)), np.float32)
    for i, t in enumerate(texts):
        x[i, [at[f] for f in features(set(_WORD.findall(t.lower())), base) if f in at]] = 1
    swaps = counterfactuals([s for t in texts for s in _SENTENCE.split(t)], terms, Swap(at, terms))
    # entry k: the swap row[k] adds sign[k] times the weight col[k] to the change
    entries = [(i, c, sign) for i, (_, _, lost, gained) in enumerate(swaps) for cs, sign in ((lost, 1.0), (gained, -1.0)) for c in cs]
    row, col = (np.array([e[k] for e in entries], dtype=np.int64) for k in (0, 1))
    sign = np.array([e[2] for e in entries])
    pairs: Counter = Counter()
    for (t, other, _, _), n in swaps.items():
        pairs[t, other] += n
    many = np.array(list(swaps.values()), dtype=np.float64) / max(pairs.values(), default=1)
    w, bias = np.zeros(len(words)), float(np.log(n1 / n0))
    m, s2 = np.zeros(len(words) + 1), np.zeros(len(words) + 1)
    weight = np.where(y == 1, len(y) / (2 * n1), len(y) / (2 * n0))
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w.astype(np.float32) + bias, -30, 30)))
        e = (p - y) * weight / len(y)
        g = np.append(x.T @ e.astype(np.float32), e.sum())
        if len(row):
            change = np.bincount(row, sign * w[col], len(many))
            g[:-1] += np.bincount(col, 2 * penalty * sign * (many * change)[row], len(words))
        m, s2 = 0.9 * m + 0.1 * g, 0.999 * s2 + 0.001 * g * g
        move = rate / (np.sqrt(s2 / (1 - 0.999 ** t)) + 1e-4)
        w = w - move[:-1] * m[:-1] / (1 - 0.9 ** t)
        w = np.sign(w) * np.maximum(np.abs(w) - move[:-1] * l1, 0)
        bias -= move[-1] * m[-1] / (1 - 0.9 ** t)
    return ToxicModel({words[i]: float(w[i]) for i in np.flatnonzero(np.abs(w) > 1e-6)}, float(bias))


def train(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> ToxicModel:
    """Learn from at most ``per_label`` labelled documents per label (those
    with the smallest id hash) of at most ``MAX_CHARS`` characters."""
    picked = sample_ids(labels.select("doc_id", F.col("toxic").cast("int").alias("y")).filter("y in (0, 1)")
                        .dropDuplicates(["doc_id"]), "y", per_label)
    rows = (docs.select("doc_id", "text").filter(F.length("text") <= MAX_CHARS)
            .join(F.broadcast(picked), "doc_id").orderBy("doc_id", "text").limit(4 * per_label).collect())
    return fit([r["text"] for r in rows], np.array([r["y"] for r in rows], dtype=np.int64))


def score(docs: DataFrame, model: ToxicModel, text: str = "text") -> DataFrame:
    """``docs`` with ``score``: the probability of toxic label 1."""
    def start():
        return lambda texts: [pa.array(model.score(texts.to_pylist()), pa.float64())]
    return add_columns(docs, text, [T.StructField("score", T.DoubleType())], start)
