"""Language identification: a byte convolutional network over fixed-length windows.

Filters of several widths, max pooling and a softmax, trained in numpy on
labelled texts. A text is cut into fixed-length windows that cover it whole;
its language is the one with the largest sum of window log probabilities,
each weighted by the window's bytes. ``score`` is the softmax of that
weighted mean.

A text that is NULL or has no letter is ``und`` with score 0. Repeated rows
get equal predictions; an empty table gives an empty result. Without any
labelled text every text is ``und``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.llm.bytecnn import ByteCnn, cut_windows, gather, window_logits
from salesmart.llm.common import add_columns, sampled
from salesmart.llm.wordhash import buffers

WINDOW = 128
#: Bounds of the learning sample: documents per language, characters of a
#: document that may be learned from, windows per document.
PER_LANG, MAX_CHARS, MAX_WINDOWS = 500, 20_000, 6
UNKNOWN = "und"


class LanguageModel:
    def __init__(self, cnn: ByteCnn | None, langs: list[str]) -> None:
        self.cnn, self.langs = cnn, langs

    def predict(self, texts) -> tuple[list[str], np.ndarray]:
        n = len(texts)
        letters = np.asarray(pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False)) if n else np.zeros(0, bool)
        if not n or self.cnn is None:
            return [UNKNOWN] * n, np.zeros(n)
        data, off = buffers(texts)
        doc, start, size = cut_windows(data, off, WINDOW, WINDOW)
        z = window_logits(self.cnn, data, start, size).astype(np.float64)
        z -= z.max(axis=1, keepdims=True)
        z -= np.log(np.exp(z).sum(axis=1, keepdims=True))
        first = np.searchsorted(doc, np.arange(n))
        mean = np.add.reduceat(z * size[:, None], first) / np.maximum(np.add.reduceat(size, first), 1)[:, None]
        p = np.exp(mean - mean.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        return ([self.langs[b] if ok else UNKNOWN for b, ok in zip(best, letters)],
                np.where(letters, p[np.arange(n), best], 0.0))


def train(docs: DataFrame, per_lang: int = PER_LANG, epochs: int = 5) -> LanguageModel:
    """Learn from at most ``per_lang`` documents per value of ``lang`` (those
    with the smallest id hash) of at most ``MAX_CHARS`` characters."""
    rows_in = docs.select("doc_id", "lang", "text").filter(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & (F.length("text") <= MAX_CHARS))
    picked, most = sampled(rows_in.select("doc_id", "lang"), "lang", per_lang)
    rows = rows_in.join(F.broadcast(picked.distinct()), ["doc_id", "lang"]).orderBy("doc_id", "lang", "text") \
        .limit(most).collect()
    langs = sorted({r["lang"] for r in rows})
    if not langs:
        return LanguageModel(None, [])
    y = np.array([langs.index(r["lang"]) for r in rows], dtype=np.int64)
    data, off = buffers(pa.array([r["text"] for r in rows], pa.large_string()))
    doc, start, size = cut_windows(data, off, WINDOW, WINDOW)
    pick = np.random.default_rng(5).random(len(doc))
    order = np.lexsort((pick, doc))
    nth = np.arange(len(doc)) - np.searchsorted(doc[order], doc[order])
    keep = np.sort(order[nth < MAX_WINDOWS])
    cnn = ByteCnn(widths=(3, 4, 5), filters=12, dim=6, classes=len(langs), length=WINDOW)
    cnn.fit(gather(data, start[keep], size[keep], WINDOW), y[doc[keep]], epochs=epochs)
    return LanguageModel(cnn, langs)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``."""
    def start():
        def step(texts):
            names, p = model.predict(texts)
            return [pa.array(names, pa.string()), pa.array(p, pa.float64())]
        return step
    return add_columns(docs, text, [T.StructField("lang_pred", T.StringType()),
                                    T.StructField("score", T.DoubleType())], start)
