"""Quality classifier: a byte-level convolutional network over overlapping chunks.

Every text is cut into overlapping chunks that cover it whole. The network's
learned filters slide over each chunk, are max-pooled and give the chunk's
log odds; the document's probability is a logistic function of the mean, the
largest and the smallest chunk log odds, fitted on the learning documents.

Empty and NULL texts have one empty chunk, so they get a score like any other
text. Repeated rows get equal scores. An empty table gives an empty result.
With no labelled row of one of the classes the network keeps its untrained
weights and the score is that of a constant.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.llm.bytecnn import ByteCnn, cut_windows, gather, window_logits
from salesmart.llm.common import add_columns, sample_ids
from salesmart.llm.wordhash import buffers

CHUNK, OVERLAP = 256, 32
#: Bounds of the learning sample: documents per label, characters of a document
#: that may be learned from, chunks per document.
PER_LABEL, MAX_CHARS, MAX_CHUNKS = 1500, 20_000, 4


class QualityModel:
    def __init__(self, cnn: ByteCnn, combine: np.ndarray) -> None:
        self.cnn, self.combine = cnn, combine

    def features(self, texts) -> np.ndarray:
        """Mean, largest and smallest chunk log odds and 1, per text."""
        data, off = buffers(texts)
        n = len(off) - 1
        if not n:
            return np.zeros((0, 4))
        doc, start, size = cut_windows(data, off, CHUNK, CHUNK - OVERLAP)
        z = window_logits(self.cnn, data, start, size).astype(np.float64)
        odds = z[:, 1] - z[:, 0]
        first = np.searchsorted(doc, np.arange(n))
        count = np.diff(np.append(first, len(doc)))
        return np.stack([np.add.reduceat(odds * size, first) / np.maximum(np.add.reduceat(size, first), 1)
                         + np.where(np.add.reduceat(size, first) == 0, odds[first], 0),
                         np.maximum.reduceat(odds, first), np.minimum.reduceat(odds, first), np.ones(n)], axis=1) \
            * (count > 0)[:, None]

    def score(self, texts) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.features(texts) @ self.combine, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 400, rate: float = 0.05, ridge: float = 1e-3) -> np.ndarray:
    w = np.array([1.0, 0.0, 0.0, 0.0])
    m, s = np.zeros(4), np.zeros(4)
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) / max(1, len(y)) + ridge * w
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(s / (1 - 0.999 ** t)) + 1e-8)
    return w


def train(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, epochs: int = 6) -> QualityModel:
    """Learn from at most ``per_label`` labelled documents per label (those
    with the smallest id hash) of at most ``MAX_CHARS`` characters."""
    picked = sample_ids(labels.select("doc_id", F.col("quality").cast("int").alias("y")).filter("y in (0, 1)")
                        .dropDuplicates(["doc_id"]), "y", per_label)
    rows = (docs.select("doc_id", "text").filter(F.length("text") <= MAX_CHARS)
            .join(F.broadcast(picked), "doc_id").orderBy("doc_id", "text").limit(4 * per_label).collect())
    data, off = buffers(pa.array([r["text"] for r in rows], pa.large_string()))
    y = np.array([r["y"] for r in rows], dtype=np.int64)
    cnn = ByteCnn(widths=(8,), filters=24, dim=6, classes=2, length=CHUNK, stride=2)
    if len(set(y.tolist())) < 2:
        return QualityModel(cnn, np.array([0.0, 0.0, 0.0, 0.0]))
    doc, start, size = cut_windows(data, off, CHUNK, CHUNK - OVERLAP)
    rng = np.random.default_rng(3)
    pick = rng.random(len(doc))
    order = np.lexsort((pick, doc))
    nth = np.arange(len(doc)) - np.searchsorted(doc[order], doc[order])
    keep = np.sort(order[nth < MAX_CHUNKS])
    cnn.fit(gather(data, start[keep], size[keep], CHUNK), y[doc[keep]], epochs=epochs)
    model = QualityModel(cnn, np.zeros(4))
    x = model.features(pa.array([r["text"] for r in rows], pa.large_string()))
    model.combine = _logistic(x, y)
    return model


def score(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """``docs`` with ``score``: the probability of quality label 1."""
    def start():
        return lambda texts: [pa.array(model.score(texts), pa.float64())]
    return add_columns(docs, text, [T.StructField("score", T.DoubleType())], start)
