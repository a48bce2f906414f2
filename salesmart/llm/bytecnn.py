"""A byte-level convolutional network in numpy.

Bytes are embedded, filters of one or more widths slide over a fixed-length
window, each filter's largest response over the window is kept (max pooling,
ReLU) and a linear layer gives the class scores. Training is Adam on softmax
cross entropy, with gradients through the winning positions only.
"""

from __future__ import annotations

import numpy as np

PAD = 0


class ByteCnn:
    def __init__(self, widths: tuple[int, ...], filters: int, dim: int, classes: int, length: int,
                 stride: int = 1, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.dim, self.length, self.stride, self.wide = dim, length, stride, max(widths)
        n = filters * len(widths)
        k = self.wide * dim
        self.p = {
            "emb": rng.normal(0, 0.5, (256, dim)).astype(np.float32),
            "w": rng.normal(0, 1.0 / np.sqrt(k), (k, n)).astype(np.float32),
            "b": np.zeros(n, np.float32),
            "v": rng.normal(0, 1.0 / np.sqrt(n), (n, classes)).astype(np.float32),
            "c": np.zeros(classes, np.float32),
        }
        self.mask = np.zeros((k, n), np.float32)    # narrower filters see their first bytes only
        for i, w in enumerate(widths):
            self.mask[: w * dim, i * filters:(i + 1) * filters] = 1
        self.p["w"] *= self.mask

    def _patches(self, x: np.ndarray) -> np.ndarray:
        e = self.p["emb"][x]
        n = len(x)
        pos = (self.length - self.wide) // self.stride + 1
        s = e.strides
        view = np.lib.stride_tricks.as_strided(e, (n, pos, self.wide * self.dim),
                                               (s[0], s[1] * self.stride, s[2]), writeable=False)
        return view.reshape(n * pos, -1)

    def _pool(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a = self._patches(x)
        z = a @ self.p["w"]
        return a, z.reshape(len(x), -1, z.shape[1])

    def logits(self, x: np.ndarray) -> np.ndarray:
        """Class scores of windows ``x`` (n, length) of bytes."""
        out = np.empty((len(x), len(self.p["c"])), np.float32)
        block = max(1, (1 << 20) // (self.length * self.p["w"].shape[1]))
        for i in range(0, len(x), block):
            _, z = self._pool(x[i:i + block])
            h = np.maximum(z.max(axis=1) + self.p["b"], 0)
            out[i:i + block] = h @ self.p["v"] + self.p["c"]
        return out

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int, batch: int = 64, rate: float = 3e-3,
            decay: float = 1e-4, seed: int = 11) -> "ByteCnn":
        if not len(x):
            return self
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        t = 0
        classes = len(self.p["c"])
        weight = len(y) / np.maximum(np.bincount(y, minlength=classes), 1) / classes
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for i in range(0, len(x), batch):
                xb, yb = x[order[i:i + batch]], y[order[i:i + batch]]
                n = len(xb)
                a, z = self._pool(xb)
                win = z.argmax(axis=1)                                   # n, filters
                top = np.take_along_axis(z, win[:, None, :], axis=1)[:, 0] + self.p["b"]
                h = np.maximum(top, 0)
                o = h @ self.p["v"] + self.p["c"]
                o -= o.max(axis=1, keepdims=True)
                q = np.exp(o)
                q /= q.sum(axis=1, keepdims=True)
                q[np.arange(n), yb] -= 1
                q *= (weight[yb] / n)[:, None].astype(np.float32)
                dh = (q @ self.p["v"].T) * (top > 0)
                pos = z.shape[1]
                patch = a.reshape(n, pos, -1)[np.arange(n)[:, None], win]     # n, filters, k
                g = {"v": h.T @ q, "c": q.sum(axis=0), "b": dh.sum(axis=0),
                     "w": np.einsum("nf,nfk->kf", dh, patch) * self.mask}
                demb = np.zeros_like(self.p["emb"])
                back = (dh[:, :, None] * self.p["w"].T[None]).reshape(n, -1, self.wide, self.dim)
                where = win[:, :, None] * self.stride + np.arange(self.wide)
                np.add.at(demb, xb[np.arange(n)[:, None, None], where], back)
                g["emb"] = demb
                t += 1
                for k, v in self.p.items():
                    gk = g[k] + decay * v
                    m[k] = 0.9 * m[k] + 0.1 * gk
                    s[k] = 0.999 * s[k] + 0.001 * gk * gk
                    v -= (rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(s[k] / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)
        return self


def cut_windows(data: np.ndarray, off: np.ndarray, length: int, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, size) of windows of ``length`` bytes every ``step``
    bytes that together cover every document; a document without bytes gets
    one empty window."""
    size = np.diff(off)
    count = np.maximum(1, -(-np.maximum(size - (length - step), 1) // step))
    doc = np.repeat(np.arange(len(size)), count)
    start = (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * step
    return doc, start + off[doc], np.clip(size[doc] - start, 0, length)


def gather(data: np.ndarray, start: np.ndarray, size: np.ndarray, length: int) -> np.ndarray:
    """The windows as rows of bytes, padded with ``PAD``."""
    lane = np.arange(length)
    if not len(data):
        return np.full((len(start), length), PAD, np.uint8)
    at = np.minimum(start[:, None] + lane, len(data) - 1)
    return np.where(lane < size[:, None], data[at], np.uint8(PAD))


def window_logits(model: ByteCnn, data: np.ndarray, start: np.ndarray, size: np.ndarray, block: int = 4096) -> np.ndarray:
    """Scores of all windows, gathered block by block."""
    out = [model.logits(gather(data, start[i:i + block], size[i:i + block], model.length))
           for i in range(0, len(start), block)]
    return np.concatenate(out) if out else np.zeros((0, len(model.p["c"])), np.float32)
