"""Word-piece counts by a linear longest-match automaton.

Greedy longest-match-first word pieces are counted without building a piece.
The vocabulary is a byte trie. Every node has a failure link, the node that
is reached once the longest pieces are popped off its string, and the number
of pieces popped on the way; both are computed once, breadth first. Reading a
word then takes a bounded number of steps per byte on average, however its
pieces overlap: follow the byte if the node has such a child, else add the
popped count and follow the failure link.

A word (bytes between white space) is read with one space before it, so its
first piece is one that begins a word and the others are inner pieces. Each
distinct word of a batch is read once; all are read in step. A word with a
byte sequence that no pieces cover counts as one unknown piece.

NULL and empty texts have no words and no pieces. Repeated rows get equal
counts; an empty table gives an empty result.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from salesmart.llm.common import add_columns
from salesmart.llm.packing import byte_letters
from salesmart.llm.wordhash import Hasher, buffers, split_words

#: Words longer than this are read one by one.
LONG = 256
NO_NODE = -1


def vocabulary(path: str) -> list[bytes]:
    """Pieces of a byte-level tokenizers JSON file, special tokens left out."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters = byte_letters()
    special = {t["content"] for t in spec.get("added_tokens", ())}
    return [bytes(letters[c] for c in w) for w in spec["model"]["vocab"] if w not in special]


class Automaton:
    """Trie, failure links and popped counts as arrays; node 0 is the root."""

    def __init__(self, edge: np.ndarray, to: np.ndarray, fail: np.ndarray, pops: np.ndarray) -> None:
        self.edge, self.to, self.fail, self.pops = edge, to, fail, pops

    @classmethod
    def build(cls, pieces: list[bytes]) -> "Automaton":
        child: list[dict[int, int]] = [{}]
        final = [False]
        for piece in pieces:
            node = 0
            for b in piece:
                nxt = child[node].get(b)
                if nxt is None:
                    nxt = child[node][b] = len(child)
                    child.append({})
                    final.append(False)
                node = nxt
            final[node] = final[node] or node > 0
        fail, pops = [NO_NODE] * len(child), [0] * len(child)
        queue = [0]
        for u in queue:
            for b, v in child[u].items():
                queue.append(v)
                if final[v]:
                    fail[v], pops[v] = 0, 1
                    continue
                z, n = fail[u], pops[u]
                while z != NO_NODE and b not in child[z]:
                    n += pops[z]
                    z = fail[z]
                if z != NO_NODE:
                    fail[v], pops[v] = child[z][b], n
        edges = sorted(((u << 8) | b, v) for u, kids in enumerate(child) for b, v in kids.items())
        return cls(*(np.array(x, dtype=np.int64) for x in ([e for e, _ in edges], [v for _, v in edges], fail, pops)))

    def child(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        want = (node << 8) | byte
        at = np.minimum(np.searchsorted(self.edge, want), len(self.edge) - 1)
        return np.where(self.edge[at] == want, self.to[at], NO_NODE)

    def count(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Pieces of each word ``data[starts[i]:ends[i]]``, a space before it."""
        out = np.zeros(len(starts), dtype=np.int64)
        if not len(self.edge):
            return out + 1
        size = ends - starts
        for i in np.flatnonzero(size > LONG):
            out[i] = self._one(data[starts[i]:ends[i]].tobytes())
        order = np.flatnonzero(size <= LONG)
        order = order[np.argsort(-size[order], kind="stable")]      # those still being read come first
        node = np.zeros(len(order), dtype=np.int64)
        got = np.zeros(len(order), dtype=np.int64)
        dead = np.zeros(len(order), dtype=bool)
        length = size[order]
        for step in range(-1, int(length.max(initial=0))):
            live = np.flatnonzero(~dead[: int(np.searchsorted(-length, -step, side="left"))])
            byte = np.full(len(live), 32) if step < 0 else data[starts[order[live]] + step].astype(np.int64)
            while len(live):
                nxt = self.child(node[live], byte)
                ok = nxt != NO_NODE
                node[live[ok]] = nxt[ok]
                live, byte = live[~ok], byte[~ok]
                got[live] += self.pops[node[live]]
                node[live] = self.fail[node[live]]
                stuck = node[live] == NO_NODE
                dead[live[stuck]] = True
                live, byte = live[~stuck], byte[~stuck]
        live = np.flatnonzero(~dead & (node != 0))
        while len(live):
            got[live] += self.pops[node[live]]
            node[live] = self.fail[node[live]]
            dead[live[node[live] == NO_NODE]] = True
            live = live[node[live] > 0]
        out[order] = np.where(dead, 1, got)
        return out

    def _one(self, word: bytes) -> int:
        if not hasattr(self, "_links"):
            self._links = dict(zip(self.edge.tolist(), self.to.tolist()))
        links, fail, pops = self._links, self.fail.tolist(), self.pops.tolist()
        node = got = 0
        for b in b" " + word:
            while True:
                nxt = links.get((node << 8) | b)
                if nxt is not None:
                    node = nxt
                    break
                got += pops[node]
                node = fail[node]
                if node == NO_NODE:
                    return 1
        while node > 0:
            got += pops[node]
            node = fail[node]
        return 1 if node == NO_NODE else got


def count_pieces(docs: DataFrame, pieces: list[bytes], text: str = "text") -> DataFrame:
    """``docs`` with ``n_words`` and ``n_pieces``. The automaton's size is the
    vocabulary's; it is built once and broadcast."""
    built = Automaton.build(pieces)
    shared = docs.sparkSession.sparkContext.broadcast((built.edge, built.to, built.fail, built.pops))

    def start():
        automaton, hasher = Automaton(*shared.value), Hasher()

        def step(texts):
            data, off = buffers(texts)
            starts, ends, first = split_words(data, off)
            _, lead, back = np.unique(hasher.words(data, starts, ends), return_index=True, return_inverse=True)
            total = np.concatenate([[0], np.cumsum(automaton.count(data, starts[lead], ends[lead])[back])])
            return [pa.array(np.diff(first).astype(np.int64)), pa.array(total[first[1:]] - total[first[:-1]])]
        return step
    return add_columns(docs, text, [T.StructField("n_words", T.LongType()), T.StructField("n_pieces", T.LongType())], start)
