import random

import numpy as np
import public_tokenizers
import pyarrow as pa
from conftest import WORD
from hypothesis import given, settings
from hypothesis import strategies as st

from salesmart.llm import queries, wordpiece
from salesmart.llm.wordhash import buffers, split_words


def brute(word, pieces):
    data, at, n = b" " + word.encode(), 0, 0
    while at < len(data):
        for k in range(len(data) - at, 0, -1):
            if data[at:at + k] in pieces:
                break
        else:
            return 1
        at, n = at + k, n + 1
    return n


def counts(automaton, words):
    data, off = buffers(pa.array([" ".join(words)]))
    starts, ends, _ = split_words(data, off)
    return automaton.count(data, starts, ends).tolist()


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text("abc ", min_size=1, max_size=4), max_size=12), st.lists(st.text("abcd", min_size=1, max_size=12), min_size=1, max_size=8))
def test_any_vocabulary(vocabulary, words):
    pieces = {v.encode() for v in vocabulary}
    automaton = wordpiece.Automaton.build(sorted(pieces))
    want = [brute(w, pieces) for w in words]
    assert counts(automaton, words) == want
    if len(automaton.edge):
        assert [automaton._one(w.encode()) for w in words] == want


def test_sample_table(spark):
    sf = "/root/testdata/sf0.001"
    pieces = set(wordpiece.vocabulary(public_tokenizers.path("byte_bpe_50k.json")))
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    memo = {}
    for r in queries.QUERIES["op5_word_piece_counts"](spark, sf).collect():
        words = WORD.findall(texts[r["doc_id"]] or "")
        for w in set(words) - memo.keys():
            memo[w] = brute(w, pieces)
        assert (r["n_words"], r["n_pieces"]) == (len(words), sum(memo[w] for w in words))


def test_edges(spark, make_docs, edge_rows):
    pieces = wordpiece.vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    docs = make_docs(edge_rows).withColumnRenamed("source", "n_words")
    out = wordpiece.count_pieces(docs, pieces).collect()
    assert len(out) == len(edge_rows)
    got = {r["doc_id"]: (r["n_words"], r["n_pieces"]) for r in out}
    assert got[1] == got[2] == got[3] == (0, 0) and got[10][0] == 30_000
    known = set(pieces)
    assert got[11] == (1, brute("x" * 5000, known)) and got[12][1] == sum(brute(w, known) for w in WORD.findall(edge_rows[-2][1]))
    assert wordpiece.count_pieces(docs.limit(0), pieces).count() == 0
    assert wordpiece.count_pieces(docs, []).filter("n_pieces <> n_words").count() == 0       # unknown words


def test_long_and_short_words_agree():
    rng = random.Random(1)
    pieces = {b" ", b"a", b"b", b"ab", b"aba", b" ab", b"bb", b"abab"}
    automaton = wordpiece.Automaton.build(sorted(pieces))
    words = ["".join(rng.choice("ab") for _ in range(n)) for n in (1, 255, 256, 257, 900)]
    assert counts(automaton, words) == [brute(w, pieces) for w in words]
    assert counts(automaton, ["a"] * 3) == [2, 2, 2] and np.array(counts(automaton, words)).min() > 0
