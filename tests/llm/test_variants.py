"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from salesmart.llm import variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_counts(rows, every=0):
    n = Counter()
    for i, text in rows:
        for w in RUN.findall(text or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{i}:{w}".encode())
            if every and i is not None and h % every == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 6:
                n[w] += 1
    return n


def brute(rows, every=0):
    n = {w: c for w, c in brute_counts(rows, every).items() if c >= 5}
    near_of = {w: [x for x in n if near(w, x)] for w in n}
    form = {}
    for w, found in near_of.items():
        best = min(found, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near_of[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def edited(rng, w, letters):
    k, c = rng.randrange(len(w)), rng.choice(letters)
    return rng.choice([w[:k] + w[k + 1:], w[:k] + c + w[k:], w[:k] + c + w[k + 1:], w + c, c + w])


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    pieces, letters = ["th", "er", "tion", "ing", "and", "éa", "ou", "re", "s"], "abcdeéßÿ÷×"
    base = list({"".join(rng.choice(pieces) for _ in range(rng.randrange(3, 7))) for _ in range(150)})
    words = base + [edited(rng, w, letters) for w in base for _ in range(3)]
    weight = [rng.choice([2, 12, 40]) for _ in words]
    for w in base[:40]:                     # chains of two forms
        once = edited(rng, w, letters)
        words += [w, once, edited(rng, once, letters)]
        weight += [600, 80, 11]
    out = []
    for i in range(600):
        picked = rng.choices(words, weight, k=60)
        out.append((i, " ".join(w.upper() if rng.random() < 0.1 else w for w in picked) + "."))
    return out


def test_matches_brute_force(spark, make_docs, rows):
    expected = brute(rows, 199)
    assert sum(r[1] is not None for r in expected) > 50
    assert any(r[2] not in (r[0], r[1]) for r in expected)
    assert result(variants.variant_groups(make_docs(rows), typo_every=199)) == expected


def test_typos_and_counts(spark, make_docs, rows):
    got = {r["word"]: r["n"] for r in variants.word_counts(make_docs(rows), typo_every=3).collect()}
    assert got == dict(brute_counts(rows, 3))


@pytest.mark.parametrize("frequent, most", [(0, 256), (50, 3), (10**9, 0)])
def test_no_pair_is_lost(spark, frequent, most):
    """Any dictionary and any split of the lists finds the same pairs."""
    rng = random.Random(4)
    words = {"".join(rng.choice("abc") for _ in range(rng.randrange(6, 10))) for _ in range(500)}
    words |= {w * 30 for w in list(words)[:20]}
    words |= {edited(rng, w, "abcé") for w in list(words)}
    words = sorted(w for w in words if len(w) >= 6)
    table = spark.createDataFrame([(w, k + 5) for k, w in enumerate(words)], "word string, n long")
    got = variants.near_pairs(table, frequent, most).collect()
    assert sorted((r["word"], r["near"]) for r in got) == [(a, b) for a in words for b in words if near(a, b)]
    assert all(words[r["near_n"] - 5] == r["near"] for r in got)


def test_every_edit_leaves_a_common_list():
    rng = random.Random(2)
    some = np.unique(variants.Padded(pa.array(["abcabc", "aabbcc"])).grams(2))
    for dictionary in (np.zeros(0, np.uint64), some[some > 0]):
        for _ in range(200):
            a = "".join(rng.choice("abc") for _ in range(rng.randrange(6, 200)))
            b = edited(rng, a, "abcd")
            if not near(a, b) or len(b) < 6:
                continue
            key, word, role = variants.merged_lists(variants.Padded(pa.array([a, b])), dictionary)
            lists = [{(int(k), int(r)) for k, w, r in zip(key, word, role) if w == i} for i in (0, 1)]
            if len(a) < len(b):
                lists = lists[::-1]
            ones = {k for k, r in lists[0] if r == 1}
            assert any(k in ones and (r == 1 if len(a) == len(b) else r == 2) for k, r in lists[1])


def test_long_words_are_in_few_lists():
    key, _, _ = variants.merged_lists(variants.Padded(pa.array(["abcde" * 2000])), np.zeros(0, np.uint64))
    assert len(key) < 600


def test_edges(spark, make_docs, edge_rows):
    rows = edge_rows + [(20, "MiXeD mixed mixéd " * 6), (None, "mixeds mixeds mixeds mixeds mixeds"), (21, "naïve×naïve÷ œuvres" * 5)]
    assert result(variants.variant_groups(make_docs(rows), typo_every=199)) == brute(rows, 199)
    assert result(variants.variant_groups(make_docs([]))) == []
    docs = make_docs(rows).selectExpr("*", "1 word", "2 n", "3 key", "4 rest")
    assert result(variants.variant_groups(docs)) == brute(rows)
