import random
from collections import defaultdict

import numpy as np
import pytest
from conftest import WORD, prose

from salesmart.llm import neardup
from salesmart.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows, percent):
    sets = {}
    for i, t in rows:
        sets.setdefault(i, []).append(shingles(t))
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    by = defaultdict(list)
    for i, many in sets.items():
        for s in many:
            for x in s:
                by[x].append(i)
    seen = {(a, b) for ids in by.values() for a in ids for b in ids if a < b}
    for a, b in seen:
        for x in sets[a]:
            for y in sets[b]:
                n = len(x & y)
                if n and 100 * n >= percent * (len(x) + len(y) - n):
                    p, q = find(a), find(b)
                    parent[max(p, q)] = min(p, q)
    return {i: (max(map(len, sets[i])), find(i)) for i in sets}


def check(spark, docs, rows, percent):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(docs, percent).collect()
           if r["doc_id"] is not None}
    assert got == brute([r for r in rows if r[0] is not None], percent)
    return got


def family(rng, base, copies, edits, first):
    out = []
    for i in range(copies):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10 ** 9)}"
        out.append((first + i, " ".join(w)))
    return out


def test_families_against_brute_force(spark, make_docs, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 16)          # many blocks per key
    rng = random.Random(3)
    rows = []
    for f in range(6):
        rows += family(rng, prose(rng, 120), 40, 6, 1000 * f)
    rows += [(10_000 + i, " ".join(prose(rng, 60))) for i in range(40)]
    rows += [(20_000 + i, rows[0][1]) for i in range(50)]          # copies
    rng.shuffle(rows)
    got = check(spark, make_docs(rows), rows, 85)
    assert len({c for _, c in got.values()}) > 6


def test_threshold_is_exact(spark, make_docs):
    # 17 of 20 shingles in common: exactly 0.85; 16 of 20 are below
    a = [f"a{i}" for i in range(24)]                     # 20 shingles
    at = a[:21]                                          # 17 shingles, all shared
    below = a[:20]                                       # 16 shingles
    rows = [(1, " ".join(a)), (2, " ".join(at)), (3, " ".join(below).replace("a0 ", "A0 "))]
    got = check(spark, make_docs(rows), rows, 85)
    assert got[2][1] == 1
    assert got[3][1] == 1                                # 16 of 17 with document 2


def test_pairs_of_a_group_without_links_are_bounded(spark, make_docs, monkeypatch):
    """A common passage and two of a few blocks: all share table keys and no
    shingle is alone, but few are similar enough."""
    rng = random.Random(11)
    passage, blocks = prose(rng, 90), [prose(rng, 14) for _ in range(25)]
    rows = [(i, " ".join(passage + blocks[a] + blocks[b])) for i, (a, b) in enumerate(
        (a, b) for a in range(25) for b in range(a) if (a + b) % 3)]
    asked, verified = [], neardup.verified

    def count(pairs, sets, percent):
        asked.append(pairs.count())
        return verified(pairs, sets, percent)
    monkeypatch.setattr(neardup, "verified", count)
    check(spark, make_docs(rows), rows, 85)
    assert asked[1] < 20 * len(rows)


def test_parity_bits_keep_every_link():
    rng = np.random.default_rng(2)
    work = neardup.BlockPairs(85)
    for size in (20, 200, 5000):
        a = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        keep = size - int(size * 15 / 100)                      # exactly 0.85 with a
        sets = [a, a[:keep]]
        bits = np.stack([parity(s) for s in sets])
        n = np.array([len(s) for s in sets])
        assert work.near(bits, n, np.array([0]), np.array([1]))[0]
    far = [rng.integers(0, 1 << 63, 200, dtype=np.uint64) for _ in range(2)]
    assert not work.near(np.stack([parity(s) for s in far]), np.array([200, 200]), np.array([0]), np.array([1]))[0]


def parity(s):
    odd = np.bincount((neardup.mix(s) % np.uint64(neardup.BITS)).astype(np.int64), minlength=neardup.BITS) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def test_sample_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    check(spark, docs, rows, 85)
    check(spark, docs, rows, 80)


def test_edges(spark, make_docs, edge_rows):
    docs = make_docs(edge_rows).withColumnRenamed("source", "component_id").withColumnRenamed("lang", "bands")
    out = neardup.near_duplicates(docs).collect()
    assert sum(r["doc_id"] is None for r in out) == 2 and all(r["kept"] for r in out if r["doc_id"] is None)
    got = {r["doc_id"]: r for r in out}
    for i in (1, 2, 3):
        assert got[i]["n_shingles"] == 0 and got[i]["component_id"] == i and got[i]["kept"]
    assert got[5]["component_id"] == got[6]["component_id"] == 4 and got[4]["kept"] and not got[6]["kept"]
    assert got[8]["component_id"] == 7                    # only white space differs
    assert sum(r["doc_id"] == 9 for r in out) == 1
    assert neardup.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("edges,expected", [
    ([(i, i + 1) for i in range(40)], {i: 0 for i in range(41)}),
    ([(5, 3), (9, 5), (20, 21), (7, 7)], {3: 3, 5: 3, 9: 3, 20: 20, 21: 20}),
    ([], {}),
])
def test_components(spark, edges, expected):
    df = spark.createDataFrame(edges, "a long, b long")
    assert {r["node"]: r["component"] for r in components(df).collect()} == expected
