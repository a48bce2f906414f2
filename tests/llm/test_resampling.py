"""Target resampling against a brute-force version in plain Python."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from conftest import prose

from salesmart.llm import resampling
from salesmart.llm.runs import Crc32

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text):
    words = WORD.findall((text or "").translate(LOWER))
    return len(words), [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def brute(rows, target, percent=5, least=20, buckets=10_000, seed=42):
    def count(texts):
        out = [0] * buckets
        for t in texts:
            for g in grams(t)[1]:
                out[zlib.crc32(g.encode()) % buckets] += 1
        return out
    s, t = count(x for _, x in rows), count(target)
    S, U = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((b + 1) * (S + buckets) / ((a + 1) * (U + buckets)))) for a, b in zip(s, t)]
    out, able = [], []
    for k, (i, x) in enumerate(rows):
        n, f = grams(x)
        w = sum(gain[zlib.crc32(g.encode()) % buckets] for g in f)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
        if n >= least:
            able.append(k)
    able.sort(key=lambda k: (-out[k][3], out[k][0] is None, out[k][0] or 0))
    for r, k in enumerate(able[:percent * len(able) // 100]):
        out[k][4] = r + 1
    return sorted(map(tuple, out), key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    rows = [(i, " ".join(prose(rng, rng.randrange(0, 90), 300)).capitalize()) for i in range(700)]
    target = [" ".join(prose(rng, 30, 60)) for _ in range(40)]
    return rows, target


def bench(spark, texts):
    return spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "item_id string, text string")


def test_matches_brute_force(spark, make_docs, corpus, monkeypatch):
    rows, target = corpus
    expected = brute(rows, target, percent=20)
    assert sum(r[4] is not None for r in expected) > 50
    docs = make_docs(rows).repartition(5)
    assert result(resampling.resample(docs, bench(spark, target), percent=20)) == expected
    # the same cutoff when the rounds have to find it alone
    monkeypatch.setattr(resampling, "BLOCK", 30)
    scored = resampling.scored(docs, np.zeros(10_000, np.int64))
    keys = sorted(tuple(r) for r in resampling._keys(scored).collect())
    for take in (1, 2, 333, 699):
        assert resampling.cutoff(scored, take, finish=1) == keys[take - 1]
    assert resampling.cutoff(scored, 0) is None


def test_edges(spark, make_docs, edge_rows):
    target = ["end of the word", None, ""]
    rows = edge_rows + [(i, "tie " * 25) for i in (40, 41, 42)] + [(50, "tie " * 25)] * 4
    assert result(resampling.resample(make_docs(rows), bench(spark, target), percent=50)) == brute(rows, target, percent=50)
    assert result(resampling.resample(make_docs([]), bench(spark, target))) == []
    assert result(resampling.resample(make_docs(rows), bench(spark, []), percent=100, least_words=0)) \
        == brute(rows, [], percent=100, least=0)


def test_repeated_rows_are_cut_exactly(spark, make_docs):
    rows = [(7, "same words here " * 10)] * 300 + [(None, "other words here " * 10)] * 300
    got = result(resampling.resample(make_docs(rows).repartition(7), bench(spark, ["x"])))
    assert [r[4] for r in got if r[4] is not None].__len__() == 30
    assert sorted(r[4] for r in got if r[4] is not None) == list(range(1, 31))


def test_keeps_columns_and_replaces_clashing_ones(spark, make_docs):
    docs = make_docs([(i, f"alpha beta {i} " * 12) for i in range(40)]).selectExpr("*", "'x' rank", "1 weight", "2 _n", "3 _id")
    got = resampling.drawn(docs, bench(spark, ["alpha beta"]), percent=10)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "_n", "_id", "n_words", "n_features", "weight", "score", "rank"]
    assert sorted(r["rank"] for r in got.collect()) == [1, 2, 3, 4]
    assert {(r["_n"], r["_id"]) for r in got.collect()} == {(2, 3)}


def test_weighted_median():
    assert resampling.weighted_median([(1, (5,)), (10, (2,)), (3, (9,))]) == (2,)
    assert resampling.weighted_median([(1, (1,)), (1, (2,))]) == (1,)


def test_crc():
    rng = np.random.default_rng(1)
    crc, data = Crc32(), rng.integers(0, 256, 40_000, dtype=np.uint8)
    starts = rng.integers(0, 20_000, 300)
    size = np.concatenate([rng.integers(0, 70, 290), rng.integers(64, 20_000, 10)])
    got = crc.slices(data, starts, starts + size)
    assert got.tolist() == [zlib.crc32(data[a:a + n].tobytes()) for a, n in zip(starts, size)]
    joined = crc.push(got[:-1], size[1:]) ^ got[1:]
    assert joined.tolist() == [zlib.crc32(data[a:a + n].tobytes() + data[b:b + m].tobytes())
                               for a, n, b, m in zip(starts[:-1], size[:-1], starts[1:], size[1:])]
