import hashlib
import random

import numpy as np
import pytest
from conftest import WORD, prose

from salesmart.llm import substring
from salesmart.llm.fmindex import FmIndex


def brute(rows, n):
    """(doc_id, text) -> (words, removed, kept hash); rows with equal id and
    text are one document."""
    seen, out = set(), {}
    for i, t in sorted(set((i, t or "") for i, t in rows)):
        w = WORD.findall(t)
        gone = [False] * len(w)
        for k in range(len(w) - n + 1):
            key = tuple(w[k:k + n])
            if key in seen:
                gone[k:k + n] = [True] * n
            seen.add(key)
        kept = [x for x, g in zip(w, gone) if not g]
        out[i, t] = (len(w), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


def check(docs, rows, n=20):
    want = brute([r for r in rows if r[0] is not None], n)
    got = substring.remove_repeats(docs, n).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["n_removed"] == 0
        else:
            h = hashlib.sha256(r["kept"].encode()).hexdigest()
            assert (r["n_words"], r["n_removed"], h) == want[r["doc_id"], r["text"] or ""]


def passages(rng):
    shared = [prose(rng, rng.randrange(15, 60)) for _ in range(8)]
    rows = []
    for i in range(120):
        w = []
        for _ in range(rng.randrange(1, 5)):
            w += prose(rng, rng.randrange(0, 40))
            if rng.random() < 0.6:
                w += rng.choice(shared)
        rows.append((rng.randrange(10 ** 6), " ".join(w)))
    rows += [(2_000_000 + i, rows[3][1]) for i in range(10)]              # copies
    rows.append((5, " ".join(["echo"] * 200)))                            # one word again and again
    rows.append((6, " ".join(["echo", "oche"] * 60)))
    return rows


@pytest.mark.parametrize("shard,hot", [(30_000, 20_000), (10, 2)])
def test_against_brute_force(make_docs, monkeypatch, shard, hot):
    monkeypatch.setattr(substring, "SHARD", shard)
    monkeypatch.setattr(substring, "HOT", hot)           # 2: common seeds go to several index chunks
    rows = passages(random.Random(9))
    check(make_docs(rows), rows)
    check(make_docs(rows), rows, 50)


def test_only_texts_with_spans_are_joined(make_docs, monkeypatch):
    rows = passages(random.Random(4)) + [(3_000_000 + i, " ".join(prose(random.Random(i), 60))) for i in range(300)]
    docs, seen, step = make_docs(rows), [], substring.map_batches

    def last(df, *rest):
        seen.append(df)
        return step(df, *rest)
    monkeypatch.setattr(substring, "map_batches", last)
    substring.remove_repeats(docs)
    plan = seen[-1]._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("Union") == plan.toString().count("Join") == 1
    assert plan.collectLeaves().size() == 3              # texts that stay, texts to join, spans
    # a full bit table sends every text through the join: same result
    monkeypatch.setattr(substring, "in_table", lambda table, v: np.ones(len(v), dtype=bool))
    check(docs, rows)


def test_sample_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(docs, [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_edges(spark, make_docs, edge_rows):
    twenty = " ".join(f"t{i}" for i in range(20))
    rows = edge_rows + [(30, twenty), (31, twenty.replace(" ", "\n")), (32, twenty + " more"), (33, "x " + twenty),
                        (34, twenty), (34, twenty), (35, " ".join(f"t{i}" for i in range(19)))]
    docs = make_docs(rows).withColumnRenamed("source", "start").withColumnRenamed("lang", "n_words")
    check(docs, rows)
    assert substring.remove_repeats(docs.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_matching_statistics(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(2, 7))
    lengths = rng.integers(n, 30, 20)
    words = rng.integers(0, 5, int(lengths.sum())).astype(np.uint64)
    index = FmIndex(words, lengths, n)
    text, at = {}, 0
    for k, size in enumerate(lengths):
        for i in range(size - n + 1):
            text.setdefault(tuple(words[at + i:at + i + n]), index.starts[k] + i)
        at += size
    other = rng.integers(0, 6, 400).astype(np.uint64)       # symbol 5 is unknown to the index
    sizes = np.array([100, 3, 297])
    got = index.first_positions(other, sizes)
    want, at = [], 0
    for size in sizes:
        want += [text.get(tuple(other[at + i:at + i + n]), -1) for i in range(size - n + 1)]
        at += size
    assert got.tolist() == want
    assert index.first_positions(words, lengths).min() >= 0


def test_each_task_has_one_python_worker(make_docs, monkeypatch):
    """texts that stay pass one Python step; work arrays are those of a MB."""
    docs, seen, step = make_docs(passages(random.Random(4))), [], substring.map_batches

    def last(df, *rest):
        seen.append((df, rest))
        return step(df, *rest)
    monkeypatch.setattr(substring, "map_batches", last)
    substring.remove_repeats(docs)
    plan = seen[-1][0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("EvalPython") == 1 and plan.index("Join") < plan.index("EvalPython")
    assert all(rest[2:] and rest[2] <= 1 << 20 for _, rest in seen)
    # the text is sent once
    assert "text" not in seen[-1][0].schema["_row"].dataType.fieldNames()
