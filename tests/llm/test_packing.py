import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from salesmart.llm import packing, queries
from salesmart.llm.packing import best_fit_plan, cut_lengths, fillings, plan, slots

PATH = public_tokenizers.path("byte_bpe_50k.json")


def reference_ids():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda text: np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")


def check(rows, out):
    ids = reference_ids()
    seen = {}
    for r in out:
        seen.setdefault(r["doc_id"], []).append(r)
    for i, t in rows:
        want = ids(t)
        own = sorted(seen[i], key=lambda r: r["piece"])[:len(cut_lengths(len(want), 1024))] if i is not None else []
        at = 0
        for k, r in enumerate(own):
            assert r["start"] == at and 1 <= r["length"] <= 1024 and (k == 0 or r["length"] == 1024)
            assert r["ids_crc32"] == zlib.crc32(want[at:at + r["length"]].tobytes())
            at += r["length"]
        assert i is None or at == len(want)
    by = {}
    for r in out:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    return len(by)


def test_sample_tables(spark):
    sf = "/root/testdata/sf0.001"
    out = queries.QUERIES["op9_best_fit_packing"](spark, sf).collect()
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    bins = check(rows, out)
    total = sum(r["length"] for r in out)
    assert bins <= -(-total // 1024) + 2


def test_edges(spark, make_docs, edge_rows):
    rows = [r for r in edge_rows if r[0] != 9] + [(40, "<|endoftext|> is text"), (41, " " * 9000 + "x"), (42, "it's  we'LL\n\n 'tis")]
    docs = make_docs(rows).withColumnRenamed("source", "offset").withColumnRenamed("lang", "length")
    out = packing.pack_documents(docs, PATH).collect()
    check(rows, out)
    assert sum(r["doc_id"] is None for r in out) == 2
    assert {r["doc_id"]: r["length"] for r in out}[1] == 1
    twice = packing.pack_documents(make_docs([(9, "a b"), (9, "a b")]), PATH).collect()
    assert len(twice) == 2 and len({(r["sequence_id"], r["offset"]) for r in twice}) == 2
    assert packing.pack_documents(docs.limit(0), PATH).count() == 0


def test_slices_do_not_change_ids(monkeypatch):
    monkeypatch.setattr(packing, "SLICE", 50)
    rng = random.Random(2)
    text = "".join(rng.choice(["a", "bc", " ", "  ", "\n", "'s", "7", "é", "!?", " dé"]) for _ in range(4000))
    with open(PATH, encoding="utf-8") as f:
        enc = packing.Encoder(f.read())
    assert list(enc.encode(text)) == reference_ids()(text)[:-1].tolist()
    assert len(list(enc.slices(text))) > 20


def test_plan_uses_every_piece_once():
    rng = random.Random(4)
    for trial in range(30):
        cap = rng.choice([10, 50, 100, 1024])
        counts = {}
        for _ in range(rng.randrange(1, 300)):
            n = min(cap, max(1, int(rng.expovariate(4 / cap))))
            counts[n] = counts.get(n, 0) + 1
        got = plan(counts, cap)
        used = {}
        for whole, times in got:
            assert sum(whole) <= cap and times > 0
            for n in whole:
                used[n] = used.get(n, 0) + times
        assert used == counts
        bins = sum(k for _, k in got)
        assert bins <= sum(k for _, k in best_fit_plan(counts, cap))
        ranks = {}
        for n, first, times, _, _ in slots(got):
            assert first == ranks.get(n, 0)
            ranks[n] = first + times
        assert ranks == counts


def exact(items, cap):
    """Fewest bins by exhaustive search."""
    items = sorted(items, reverse=True)
    best = [len(items)]

    def go(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(items):
            best[0] = len(bins)
            return
        for i in {b: i for i, b in enumerate(bins)}.values():
            if bins[i] + items[k] <= cap:
                bins[i] += items[k]
                go(k + 1, bins)
                bins[i] -= items[k]
        go(k + 1, [*bins, items[k]])
    go(0, [])
    return best[0]


def test_plan_is_optimal_on_small_cases():
    rng = random.Random(8)
    for _ in range(25):
        items = [rng.randrange(1, 60) for _ in range(9)]
        counts = {n: items.count(n) for n in items}
        assert sum(k for _, k in plan(counts, 60)) == exact(items, 60)


def test_fillings_are_undominated():
    left = {5: 1, 4: 1, 3: 2, 2: 1}
    got = fillings(left, [5, 4, 3, 2], 7, 10)
    assert got[0] == (0, (4, 3)) or got[0] == (0, (5, 2))
    assert all(w == 0 or not any(n <= w for n in left if left[n] > f.count(n)) for w, f in got)
