import hashlib
import random
from collections import Counter

import numpy as np
from conftest import WORD, prose

from salesmart.llm import fingerprint


def terms(text):
    w = WORD.findall(text or "")
    return Counter(zip(w, w[1:] + [""]))


def jaccard(a, b):
    keys = a.keys() | b.keys()
    return sum(min(a[k], b[k]) for k in keys) / sum(max(a[k], b[k]) for k in keys) if keys else 1.0


def edits(rows):
    """doc_id -> (own text, edited text, next text); ids are distinct."""
    order = sorted(rows, reverse=True)
    out = {}
    for k, (i, t) in enumerate(order):
        nxt = order[(k + 1) % len(order)][1] or ""
        t = t or ""
        m = len(t) // 3
        out[i] = (t, t[:len(t) - m] + nxt[:m], nxt)
    return out


def test_likeness_is_unbiased(spark, make_docs):
    rng = random.Random(7)
    rows = []
    for i in range(300):
        w = prose(rng, rng.randrange(1, 120), 60)                   # small vocabulary: weights above 1
        rows.append((rng.randrange(10 ** 7), " ".join(w)))
    rows = list(dict(rows).items())
    want = edits(rows)
    got = fingerprint.compare_with_edits(make_docs(rows)).collect()
    assert len(got) == len(rows)
    error = []
    for r in got:
        own, edited, nxt = want[r["doc_id"]]
        assert r["n_chars"] == len(own) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert len(r["fingerprint"]) == 8 * fingerprint.SAMPLES
        error += [r["near_edited"] - jaccard(terms(own), terms(edited)), r["near_next"] - jaccard(terms(own), terms(nxt))]
    assert abs(np.mean(error)) < 0.02 and np.std(error) < 0.12


def test_edges(spark, make_docs, edge_rows):
    docs = make_docs(edge_rows).withColumnRenamed("source", "fingerprint").withColumnRenamed("lang", "id")
    out = fingerprint.compare_with_edits(docs).collect()
    assert len(out) == len(edge_rows)
    got = {r["doc_id"]: r for r in out}
    assert got[1]["fingerprint"] == got[2]["fingerprint"] == got[3]["fingerprint"] == ""
    assert got[2]["near_next"] == 1.0 and got[4]["near_next"] == 0.0 and got[1]["n_chars"] == 0
    assert got[4]["fingerprint"] == got[5]["fingerprint"] != got[6]["fingerprint"]
    assert got[5]["near_next"] == 1.0
    nine = [r["fingerprint"] for r in out if r["doc_id"] == 9]
    alone = fingerprint.compare_with_edits(make_docs([(1, "same row twice")])).first()
    assert nine == [alone["fingerprint"]] * 2                        # repeated rows do not add weight
    assert alone["near_next"] == 1.0
    want = edits([r for r in edge_rows if r[0] not in (None, 9)] + [(9, "same row twice")])
    for i, (own, edited, _) in want.items():
        assert got[i]["n_chars"] == len(own)
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest(), i
    assert fingerprint.compare_with_edits(docs.limit(0)).count() == 0


def test_next_ids_across_blocks(spark):
    ids = [-70000, -1, 0, 5, 65535, 65536, 10 ** 12]
    df = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    got = {r["doc_id"]: r["next_id"] for r in fingerprint.next_ids(df).collect()}
    assert got == {i: ids[k - 1] for k, i in enumerate(ids)}
