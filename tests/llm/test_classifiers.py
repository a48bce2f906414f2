import duckdb
import numpy as np
import pyarrow as pa
import pytest

from salesmart.llm import langid, quality, queries, toxicity
from salesmart.llm.bytecnn import ByteCnn, cut_windows, gather
from salesmart.llm.common import sample_ids

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name,label,least", [("op2_quality_classifier", "quality", 0.93), ("op3_toxicity", "toxic", 0.88)])
def test_held_out_accuracy(spark, name, label, least):
    got = queries.QUERIES[name](spark, SF).toPandas()
    assert list(got.columns) == ["doc_id", "held_out", "score", "predicted"]
    assert len(got) == 1000 and got.score.between(0, 1).all()
    assert ((got.score >= 0.3).astype(int) == got.predicted).all()
    labels = duckdb.sql(f"select doc_id, {label} as y from '{SF}/labels.parquet'").df()
    both = got.merge(labels, on="doc_id")
    held = both[both.held_out]
    assert len(held) > 50 and (held.y == held.predicted).mean() >= least


def test_language_held_out(spark):
    got = queries.QUERIES["op6_language_id"](spark, SF).toPandas()
    langs = duckdb.sql(f"select doc_id, lang from '{SF}/documents.parquet'").df()
    both = got.merge(langs, on="doc_id")
    held = both[both.held_out]
    assert len(got) == 1000 and (held.lang == held.lang_pred).mean() >= 0.97


def test_windows_cover_every_byte():
    off = np.array([0, 0, 5, 5 + 1000])
    doc, start, size = cut_windows(np.zeros(1005, np.uint8), off, 64, 48)
    for d in range(3):
        seen = set()
        for s, n in zip(start[doc == d], size[doc == d]):
            seen |= set(range(s, s + n))
        assert seen == set(range(off[d], off[d + 1])) and (doc == d).any()
    x = gather(np.arange(5, dtype=np.uint8), np.array([3]), np.array([2]), 4)
    assert x.tolist() == [[3, 4, 0, 0]]


def test_gradient_learns_a_motif():
    rng = np.random.default_rng(0)
    x = rng.integers(97, 123, (1600, 64)).astype(np.uint8)
    y = np.arange(1600) % 2
    x[y == 1, 20:24] = np.frombuffer(b"zqzq", np.uint8)
    net = ByteCnn((4,), 8, 4, 2, 64).fit(x[:1200], y[:1200], epochs=20)
    assert (net.logits(x[1200:]).argmax(axis=1) == y[1200:]).mean() > 0.9


def test_edges(spark, make_docs, edge_rows):
    docs = make_docs(edge_rows)
    q = quality.QualityModel(ByteCnn((8,), 4, 4, 2, quality.CHUNK, 2), np.array([1.0, 0, 0, 0]))
    out = quality.score(docs.withColumnRenamed("source", "score"), q)     # a clashing column is replaced
    rows = out.toPandas()
    assert len(rows) == len(edge_rows) and rows.score.between(0, 1).all()
    same = rows[rows.doc_id == 9].score.tolist()
    assert same[0] == same[1]
    lang = langid.LanguageModel(ByteCnn((3,), 4, 4, 2, langid.WINDOW), ["aa", "bb"])
    pred = langid.identify(docs, lang).toPandas().set_index("doc_id")
    for i in (1, 2, 3, 13):
        assert pred.lang_pred[i] == "und" and pred.score[i] == 0
    assert pred.lang_pred[12] in ("aa", "bb")
    tox = toxicity.score(docs, toxicity.ToxicModel({"word": 3.0}, -1.0)).toPandas()
    assert len(tox) == len(edge_rows)
    assert (tox[tox.doc_id.isin([4, 5, 6])].score > 0.85).all() and (tox[tox.doc_id.isin([1, 2])].score < 0.3).all()
    empty = docs.limit(0)
    assert quality.score(empty, q).count() == langid.identify(empty, lang).count() == 0
    assert langid.LanguageModel(None, []).predict(pa.array(["a"]))[0] == ["und"]


def test_training_on_nothing(spark, make_docs):
    docs = make_docs([(1, "a b")])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert 0 <= quality.score(docs, quality.train(docs, labels)).first()["score"] <= 1
    assert 0 <= toxicity.score(docs, toxicity.train(docs, labels)).first()["score"] <= 1
    assert langid.train(docs.limit(0)).langs == []


def test_identity_terms_stay_neutral():
    rng = np.random.default_rng(1)
    texts, y = [], []
    for i in range(400):
        words = [f"w{rng.integers(50)}" for _ in range(12)]
        toxic = i % 4 == 0
        if toxic:
            words.append("vermin")
        if rng.random() < (0.9 if toxic else 0.1):         # the group is named mostly in toxic texts
            words.append("muslims")
        texts.append(" ".join(words))
        y.append(int(toxic))
    y = np.array(y)
    free = toxicity.fit(texts, y, penalty=0.0)
    held = toxicity.fit(texts, y, penalty=5.0)
    assert abs(held.weights.get("muslims", 0)) < 0.3 * max(free.weights.get("muslims", 0), 0.1) + 0.1
    neutral = held.score(pa.array(["the muslims came to tea"]).to_pylist())[0]
    assert neutral < 0.3 < held.score(["what vermin"])[0]


def test_counterfactuals_swap_each_term():
    got = toxicity.counterfactuals(["Women and men", "no term"], ("women", "men", "gay"))
    assert got["women", ""] == 1 and got["women", "gay"] == 1 and ("women", "men") not in got


def swapped_texts(term):
    """Texts in which the group's name tells the label better than any other word."""
    rng = np.random.default_rng(3)
    texts, y = [], []
    for i in range(600):
        toxic = i % 2
        words = [f"w{chr(97 + rng.integers(26))}x" for _ in range(10)] + ["vermin"] * (toxic and rng.random() < 0.5)
        words += [term if rng.random() < (0.95 if toxic else 0.05) else "men"]
        texts.append(" ".join(words))
        y.append(toxic)
    return texts, np.array(y)


@pytest.mark.parametrize("term", ["muslims", "immigrants", "gay"])
def test_swaps_hardly_move_the_score(term):
    model = toxicity.fit(*swapped_texts(term))
    odds = [float(np.log(p / (1 - p))) for p in model.score([f"the {t} came to tea" for t in (term, "men", "women", "people")])]
    assert max(odds) - min(odds) < 0.3
    assert model.score(["what vermin"])[0] > model.score(["what tea"])[0] + 0.1


def test_swap_lists_every_feature_that_changes():
    at = {f: i for i, f in enumerate(["muslims", "<musl", "<musl+", "<muslim", "men", "tea", "women", "<wome"])}
    names = list(at)
    for sentence in ("muslims drink tea", "muslims and a muslim", "muslims muslin muslim tea"):
        words = set(sentence.split())
        for other in ("", "men", "women"):
            before = toxicity.features(words)
            after = toxicity.features(words - {"muslims"} | ({other} if other else set()))
            _, _, lost, gained = toxicity.Swap(at, toxicity.IDENTITY_TERMS)(words, "muslims", other)
            assert {names[i] for i in lost} == (before - after) & set(at)
            assert {names[i] for i in gained} == (after - before) & set(at)


def test_no_language_is_left_out(spark):
    rows = spark.range(4800).selectExpr("id as doc_id", "if(id < 3, null, concat('l', lpad(id % 1200, 4, '0'))) as lang")
    got = sample_ids(rows, "lang", 2).toPandas()
    assert got.lang.nunique() == 1200 and (got.groupby("lang").size() == 2).all()
