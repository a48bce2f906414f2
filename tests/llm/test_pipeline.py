import corpus_pipeline as pipeline
from conftest import WORD
from pyspark.sql import functions as F
from test_neardup import brute as near_brute

import __spark_entry__ as entry
from salesmart.llm import substring, toxicity
from salesmart.llm.common import crc_mod, saved, table

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted((r["doc_id"], r["text"]) for r in df.collect())


def test_stages_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    names = [n for n, _ in pipeline.STAGES]
    assert names == ["toxicity", "near_dedup", "substring_dedup", "decontaminate", "pack"]
    # toxicity: the model's own scores decide
    one = saved(pipeline.drop_toxic(spark, docs, SF), "t1")
    model = toxicity.train(docs, table(spark, SF, "labels").filter(crc_mod("doc_id", 4) != 2))
    all_rows = rows_of(docs)
    scores = model.score([t for _, t in all_rows])
    assert rows_of(one) == [r for r, s in zip(all_rows, scores) if s < 0.3]
    assert one.columns == docs.columns
    # near duplicates: the smallest id of each component
    two = saved(pipeline.drop_near_duplicates(spark, one, SF), "t2")
    kept = {i for i, (_, c) in near_brute(rows_of(one), 80).items() if i == c}
    assert {i for i, _ in rows_of(two)} == kept and two.columns == docs.columns
    # substring: words of repeated windows go, other texts stay as they are
    three = saved(pipeline.drop_repeats(spark, two, SF), "t3")
    seen, want = set(), []
    n = pipeline.REPEAT_WORDS
    for i, t in rows_of(two):
        w = WORD.findall(t)
        gone = [False] * len(w)
        for k in range(len(w) - n + 1):
            if tuple(w[k:k + n]) in seen:
                gone[k:k + n] = [True] * n
            seen.add(tuple(w[k:k + n]))
        want.append((i, " ".join(x for x, g in zip(w, gone) if not g) if any(gone) else t))
    assert rows_of(three) == want and three.columns == docs.columns
    assert three.filter(F.col("n_chars") != F.length("text")).count() == 0
    # decontamination: no whole item is left
    four = saved(pipeline.drop_leaks(spark, three, SF), "t4")
    items = [" ".join(WORD.findall(r["text"])) for r in table(spark, SF, "benchmark").collect()]
    left = rows_of(four)
    assert not any(item in " ".join(WORD.findall(t)) for _, t in left for item in items)
    dropped = set(rows_of(three)) - set(left)
    assert all(any(" ".join(item.split()[3:10]) in " ".join(WORD.findall(t)) for item in items) for _, t in dropped)
    # packing keeps every document
    five = pipeline.pack(spark, four, SF)
    assert {r["doc_id"] for r in five.collect()} == {i for i, _ in left}


def test_registered_query_runs(spark):
    out = entry.queries()["pipeline"](spark, SF)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 0
    assert "pipeline" not in entry.oracle_sql()


def test_edges(spark, make_docs, edge_rows):
    docs = make_docs(edge_rows).withColumn("score", F.lit("mine")).withColumn("n_words", F.lit(1)).withColumn("_n", F.lit(2))
    docs = saved(docs, "edge")
    size = len(edge_rows)
    for name, stage in pipeline.STAGES[:-1]:
        nxt = saved(stage(spark, docs, SF), name)
        assert nxt.columns == docs.columns, name
        assert nxt.filter("doc_id is null").count() == 2, name
        assert {1, 2, 3} <= {r["doc_id"] for r in nxt.select("doc_id").collect()}, name
        assert 0 < nxt.count() <= size
        docs = nxt
    assert docs.filter("doc_id = 9").count() == 1
    assert pipeline.pack(spark, docs, SF).count() >= docs.count()
    none = docs.limit(0)
    for name, stage in pipeline.STAGES:
        assert stage(spark, none, SF).count() == 0, name
    assert substring.remove_repeats(none).count() == 0


def test_dropped_rows_alone_are_shuffled(spark, make_docs, monkeypatch):
    """the anti-join moves the rows that may go, not all texts."""
    docs = make_docs([(i, f"text {i}") for i in range(2000)] + [(None, "no id"), (7, "again")])
    ids = spark.createDataFrame([(i,) for i in (7, 7, 1500, 9999, None)], "doc_id long")
    want = sorted((i, f"text {i}") for i in range(2000) if i not in (7, 1500))

    def check():
        out = pipeline._without(docs, ids)
        assert out.columns == docs.columns
        assert sorted((r["doc_id"], r["text"]) for r in out.collect() if r["doc_id"] is not None) == want
        assert [r["text"] for r in out.filter("doc_id is null").collect()] == ["no id"]
        return out
    plan = check()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Union") == 1 and "EvalPython" in plan[:plan.index("Join")]
    # a full bit table sends every row through the join: same result
    monkeypatch.setattr(substring, "in_table", lambda table, v: v == v)
    check()
