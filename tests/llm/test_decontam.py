import random
import tracemalloc

import pyarrow as pa
from conftest import prose
from pyspark.sql import functions as F

from salesmart.llm import decontam, queries
from salesmart.llm.common import SLICE_BYTES

ITEM = ("A farmer named Nora Bell sells 12 kg of apples and 30 pears to Peter and later another 12 kg of plums; "
        "how many coins does Nora Bell take home if one kg costs 5 coins each day?")


def run(spark, make_docs, rows, items):
    table = spark.createDataFrame(items, "item_id long, text string")
    return {(r["doc_id"], r["item_id"]): r for r in decontam.leaks(make_docs(rows), table).collect()}


def around(rng, text):
    return " ".join(prose(rng, 50)) + ". " + text + " " + " ".join(prose(rng, 50))


def test_verbatim_and_reparameterised(spark, make_docs):
    rng = random.Random(2)
    changed = ITEM.replace("12", "48").replace("30", "7").replace("Nora", "Clara").replace("Bell", "Stone").replace("Peter", "Omar")
    torn = ITEM.replace("12 kg of apples", "48 kg of apples").replace("Nora Bell sells", "Clara Stone sells")
    rows = [(1, around(rng, ITEM)), (2, around(rng, changed)), (3, around(rng, torn)), (4, around(rng, "nothing")),
            (5, around(rng, ITEM.upper())), (6, around(rng, " ".join(ITEM.split()[:8])))]
    got = run(spark, make_docs, rows, [(7, ITEM), (8, None), (9, ""), (10, "too short")])
    assert got[1, 7]["kind"] == "verbatim" and got[1, 7]["changed_slots"] == 0
    assert got[2, 7]["kind"] == "re-parameterised" and got[2, 7]["changed_slots"] >= 4
    assert (4, 7) not in got and (6, 7) not in got
    # 12 becomes 48 in one place and stays 12 in the other
    assert (3, 7) not in got


def test_short_items_and_repeats(spark, make_docs):
    rng = random.Random(3)
    items = [(1, "five little ducks went swimming"), (1, "five little ducks went swimming"), (None, "seven red hens ran home")]
    rows = [(1, around(rng, "five little ducks went swimming")), (1, around(rng, "five little ducks went swimming")),
            (None, around(rng, "seven red hens ran home")), (2, None), (3, ""), (4, " ".join(prose(rng, 20_000)))]
    got = run(spark, make_docs, rows, items)
    assert set(got) == {(1, 1), (None, None)}


def test_many_items_are_shuffled(spark, make_docs, monkeypatch):
    monkeypatch.setattr(decontam, "BROADCAST_WINDOWS", 0)
    rng = random.Random(4)
    items = [(i, " ".join(prose(rng, 30))) for i in range(50)]
    rows = [(i, around(rng, items[i][1])) for i in range(0, 50, 2)] + [(100 + i, " ".join(prose(rng, 80))) for i in range(20)]
    got = run(spark, make_docs, rows, items)
    assert set(got) == {(i, i) for i in range(0, 50, 2)}


def test_sample_tables(spark):
    sf = "/root/testdata/sf0.01"
    out = {(r["doc_id"], r["item_id"]) for r in queries.QUERIES["op1_benchmark_decontamination"](spark, sf).collect()}
    flat = F.regexp_replace("text", r"[\x20\x09-\x0D]+", " ")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", flat.alias("t"))
    items = spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", flat.alias("s"))
    want = {(r["doc_id"], r["item_id"]) for r in docs.join(F.broadcast(items), F.contains("t", "s")).collect()}
    assert want and want <= out and len(out) <= len(want) * 1.1 + 3


def test_empty_tables(spark, make_docs, edge_rows):
    docs = make_docs(edge_rows).withColumnRenamed("source", "item_id")
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert decontam.leaks(docs, none).count() == 0
    assert decontam.leaks(docs.limit(0), some).count() == 0
    assert decontam.leaks(docs, some).count() == 0


def test_single_torn_slots_do_not_hide_a_leak(spark, make_docs):
    rng = random.Random(6)
    fewer = ITEM.replace("12", "4").replace("30", "4")                       # two item values get one new value
    trip = "the hikers walked for 3 days through the hills and then rested for 4 days beside the quiet lake before home"
    rows = [(1, around(rng, ITEM.replace("12 kg of apples", "48 kg of apples"))), (2, around(rng, fewer)),
            (3, around(rng, trip.replace("3 days", "1 day")))]
    got = run(spark, make_docs, rows, [(7, ITEM), (8, trip)])
    assert set(got) == {(1, 7), (2, 7), (3, 8)}
    assert {r["kind"] for r in got.values()} == {"re-parameterised"}


PLAIN = ("the teacher asked Ann to count every red marble in the wooden box before lunch and then write down the total again")


def test_shifted_pieces_add_up(spark, make_docs):
    rng = random.Random(7)
    extra = PLAIN.replace("in the wooden", "in the old wooden")
    rows = [(1, around(rng, extra)), (2, around(rng, PLAIN.replace("Ann", "Mary Jane"))), (3, around(rng, " ".join(PLAIN.split()[:9])))]
    got = run(spark, make_docs, rows, [(1, PLAIN)])
    assert set(got) == {(1, 1), (2, 1)}


def test_exact_words_of_numbers_short_items_and_unspaced_scripts(spark, make_docs):
    rng = random.Random(8)
    items = [(1, "Compute 12 + 7 * 3 - 4 / 2 + 18 * 5 - 61"), (2, "Paris London Rome Berlin Madrid Vienna Oslo Athens Dublin Lisbon"),
             (3, "blue whales sing"), (4, "\u4e2d\u56fd\u7684\u9996\u90fd\u662f\u54ea\u5ea7\u57ce\u5e02")]
    rows = [(i, around(rng, t)) for i, t in items] + [(9, around(rng, "Compute 12 + 8 * 3 - 5 / 2 + 19 * 5 - 62"))]
    rows[3] = (4, "w1 w2 \u8bf7\u95ee" + items[3][1] + "\u5417 w3")
    assert set(run(spark, make_docs, rows, items)) == {(i, i) for i in range(1, 5)}


def test_letter_case_does_not_hide_a_leak(spark, make_docs):
    rng = random.Random(9)
    short = "What is the capital of France"
    greek = "yesterday \u0391\u03bd\u03bd\u03b1 carried the old lamp to \u039d\u03af\u03ba\u03bf\u03c2 because the room was dark and the night was long"
    rows = [(1, around(rng, ITEM.lower())), (2, around(rng, ITEM.upper())), (3, "he asked " + short + " w5 w6"), (4, around(rng, short.lower())),
            (5, around(rng, greek.replace("\u0391\u03bd\u03bd\u03b1", "\u0395\u03bb\u03ad\u03bd\u03b7").replace("\u039d\u03af\u03ba\u03bf\u03c2", "\u03a0\u03ad\u03c4\u03c1\u03bf\u03c2"))),
            (6, around(rng, greek.upper()))]
    got = run(spark, make_docs, rows, [(7, ITEM), (8, short), (9, greek)])
    assert set(got) == {(1, 7), (2, 7), (3, 8), (4, 8), (5, 9), (6, 9)}
    assert got[5, 9]["kind"] == "re-parameterised"


def test_memory_of_a_slice(spark, make_docs, monkeypatch):
    """The arrays for one slice of texts stay under 40 MB."""
    limits, whole = [], decontam.map_batches

    def noted(df, schema, start, limit=SLICE_BYTES):
        limits.append(limit)
        return whole(df, schema, start, limit)
    monkeypatch.setattr(decontam, "map_batches", noted)
    run(spark, make_docs, [(1, "five little ducks went swimming")], [(1, "five little ducks went swimming")])
    text = " ".join(prose(random.Random(6), 500))
    n = max(limits) // len(text)
    templates, texts, ids = decontam.Templates(), pa.array([text] * n, pa.string()), pa.array(range(n), pa.int64())
    sizes = {reading: [decontam.WINDOW] for reading in (decontam.TYPED, decontam.FOLDED, decontam.EXACT)}
    tracemalloc.start()
    decontam.template_windows(templates(texts), ids, sizes, False, lambda v: v == 0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(limits) == 2 and peak < 40 << 20
