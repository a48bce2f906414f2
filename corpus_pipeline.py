"""The corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that ``run``
writes as Parquet and rereads as the next stage's ``docs``. All but the last
return the columns of ``docs``. Every stage works on all rows it is given;
documents with NULL or empty texts pass the filters unchanged and are packed
as their end id. A table without rows gives a result without rows.

1. ``toxicity`` drops documents scored at or above ``REJECT_TOXIC``.
2. ``near_dedup`` keeps one document of each group of near duplicates (five
   words, similarity ``NEAR_PERCENT`` / 100 or more): the smallest doc_id. Of
   rows with one doc_id, one stays; rows with a NULL doc_id all stay.
3. ``substring_dedup`` removes words of ``REPEAT_WORDS``-word windows that
   start earlier in the corpus; a text without such words stays as it is, byte
   for byte, and ``n_chars`` follows the text.
4. ``decontaminate`` drops documents that leak a benchmark item.
5. ``pack`` tokenises and packs what is left into sequences of 1024 ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesmart.llm import decontam, neardup, packing, substring, toxicity
from salesmart.llm.common import crc_mod, saved, table

REJECT_TOXIC = 0.3
NEAR_PERCENT = 80
REPEAT_WORDS = 50

#: No SQL: trained scores and searched packings are not SQL-expressible.
ORACLE_SQL = None


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` whose doc_id is not in ``ids`` (rows with a NULL doc_id stay).
    Only rows that a bit table of ``ids`` holds are shuffled for the exact join."""
    gone = ids.select(F.col("doc_id").alias("gone")).distinct()
    _, held = substring.may_be_in(gone.select(F.xxhash64(F.col("gone").cast("long")).alias("hash")), "hash")
    rows = docs.select(_whole(docs), F.col("doc_id").alias("_of")).withColumn("_held", held(F.xxhash64(F.col("_of").cast("long"))))
    left = rows.filter("_held").join(gone, F.col("_of") == F.col("gone"), "left_anti")
    return rows.filter("not _held").union(left).select("_row.*")


def _whole(docs: DataFrame) -> F.Column:
    """All columns as one, so that no name of theirs meets a stage's own."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learned from the labelled rows op3 learns from."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels").filter(crc_mod("doc_id", 4) != 2))
    rows = docs.select(_whole(docs), "text")
    clean = toxicity.score(rows, model).filter((F.col("score") < REJECT_TOXIC) | F.col("text").isNull() | (F.col("text") == ""))
    return clean.select("_row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = saved(neardup.near_duplicates(docs, NEAR_PERCENT), "near")
    left = _without(docs, found.filter("not kept"))
    again = docs.filter("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if again.limit(1).count():
        first = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
        left = left.select(_whole(left), "doc_id", F.row_number().over(first).alias("_n")) \
            .filter("_n = 1 or doc_id is null").select("_row.*")
    return left


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    others = docs.select(*[f"`{c}`" for c in docs.columns if c not in ("doc_id", "text")])       # each text is sent once
    cut = substring.remove_repeats(docs.select("doc_id", "text", _whole(others)), REPEAT_WORDS)
    new = {"doc_id": F.col("doc_id"), "text": F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))}
    new["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col("_row.n_chars"))
    return cut.select(*[(new[c] if c in new else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _without(docs, saved(decontam.leaks(docs, table(spark, sf_dir, "benchmark")), "leaks"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeats),
    ("decontaminate", drop_leaks),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
