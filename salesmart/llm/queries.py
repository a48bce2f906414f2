"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import (backoff, decontam, fingerprint, langid, neardup, packing, quality, resampling, substring,
                           toxicity, urlfilter, variants, wordpiece)
from salesmart.llm.common import crc_mod, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

THRESHOLD = 0.3


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def _held_out(n: int, rest: int):
    return F.coalesce(crc_mod("doc_id", n) == rest, F.lit(True))


def _judged(df: DataFrame, held: F.Column) -> DataFrame:
    return df.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


@register("op2_quality_classifier")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; learned from rows outside crc32 mod 5 = 0."""
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels").filter(crc_mod("doc_id", 5) != 0))
    return _judged(quality.score(docs.select("doc_id", "text"), model), _held_out(5, 0))


@register("op3_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; learned from rows outside crc32 mod 4 = 2."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels").filter(crc_mod("doc_id", 4) != 2))
    return _judged(toxicity.score(docs.select("doc_id", "text"), model), _held_out(4, 2))


@register("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned from rows outside crc32 mod 4 = 2."""
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.filter(crc_mod("doc_id", 4) != 2))
    return langid.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", _held_out(4, 2).alias("held_out"), "lang_pred", "score")


@register("op9_best_fit_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, tokenised and packed into sequences of at most 1024 ids."""
    import public_tokenizers
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@register("op10_substring_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document outside repeated 20-word windows."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@register("op4_minhash_near_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents at similarity 0.85."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), 85)


#: The rules of op7 (fixed values): host, path, verdict.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]

_OP7_SQL = """
WITH u AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u
), p AS (
  SELECT page_id, translate(coalesce(raw, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*'), '') AS path FROM h
), r(rule_host, rule_path, rule_verdict) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), f AS (
  SELECT page_id, host, path, rule_host || rule_path AS rule, rule_verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC NULLS LAST) AS n
  FROM p LEFT JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict FROM f WHERE n = 1
"""


@register("op7_url_filter", _OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, longest fitting rule and verdict of every page."""
    rules = urlfilter.rule_table(spark, URL_RULES)
    return urlfilter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select(
        "page_id", "host", "path", "rule", "verdict")


@register("op8_weighted_fingerprints")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consistent weighted sampling fingerprints of every document and of its edited text."""
    return fingerprint.compare_with_edits(table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op1_benchmark_decontamination")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item, verbatim or re-parameterised."""
    return decontam.leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


@register("op5_word_piece_counts")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and greedy word pieces of every document."""
    import public_tokenizers
    pieces = wordpiece.vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    return wordpiece.count_pieces(table(spark, sf_dir, "documents").select("doc_id", "text"), pieces).select(
        "doc_id", "n_words", "n_pieces")


@register("op11_backoff_lm")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model score of every document; learned from rows outside crc32 mod 7 = 2."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return backoff.score(docs, F.coalesce(crc_mod("doc_id", 7) != 2, F.lit(False)), keep=["doc_id"]).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@register("op12_target_resampling")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents towards the benchmark texts and the ranks of the drawn ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resampling.resample(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"]).select(
        "doc_id", "n_features", "weight", "score", "rank")


@register("op13_spelling_variants")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their frequent near words; a share of occurrences loses a letter."""
    return variants.variant_groups(table(spark, sf_dir, "documents").select("doc_id", "text"), typo_every=199)


register("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
