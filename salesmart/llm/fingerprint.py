"""Document fingerprints by consistent weighted sampling, in DataFrame operations only.

A text is a weighted set: its terms are the pairs of neighbouring words (the
last word pairs with nothing), weighted by how often they occur. Each of
``SAMPLES`` samples draws, per term, r and c from Gamma(2, 1) and b from
U(0, 1) by hashing the term, quantises the log weight, t = floor(ln w / r + b),
and keeps the smallest ln a = ln c - r (t - b + 1). The term and t that win are
the same for two texts with probability equal to their generalised Jaccard
similarity sum(min w) / sum(max w); ln a identifies them. The fingerprint
lists a 32-bit code per sample, the likeness of two is the share of equal codes.

Texts are dealt out by ``doc_id`` (NULL: by text) once; exploding, counting and sampling then
stay inside the partition. NULL texts count as empty. A text without words
has the empty fingerprint, which is like another empty one (1) and unlike all
others (0). Equal texts have equal fingerprints. Rows repeated with one
doc_id get a row each; where the next document's id has several rows, its
smallest fingerprint and smallest beginning are taken (each cut by code points). A NULL ``doc_id`` has
no next document: its next text counts as empty. Empty tables give empty
results.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import saved

SAMPLES, LANES = 32, 4
BLANK = r"[\x20\x09-\x0D]+"


def _uniforms(h: Column) -> list[Column]:
    """Three uniforms in (0, 1) from 63 bits of a hash."""
    mask = F.lit((1 << 21) - 1)
    return [(F.shiftrightunsigned(h, s).bitwiseAND(mask).cast("double") + 0.5) * F.lit(2.0 ** -21) for s in (0, 21, 42)]


def sample_parts(term: Column, number: Column) -> tuple[Column, Column, Column]:
    """(r, ln c, b) of one term in one sample."""
    u1, u2, u3 = _uniforms(F.xxhash64(term, number, F.lit(1)))
    u4, u5, _ = _uniforms(F.xxhash64(term, number, F.lit(2)))
    return -F.log(u1 * u2), F.log(-F.log(u3 * u4)), u5


def sample_value(ln_weight: Column, r: Column, ln_c: Column, b: Column) -> Column:
    """ln a of a term whose weight has this logarithm (NULL: weight 0)."""
    return ln_c - r * (F.floor(ln_weight / r + b) - b + 1)


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANK), "")


def weighted_terms(rows: DataFrame, keys: list[str], texts: list[str]) -> DataFrame:
    """``keys``, ``term`` and the term's weight in each of the text columns
    (``w0``, ``w1``, ...). ``copies`` rows with equal keys count as one."""
    tagged = rows.select(*keys, "copies", F.inline(F.array(*[F.struct(F.lit(i).alias("_i"), words(F.col(t)).alias("_w"))
                                                   for i, t in enumerate(texts)])))
    pairs = tagged.select(*keys, "copies", "_i", F.explode(F.arrays_zip(
        F.col("_w").alias("a"), F.slice("_w", F.lit(2), F.greatest(F.size("_w"), F.lit(1))).alias("b"))).alias("_p"))
    term = F.xxhash64("_p.a", F.coalesce("_p.b", F.lit("")))
    counted = pairs.select(*keys, "copies", "_i", term.alias("term")).groupBy(*keys, "term").agg(
        F.max("copies").alias("copies"),
        *[F.sum(F.when(F.col("_i") == i, 1).otherwise(0)).alias(f"w{i}") for i in range(len(texts))])
    return counted.select(*keys, "term", *[(F.col(f"w{i}") / F.col("copies")).alias(f"w{i}") for i in range(len(texts))])


def fingerprints(rows: DataFrame, keys: list[str], texts: list[str], samples: int = SAMPLES) -> DataFrame:
    """``keys`` and one fingerprint per text column (``f0``, ``f1``, ...);
    rows without any term are absent, and so is a text's code where it has
    no term."""
    terms = weighted_terms(rows, keys, texts)
    # the logarithm of a weight is the same in all samples; of weight 0 it is NULL
    terms = terms.select(*keys, "term", *[F.log(f"w{i}").alias(f"w{i}") for i in range(len(texts))])
    groups = terms.withColumn("_g", F.explode(F.sequence(F.lit(0), F.lit(samples // LANES - 1))))
    drawn, values = groups, []
    for lane in range(LANES):
        r, ln_c, b = sample_parts(F.col("term"), F.col("_g") * LANES + lane)
        drawn = drawn.withColumns({f"_r{lane}": r, f"_c{lane}": ln_c, f"_b{lane}": b})
    for i in range(len(texts)):
        for lane in range(LANES):
            values.append(F.min(sample_value(F.col(f"w{i}"), F.col(f"_r{lane}"), F.col(f"_c{lane}"), F.col(f"_b{lane}")))
                          .alias(f"m{i}_{lane}"))
    least = drawn.groupBy(*keys, "_g").agg(*values)

    def code(c: str) -> Column:
        return F.lower(F.lpad(F.hex(F.xxhash64(F.col(c)).bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))
    coded = least.select(*keys, "_g", *[F.when(F.col(f"m{i}_0").isNotNull(), F.concat(*[code(f"m{i}_{k}") for k in range(LANES)]))
                                        .alias(f"p{i}") for i in range(len(texts))])
    return coded.groupBy(*keys).agg(*[
        F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("_g", f"p{i}"))), lambda s: s[f"p{i}"])).alias(f"f{i}")
        for i in range(len(texts))])


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Share of equal codes of two fingerprints."""
    same = reduce(lambda x, y: x + y, [(a.substr(8 * i + 1, 8) == b.substr(8 * i + 1, 8)).cast("int") for i in range(samples)])
    return F.when((a == "") & (b == ""), F.lit(1.0)).when((a == "") | (b == ""), F.lit(0.0)).otherwise(same / float(samples))


def next_ids(ids: DataFrame) -> DataFrame:
    """``doc_id, next_id``: the next smaller id, and the largest after the
    smallest. Distinct ids are range-partitioned and ordered within their
    partition; only one row per partition is ordered across partitions."""
    dealt = saved(ids.repartitionByRange("doc_id").withColumn("_part", F.spark_partition_id()), "ids")
    inside = Window.partitionBy("_part").orderBy("doc_id")
    parts = dealt.groupBy("_part").agg(F.max("doc_id").alias("_top"))
    across = Window.orderBy("_part")
    whole = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    parts = parts.select("_part", F.coalesce(F.lag("_top").over(across), F.max("_top").over(whole)).alias("_below"))
    return dealt.withColumn("_lag", F.lag("doc_id").over(inside)).join(parts, "_part") \
        .select("doc_id", F.coalesce("_lag", "_below").alias("next_id"), *[c for c in ids.columns if c != "doc_id"])


def with_next(docs: DataFrame) -> DataFrame:
    """One row per document: ``id`` and ``none`` (rows without a doc_id take
    their text's hash as id, so they do not meet in one task), ``text``,
    ``text_key``, ``next_id``, ``copies`` (rows with this id and text) and
    ``edited``, the text with its last third replaced by the beginning of the
    next document. The texts are shuffled once, by id; what follows stays in
    place."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(text)).alias("id"), F.col("doc_id").isNull().alias("none"),
                      text.alias("text"))
    key = F.when(F.col("none"), F.xxhash64("text", F.lit(1))).otherwise(F.xxhash64("text"))
    rows = own.groupBy("id", key.alias("key")).agg(F.count(F.lit(1)).alias("n"), F.max(F.length("text")).alias("size"),
                                                   F.bool_or(~F.col("none")).alias("real"))
    ids = rows.groupBy("id").agg(F.max("size").alias("size"), F.map_from_entries(F.collect_list(F.struct("key", "n"))).alias("rows"),
                                 F.bool_or("real").alias("real"))
    ring = next_ids(ids.filter("real").select(F.col("id").alias("doc_id"), "size"))
    wanted = ring.select(F.col("next_id").alias("id"), F.col("doc_id").alias("_for"), F.floor(F.col("size") / 3).cast("int").alias("_m"))
    heads = own.join(wanted, "id").select(F.col("_for").alias("id"), F.when(~F.col("none"), F.col("text").substr(F.lit(1), F.col("_m"))).alias("_head")) \
        .groupBy("id").agg(F.min("_head").alias("_head"))
    about = ids.select("id", "rows").join(ring.select(F.col("doc_id").alias("id"), "next_id"), "id", "left")
    third = F.floor(F.length("text") / 3).cast("int")
    return (own.join(about, "id").join(heads, "id", "left")
            .select("id", "none", "text", key.alias("text_key"), F.when(~F.col("none"), F.col("next_id")).alias("next_id"),
                    F.element_at("rows", key).alias("copies"),
                    F.concat(F.col("text").substr(F.lit(1), (F.length("text") - third).cast("int")),
                             F.when(~F.col("none") & F.col("_head").isNotNull(), F.col("_head").substr(F.lit(1), third)).otherwise(F.lit("")))
                    .alias("edited")))


def compare_with_edits(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness
    to one another and to the next document's."""
    rows = with_next(docs)
    keys = ["id", "text_key"]
    prints = fingerprints(rows, keys, ["text", "edited"], samples)
    meta = rows.select(*keys, "none", "next_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"))
    # written once: the sampling is the costly step, and the next document's
    # fingerprint is looked up in the same rows
    out = saved(meta.join(prints, keys, "left").select(
        "id", "none", "next_id", "n_chars", "edited_sha256", F.coalesce("f0", F.lit("")).alias("fingerprint"),
        F.coalesce("f1", F.lit("")).alias("edited_fingerprint")), "fingerprints")
    following = out.filter(~F.col("none")).groupBy("id").agg(F.min("fingerprint").alias("_next")).withColumnRenamed("id", "next_id")
    return out.join(following, "next_id", "left").select(
        F.when(~F.col("none"), F.col("id")).alias("doc_id"), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), samples).alias("near_edited"),
        likeness(F.col("fingerprint"), F.coalesce("_next", F.lit("")), samples).alias("near_next"))
