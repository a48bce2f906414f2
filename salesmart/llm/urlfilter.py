"""URL filters by a sort-merge range join, in DataFrame operations only.

A rule (host, path, verdict) fits a URL if the URL's host is the rule's host
or a subdomain of it and the URL's path starts with the rule's path; the rule
with the longest host and path together wins (then the longer host).

Reversed hosts ("com.example.www.") put a host before all its subdomains, so
a rule's canonical key (reversed host + path) is a prefix, that is an interval
of the sorted keys. A URL stands in the order once per enclosing host that
has rules. Rules and distinct URLs are sorted together by ranges; within a
range a running window keeps the last rule that was opened, whose stack of
enclosing rules on the same host is carried with it, and the innermost one
still open at the URL is the longest that fits. Ranges take over the last
rule of the ranges before them. Nested intervals make this exact: a rule that
is open at a URL encloses every rule opened after it and still open.

URLs are reduced to distinct (host, path) pairs before the sort, so one hot
URL costs one row; the final join back is on (host, path). A NULL URL or one
without "://" has an empty host and path and fits no rule. Repeated pages get
a row each. Rules with an empty or NULL host fit nothing; of several rules
with one key the verdict that sorts first ("allow") holds. Empty tables give
empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesmart.llm.common import saved

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DEFAULT = "allow"


def url_parts(url: str) -> tuple[Column, Column]:
    """(host, path) of a URL column."""
    u = F.coalesce(F.col(url).cast("string"), F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, u.substr(at + 3, F.length(u))).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    return F.translate(raw, UPPER, LOWER), F.regexp_extract(rest.substr(F.length(raw) + 1, F.length(rest) + 1), "^[^?#]*", 0)


def reversed_host(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """A table of (host, path, verdict) literals."""
    rows = F.array(*[F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in rules])
    return spark.range(1).select(F.inline(rows))


def stacked_rules(rules: DataFrame) -> DataFrame:
    """``key, owner, stack``: per rule key (owner: its reversed host) the
    enclosing rules of the same host and itself, outermost first."""
    own = rules.select(F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict") \
        .filter("host <> ''").groupBy("host", "path").agg(F.min("verdict").alias("verdict")) \
        .withColumn("owner", reversed_host(F.col("host"))).withColumn("key", F.concat("owner", "path"))
    # a rule's enclosing rules are those whose path is a beginning of its own
    outer = own.select("key", "owner", F.explode(F.transform(F.sequence(F.lit(0), F.length("path")),
                                                             lambda n: F.col("path").substr(F.lit(1), n))).alias("path"))
    member = own.select("owner", "path", F.struct(
        F.length("key").alias("size"), F.col("key").alias("at"), F.concat("host", "path").alias("rule"), "verdict",
        (F.length("host") + F.length("path")).alias("total"), F.length("host").alias("host_size")).alias("rule"))
    return outer.join(member, ["owner", "path"]).groupBy("key", "owner").agg(F.array_sort(F.collect_list("rule")).alias("stack"))


def sweep(events: DataFrame) -> DataFrame:
    """Rows of ``events`` without a stack, each with the stack of the last
    rule at or before its key. Columns: ``key``, ``stack`` (NULL for URLs)
    and others."""
    spark = events.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    # written once, so that every use sees the same range numbers
    dealt = saved(events.repartitionByRange(parts, "key").withColumn("_range", F.spark_partition_id()), "sweep")
    inside = Window.partitionBy("_range").orderBy("key", F.col("stack").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)      # one row per range
    carried = dealt.groupBy("_range").agg(F.max_by("stack", F.when(F.col("stack").isNotNull(), F.col("key"))).alias("_end")) \
        .select("_range", F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    seen = dealt.withColumn("_open", F.last("stack", ignorenulls=True).over(inside)).filter("stack is null")
    return seen.join(carried, "_range").withColumn("stack", F.coalesce("_open", "_carried")).drop("_open", "_carried", "_range")


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict``; ``default`` is the verdict
    where no rule fits."""
    new = {"host", "path", "rule", "verdict"}
    host, path = url_parts(url)
    kept = [c for c in pages.columns if c.lower() not in new]
    own = pages.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"), host.alias("host"), path.alias("path"))
    stacks = stacked_rules(rules)
    owners = stacks.select("owner").distinct()
    labels = F.reverse(F.split("host", r"\."))
    enclosing = F.transform(F.sequence(F.lit(1), F.size(labels)),
                            lambda n: F.concat(F.array_join(F.slice(labels, F.lit(1), n), "."), F.lit(".")))
    urls = own.groupBy("host", "path").agg(F.count(F.lit(1)).alias("_n")).filter("host <> ''") \
        .select("host", "path", F.explode(enclosing).alias("owner")).join(owners, "owner") \
        .select(F.concat("owner", "path").alias("key"), "host", "path", F.lit(None).cast(stacks.schema["stack"].dataType).alias("stack"))
    opened = stacks.select("key", F.lit(None).cast("string").alias("host"), F.lit(None).cast("string").alias("path"), "stack")
    found = sweep(urls.unionByName(opened))
    fits = F.element_at(F.filter("stack", lambda r: F.startswith(F.col("key"), r["at"])), -1)
    best = found.withColumn("_fit", F.when(F.size(F.filter("stack", lambda r: F.startswith(F.col("key"), r["at"]))) > 0, fits)) \
        .filter("_fit is not null") \
        .groupBy("host", "path").agg(F.max(F.struct("_fit.total", "_fit.host_size", "_fit.rule", "_fit.verdict")).alias("_best"))
    return own.join(best, ["host", "path"], "left").select(
        "_row.*", "host", "path", F.col("_best.rule").alias("rule"),
        F.coalesce("_best.verdict", F.lit(default)).alias("verdict"))
