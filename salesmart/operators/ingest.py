"""

Flow: ``read_headers`` (one pass) → ``gate`` (missing / extra columns per
file) → ``quarantine`` rejected files → ``load_accepted``: one typed CSV read
per distinct header signature, extras folded into ``additional_column``,
signature groups united by name (bag semantics: duplicate rows stay).

Only file metadata (paths grouped by header) reaches the driver, as it does
for any Spark file scan; rows never do.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.functions.columns import fold_extras
from salesmart.plans.joins import union_all
from salesmart.schemas import EXTRA_COLUMN, MANDATORY_COLUMNS
from salesmart.sources.files import empty_sales, read_headers, read_sales_csv, reader_names
from salesmart.sources.paths import for_reader, plain


class NoAcceptedFiles(RuntimeError):
    """No file passed the mandatory-column gate."""


def gate(headers: DataFrame, mandatory: tuple[str, ...] = MANDATORY_COLUMNS) -> DataFrame:
    """I1 + I4: ``file_path, header, missing, extras, accepted`` per file.

    ``missing = mandatory − header`` and ``extras = header − mandatory`` are
    case-sensitive and order-free; extras keep header order.
    """
    m = F.array(*[F.lit(c) for c in mandatory])
    return headers.select(
        "file_path",
        "header",
        F.array_except(m, F.col("header")).alias("missing"),
        F.array_except(F.col("header"), m).alias("extras"),
    ).withColumn("accepted", F.size("missing") == 0)


def rejected(gated: DataFrame) -> DataFrame:
    """``file_path, missing`` of the files that fail the gate."""
    return gated.where(~F.col("accepted")).select("file_path", "missing")


def quarantine(spark: SparkSession, gated: DataFrame, error_root: str) -> DataFrame:
    """Copy every line of each rejected file under ``error_root``.

    ``error_root/rows/source_id=<hash>/`` holds the lines of one file (gzip,
    which Spark's text reader reads as is), ``error_root/manifest`` maps ``source_id`` to path and missing columns.
    Both are written with dynamic partition overwrite, so a rerun replaces a
    file's quarantine copy instead of doubling it. Sources stay in place; the
    streaming ingest archives them. Returns the manifest rows written.
    """
    bad = rejected(gated).withColumn("source_id", F.xxhash64("file_path"))
    paths = [r.file_path for r in bad.select("file_path").collect()]
    if not paths:
        return bad.limit(0)
    (bad.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("source_id").parquet(f"{error_root}/manifest"))
    lines = spark.read.text([for_reader(p) for p in paths]).select(
        "value", F.xxhash64(plain(F.col("_metadata.file_path"))).alias("source_id"))
    (lines.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .option("compression", "gzip").partitionBy("source_id").text(f"{error_root}/rows"))
    return spark.read.parquet(f"{error_root}/manifest")


@dataclass(frozen=True)
class SignatureGroup:
    header: tuple[str, ...]
    extras: tuple[str, ...]
    paths: tuple[str, ...]


# Hash buckets per header signature when gathering paths.
PATH_BUCKETS = 64


def accepted_groups(gated: DataFrame) -> list[SignatureGroup]:
    """Header signatures of the accepted files, each with its sorted path list.

    A file reader needs its paths on the driver, as Spark's own file listing
    does. One job gathers them grouped by (signature, hash bucket of the path):
    each header travels once per group, and no task gathers all paths of one
    signature (a per-partition ``toLocalIterator`` would run one job per input
    split instead).
    """
    rows = (gated.where("accepted")
            .groupBy("header", "extras", F.pmod(F.xxhash64("file_path"), F.lit(PATH_BUCKETS)).alias("_b"))
            .agg(F.collect_list("file_path").alias("paths"))
            .collect())
    groups: dict[tuple, list[str]] = {}
    for r in rows:
        groups.setdefault((tuple(r.header), tuple(r.extras)), []).extend(r.paths)
    return [SignatureGroup(h, e, tuple(sorted(p))) for (h, e), p in sorted(groups.items())]


#: The raw line of a row with a value that does not fit its column's type.
BAD = "_bad_row"


def load_accepted(spark: SparkSession, gated: DataFrame, with_source: bool = False, with_bad: bool = False) -> DataFrame:
    """The union of all accepted files in canonical columns. With
    ``with_bad`` column ``BAD`` holds the raw line of rows with unparsable
    values (which are NULL in their columns).

    Extras are folded with ``concat_ws(',')`` in header order (NULL parts
    skipped, so all-NULL extras give ''); a file without extras gets NULL.
    """
    groups = accepted_groups(gated)
    if not groups:
        raise NoAcceptedFiles("No data available with correct files")
    seed = empty_sales(spark)
    if with_source:
        seed = seed.withColumn("source_file", F.lit(None).cast("string"))
    if with_bad:
        seed = seed.withColumn(BAD, F.lit(None).cast("string"))
    frames = [seed]
    for g in groups:
        df = read_sales_csv(spark, [for_reader(p) for p in g.paths], list(g.header), with_source=with_source,
                            bad=BAD if with_bad else None)
        read_as = dict(zip(g.header, reader_names(list(g.header))))
        cols = [F.col(read_as[c]).alias(c) for c in MANDATORY_COLUMNS]
        cols.append(fold_extras([read_as[c] for c in g.extras]).alias(EXTRA_COLUMN))
        if with_source:
            cols.append(F.col("source_file"))
        if with_bad:
            cols.append(F.col(BAD))
        frames.append(df.select(*cols))
    return union_all(frames)


def write_bad_rows(spark: SparkSession, gated: DataFrame, path: str, run_id: str) -> None:
    """Rows of accepted files with unparsable values: source file, raw line
    and what could be read, one folder per run (a rerun replaces it)."""
    rows = load_accepted(spark, gated, with_source=True, with_bad=True).where(F.col(BAD).isNotNull())
    (rows.withColumnRenamed(BAD, "line").withColumn("run_id", F.lit(run_id))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path))


def ingest(spark: SparkSession, root: str | list[str], error_root: str | None = None,
           with_source: bool = False) -> tuple[DataFrame, DataFrame]:
    """Gate every CSV under ``root``, quarantine the rejects (if ``error_root``),
    return (accepted sales union, gate result).

    The gate result is cached while it is used here and released before
    returning; the sales union refers to file paths only, not to it."""
    gated = gate(read_headers(spark, root)).cache()
    try:
        if error_root is not None:
            quarantine(spark, gated, error_root)
        sales = load_accepted(spark, gated, with_source=with_source)
    finally:
        gated.unpersist()
    return sales, gated
