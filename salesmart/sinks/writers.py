"""

Writers are plain ``DataFrameWriter`` calls with the options set per write
(never on the session). Every writer refuses to overwrite a path the frame
itself reads from: Spark would delete the input before reading it.
"""

from __future__ import annotations

import time
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.sources.paths import children, comparable

# The partition layout of the sales-team mart.
SALES_MART_PARTITIONS = ("sales_month", "store_id")


class SelfOverwrite(ValueError):
    """The target path is an input of the frame being written."""


def guard_not_input(df: DataFrame, path: str) -> None:
    target = comparable(path)
    for f in df.inputFiles():
        f = comparable(unquote(f))
        if f.startswith(target + "/") or f == target:
            raise SelfOverwrite(f"refusing to write {path}: it is read by this frame ({f})")


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K1: flat Parquet dataset."""
    if mode == "overwrite":
        guard_not_input(df, path)
    df.write.mode(mode).parquet(path)


def write_partitioned(df: DataFrame, path: str, partition_cols=SALES_MART_PARTITIONS) -> None:
    """K2: Hive-partitioned Parquet with dynamic partition overwrite: only the
    partitions present in ``df`` are replaced, so a rerun of a batch is
    idempotent and other months stay. Use a root that is not nested in a flat
    dataset's root.

    A ``rebalance`` hint on the partition columns first clusters each folder's
    rows into few tasks (few files per folder instead of one per task), while
    AQE still splits an oversized (hot) folder across several tasks.
    """
    guard_not_input(df, path)
    (df.hint("rebalance", *partition_cols)
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_cols).parquet(path))


def write_format(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                 header: bool = True, partition_by: tuple[str, ...] = (), **options) -> None:
    """K3: generic file writer (any built-in format, optional partition
    columns); errors propagate."""
    if mode == "overwrite":
        guard_not_input(df, path)
    w = df.write.format(fmt).mode(mode)
    if fmt == "csv":
        w = w.option("header", str(header).lower())
    for k, v in options.items():
        w = w.option(k, v)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_sales_report(mart: DataFrame, path: str) -> None:
    """K5: the sales-team mart as a CSV report with header, one folder per
    month (dynamic overwrite: a rerun replaces only its months)."""
    write_format(mart, path, "csv", partition_by=("sales_month",), partitionOverwriteMode="dynamic")


def publish_version(df: DataFrame, root: str, run_ts: int | None = None) -> int:
    """Write ``df`` as a new version ``root/run_ts=<epoch ms>``; earlier
    versions stay. Returns the version stamp."""
    ts = int(time.time() * 1000) if run_ts is None else int(run_ts)
    guard_not_input(df, root)
    (df.withColumn("run_ts", F.lit(ts).cast("bigint"))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("run_ts").parquet(root))
    return ts


def read_latest(spark: SparkSession, root: str) -> DataFrame:
    """The newest published version. It is found by the folder names, so
    only its own files are listed and opened."""
    versions = [int(n[len("run_ts="):]) for n in children(spark, root) if n.startswith("run_ts=")]
    if not versions:
        raise FileNotFoundError(f"no version under {root}")
    return spark.read.parquet(f"{root.rstrip('/')}/run_ts={max(versions)}")


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              column: str | None = None, lower: int | None = None, upper: int | None = None,
              num_partitions: int | None = None) -> DataFrame:
    """JDBC table scan; with ``column``/bounds it reads in parallel ranges."""
    props = dict(properties or {})
    if column is not None:
        return spark.read.jdbc(url, table, column=column, lowerBound=lower, upperBound=upper,
                               numPartitions=num_partitions, properties=props)
    return spark.read.jdbc(url, table, properties=props)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               mode: str = "append", batchsize: int = 10_000, num_partitions: int | None = None) -> None:
    """K4: JDBC write; failures raise (the caller must not mark files done)."""
    props = dict(properties or {})
    props.setdefault("batchsize", str(batchsize))
    if num_partitions:
        props.setdefault("numPartitions", str(num_partitions))
    df.write.jdbc(url, table, mode=mode, properties=props)
