"""Land star-derived sales as CSV drops, the input shape of the ingest path.

The registered ingest queries write the whole sales table as CSV files under a
fresh scratch root (the session's checkpoint folder), sliced by order status:

* ``F`` rows: the 8 mandatory columns (clean files);
* ``O`` rows: the 8 columns plus ``l_returnflag`` and ``l_linestatus`` (extras);
* ``P`` rows: without ``store_id`` and with one extra (rejected by the gate);
* decoys that discovery must skip: ``F`` rows as ``.txt`` and as ``.csv.gz``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.schemas import EXTRA_COLUMN, MANDATORY_COLUMNS
from salesmart.sources.star import sales_from_star

CLEAN, EXTRA, MISSING = "F", "O", "P"
EXTRA_COLS = ("l_returnflag", "l_linestatus")


def star_sales_with_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_from_star(spark, sf_dir, keep=EXTRA_COLS + ("o_orderstatus",))


def _write_csv(df: DataFrame, path: str, compression: str | None = None) -> None:
    w = df.write.mode("overwrite").option("header", "true")
    if compression:
        w = w.option("compression", compression)
    w.csv(path)


def saved_sales(spark: SparkSession, sf_dir: str, root: str, statuses: tuple[str, ...] = (CLEAN, EXTRA, MISSING)) -> DataFrame:
    """The star-derived sales of ``statuses``, joined once and kept under
    ``root`` by status, so that each drop is written from its own rows."""
    s = star_sales_with_status(spark, sf_dir).drop(EXTRA_COLUMN).where(F.col("o_orderstatus").isin(*statuses))
    path = f"{root}/star"
    s.write.mode("overwrite").option("compression", "zstd").partitionBy("o_orderstatus").parquet(path)
    return spark.read.schema(s.schema).parquet(path)


def land(spark: SparkSession, sf_dir: str, root: str, decoys: bool = True,
         duplicate_clean: bool = False, statuses: tuple[str, ...] = (CLEAN, EXTRA, MISSING),
         sales: DataFrame | None = None) -> str:
    """Write the drops of ``statuses`` under ``root`` and return the drop
    folder. ``sales``: rows of ``saved_sales``, for callers that land twice."""
    s = sales if sales is not None else saved_sales(spark, sf_dir, root, tuple({*statuses, CLEAN} if decoys or duplicate_clean else statuses))
    status = F.col("o_orderstatus")
    mand = list(MANDATORY_COLUMNS)
    clean = s.where(status == CLEAN).select(*mand)
    if CLEAN in statuses:
        _write_csv(clean, f"{root}/drop/status={CLEAN}")
    if duplicate_clean:
        _write_csv(clean, f"{root}/drop/copy/status={CLEAN}")
    if EXTRA in statuses:
        _write_csv(s.where(status == EXTRA).select(*mand, *EXTRA_COLS), f"{root}/drop/status={EXTRA}")
    if MISSING in statuses:
        _write_csv(s.where(status == MISSING).select(*[c for c in mand if c != "store_id"], "l_returnflag"),
                   f"{root}/drop/status={MISSING}")
    if decoys:
        clean.select(F.concat_ws(",", *[F.col(c).cast("string") for c in mand]).alias("value")) \
            .write.mode("overwrite").text(f"{root}/drop/decoy_txt")
        _write_csv(clean, f"{root}/drop/decoy_gz", compression="gzip")
    return f"{root}/drop"


STATUS_OF_PATH = r"status=([A-Z])"


def status_of(path_col: str = "file_path"):
    return F.regexp_extract(F.col(path_col), STATUS_OF_PATH, 1)
