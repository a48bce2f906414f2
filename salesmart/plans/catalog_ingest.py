"""Registered queries of the file sources and the ingest gate.

Each query lands the whole star-derived sales table as CSV drops in a fresh
scratch folder (``plans.landing``) and runs the operator on those files.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from salesmart.operators import ingest as I
from salesmart.plans import oracle as O
from salesmart.plans.landing import land, star_sales_with_status, status_of
from salesmart.plans.registry import register
from salesmart.schemas import EXTRA_COLUMN, MANDATORY_COLUMNS
from salesmart.session import scratch_dir
from salesmart.sources.files import discover, read_discovered_lines, read_headers, read_sales_csv

_MAND = ", ".join(MANDATORY_COLUMNS)


@register("csv_scan", O.star_sql(f"SELECT {_MAND}, CAST(NULL AS VARCHAR) AS {EXTRA_COLUMN} FROM s_sales"))
def q_csv_scan(spark, d):
    """S1 + I7: the whole sales table written as CSV, read back typed."""
    root = scratch_dir(spark, "csv_scan")
    s = star_sales_with_status(spark, d).select(*MANDATORY_COLUMNS)
    s.write.mode("overwrite").option("header", "true").csv(root)
    back = read_sales_csv(spark, root)
    return back.select(*MANDATORY_COLUMNS, F.lit(None).cast("string").alias(EXTRA_COLUMN))


@register("file_discovery", O.star_sql(
    "SELECT o_orderstatus AS status, count(*) AS n_rows FROM s_sales GROUP BY 1"))
def q_file_discovery(spark, d):
    """S2 + S3: only ``*.csv`` files are found (``.txt`` and ``.csv.gz`` decoys
    hold clean rows too and would inflate the counts)."""
    root = land(spark, d, scratch_dir(spark, "file_discovery"))
    discover(spark, root)  # raises when nothing matches
    lines = read_discovered_lines(spark, root).select(F.col("_metadata.file_path").alias("file_path"), "value")
    data = lines.where(~F.col("value").startswith("customer_id,"))
    return data.groupBy(status_of().alias("status")).agg(F.count(F.lit(1)).alias("n_rows"))


@register("header_gate", O.star_sql("""
SELECT DISTINCT o_orderstatus AS status, o_orderstatus <> 'P' AS accepted,
       CASE o_orderstatus WHEN 'P' THEN 'store_id' ELSE '' END AS missing,
       CASE o_orderstatus WHEN 'O' THEN 'l_returnflag,l_linestatus'
                          WHEN 'P' THEN 'l_returnflag' ELSE '' END AS extras
FROM s_sales"""))
def q_header_gate(spark, d):
    """S4 + I1 + I4: per drop, accepted or not, missing and extra columns."""
    root = land(spark, d, scratch_dir(spark, "header_gate"))
    g = I.gate(read_headers(spark, root))
    return g.select(
        status_of().alias("status"), "accepted",
        F.concat_ws(",", "missing").alias("missing"),
        F.concat_ws(",", "extras").alias("extras"),
    ).distinct()


@register("quarantine", O.star_sql("""
SELECT o_orderstatus AS status, 'store_id' AS missing, count(*) AS n_rows
FROM s_sales WHERE o_orderstatus = 'P' GROUP BY 1"""))
def q_quarantine(spark, d):
    """Every line of the rejected files is copied under the error root."""
    base = scratch_dir(spark, "quarantine")
    root = land(spark, d, base)
    gated = I.gate(read_headers(spark, root))
    manifest = I.quarantine(spark, gated, f"{base}/error")
    rows = spark.read.text(f"{base}/error/rows")
    data = rows.where(~F.col("value").startswith("customer_id,"))
    joined = data.join(manifest.select("source_id", "file_path", "missing"), "source_id")
    return joined.groupBy(status_of().alias("status"),
                          F.concat_ws(",", "missing").alias("missing")).agg(
        F.count(F.lit(1)).alias("n_rows"))


@register("extra_columns", O.star_sql(f"""
SELECT {_MAND},
       CASE WHEN o_orderstatus = 'O' THEN concat_ws(',', l_returnflag, l_linestatus) END AS {EXTRA_COLUMN}
FROM s_sales WHERE o_orderstatus <> 'P'"""))
def q_extra_columns(spark, d):
    """Accepted files in canonical columns, extras folded."""
    root = land(spark, d, scratch_dir(spark, "extra_columns"))
    sales, _ = I.ingest(spark, root)
    return sales


@register("union_all_files", O.star_sql(f"""
SELECT {_MAND}, CAST(NULL AS VARCHAR) AS {EXTRA_COLUMN} FROM s_sales WHERE o_orderstatus = 'F'
UNION ALL
SELECT {_MAND}, CAST(NULL AS VARCHAR) AS {EXTRA_COLUMN} FROM s_sales WHERE o_orderstatus = 'F'
UNION ALL
SELECT {_MAND}, concat_ws(',', l_returnflag, l_linestatus) FROM s_sales WHERE o_orderstatus = 'O'"""))
def q_union_all_files(spark, d):
    """S6 + I8: bag union over signature groups; a copied drop doubles its rows."""
    base = scratch_dir(spark, "union_all_files")
    root = land(spark, d, base, duplicate_clean=True)
    sales, _ = I.ingest(spark, root, error_root=f"{base}/error")
    return sales


@register("odd_headers", O.star_sql(f"""
SELECT {_MAND}, concat_ws(',', l_returnflag, l_linestatus, o_orderstatus) AS {EXTRA_COLUMN} FROM s_sales"""))
def q_odd_headers(spark, d):
    """S4 + I4 + I5: extra columns whose names hold a comma, a dot and a
    backtick; the header quotes the first."""
    root = scratch_dir(spark, "odd_headers")
    s = star_sales_with_status(spark, d)
    s.select(*MANDATORY_COLUMNS, F.col("l_returnflag").alias("return,flag"), F.col("l_linestatus").alias("line.status"),
             F.col("o_orderstatus").alias("order`status")).write.option("header", "true").csv(root)
    sales, _ = I.ingest(spark, root)
    return sales
