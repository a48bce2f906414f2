"""Registered queries of the sinks (K1–K3, K5, L6): write, read back, compare.

JDBC (S5, K4) is implemented in ``salesmart.sinks.writers`` but has no
registered query: it needs a database, and none is started here.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from salesmart.operators import enrich as E
from salesmart.operators import marts as M
from salesmart.plans import oracle as O
from salesmart.plans.landing import star_sales_with_status
from salesmart.plans.registry import register
from salesmart.schemas import SALES_MART
from salesmart.session import scratch_dir
from salesmart.sinks import writers as W
from salesmart.sources.star import customer_dim, sales_team_dim, star_inputs, store_dim


@register("parquet_roundtrip", O.star_sql("SELECT * FROM cmart", O.CUSTOMER_MART_SELECT))
def q_parquet_roundtrip(spark, d):
    """K1: customer mart written as flat Parquet and read back."""
    path = scratch_dir(spark, "parquet_roundtrip")
    W.write_parquet(M.customer_mart(*star_inputs(spark, d)), path)
    return spark.read.parquet(path)


@register("partitioned_roundtrip", O.star_sql("SELECT * FROM mart", O.SALES_MART_SELECT))
def q_partitioned_roundtrip(spark, d):
    """K2: sales-mart rows written Hive-partitioned by (sales_month, store_id);
    the sales-team mart is then computed from the partitioned copy."""
    path = scratch_dir(spark, "partitioned_roundtrip")
    enriched, small = E.enrich_with_bounds(*star_inputs(spark, d), order=E.FOR_SALES_TEAM)
    rows = M.sales_mart_rows(enriched)
    W.write_partitioned(rows, path)
    back = (spark.read.option("basePath", path).parquet(path)
            .withColumn("store_id", F.col("store_id").cast("bigint"))
            .withColumn("sales_month", F.col("sales_month").cast("string")))
    return M.sales_team_mart_from_rows(back, groups_bounded=small["sales_team"])


@register("csv_report_roundtrip", O.star_sql("SELECT * FROM mart", O.SALES_MART_SELECT))
def q_csv_report_roundtrip(spark, d):
    """K3 + K5: the sales-team mart as a CSV report (one folder per month),
    read back with the mart schema."""
    path = scratch_dir(spark, "csv_report")
    W.write_sales_report(M.sales_team_mart(*star_inputs(spark, d)), path)
    back = spark.read.schema(SALES_MART).option("header", "true").csv(path)
    return back.select(*[f.name for f in SALES_MART.fields])


@register("versioned_publish", O.star_sql("SELECT * FROM cmart", O.CUSTOMER_MART_SELECT))
def q_versioned_publish(spark, d):
    """Publish an early version (finished orders only), then the full
    mart; readers get the newest version."""
    root = scratch_dir(spark, "versioned_publish")
    s = star_sales_with_status(spark, d)
    c, st, t = customer_dim(spark, d), store_dim(spark, d), sales_team_dim(spark, d)
    early = M.customer_mart(s.where(F.col("o_orderstatus") == "F"), c, st, t)
    v1 = W.publish_version(early, root, run_ts=1)
    W.publish_version(M.customer_mart(s, c, st, t), root, run_ts=v1 + 1)
    return W.read_latest(spark, root)
