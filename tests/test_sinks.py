import pytest
from pyspark.sql import functions as F

from salesmart.sinks import writers as W


def test_refuses_to_overwrite_its_own_input(spark, tmpdir_str):
    p = f"{tmpdir_str}/t"
    spark.range(10).write.parquet(p)
    df = spark.read.parquet(p)
    with pytest.raises(W.SelfOverwrite):
        W.write_parquet(df, p)
    assert spark.read.parquet(p).count() == 10


def test_dynamic_overwrite_keeps_other_partitions(spark, tmpdir_str):
    p = f"{tmpdir_str}/m"
    df = spark.range(20).select(F.col("id"), (F.col("id") % 2).alias("sales_month"), F.lit(1).alias("store_id"))
    W.write_partitioned(df, p)
    W.write_partitioned(df.where("sales_month = 0").withColumn("id", F.col("id") + 100), p)
    back = spark.read.parquet(p)
    assert back.where("sales_month = 1").count() == 10
    assert back.where("sales_month = 0").agg(F.min("id")).first()[0] == 100


def test_versions_latest_wins(spark, tmpdir_str):
    root = f"{tmpdir_str}/v"
    W.publish_version(spark.range(3), root, run_ts=1)
    W.publish_version(spark.range(5), root, run_ts=2)
    assert W.read_latest(spark, root).count() == 5
    assert spark.read.parquet(root).count() == 8


def test_jdbc_failures_raise(spark):
    """A failing JDBC write or read raises (the reference's writer
    swallowed errors). The URL names no installed driver, so no database is
    opened."""
    from salesmart.sinks import writers as W
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    with pytest.raises(Exception, match="(?i)suitable driver|driver"):
        W.write_jdbc(df, "jdbc:nosuchdb://nowhere/db", "t")
    with pytest.raises(Exception, match="(?i)suitable driver|driver"):
        W.read_jdbc(spark, "jdbc:nosuchdb://nowhere/db", "t", column="id", lower=0, upper=10,
                    num_partitions=2).collect()
