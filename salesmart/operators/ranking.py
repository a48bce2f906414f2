"""

``rank_desc`` equals SQL ``rank() OVER (PARTITION BY group ORDER BY col DESC)``:
rows with equal values share a rank, gaps follow, NULLs come last.

Two plans:

* ``groups_bounded=True``: one window partition per group. Use it only when a
  counted bound proves every group small (e.g. a (store, month) group of the
  sales-team mart holds each sales person at most once, so the size of the
  sales-team dimension bounds it).
* otherwise the distinct (group, value) pairs are counted first (partial sums,
  so a tie of any size is one row) and range-partitioned on (group, value
  desc). Sampled range bounds split a hot group over several partitions. Then

      rank = 1 + rows of the group with a larger value in the same partition
               + rows of the group in earlier partitions,

  where the last term comes from per-(partition, group) counts: at most one
  row per partition for each group, however hot. The ranks are joined back on
  (group, value); AQE can split a hot tie there. The range-partitioned frame is
  checkpointed (reliable, in the session's checkpoint folder), so both uses
  of its partition ids read the same materialized split, and a lost executor
  cannot re-sample different bounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.plans.joins import DEFAULT_BROADCAST_ROWS, bounded_broadcast
from salesmart.session import checkpoint_root

_PART, _GROUP, _LOCAL, _BEFORE, _COUNT, _PAIR = (
    "_rank_part", "_rank_group", "_rank_local", "_rank_before", "_rank_count", "_rank_pair")


def rank_desc(df: DataFrame, group: list[str], order_col: str, out: str = "rnk",
              groups_bounded: bool = True, partitions: int | None = None,
              max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``df`` plus ``out`` = ``rank()`` over ``group`` by ``order_col`` descending (int)."""
    if groups_bounded:
        w = Window.partitionBy(*group).orderBy(F.col(order_col).desc())
        return df.withColumn(out, F.rank().over(w))
    return _rank_split(df, group, order_col, out, partitions, max_rows)


def _rank_split(df: DataFrame, group: list[str], order_col: str, out: str,
                partitions: int | None, max_rows: int) -> DataFrame:
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    checkpoint_root(spark)
    # An explicit partition count keeps AQE from coalescing the range
    # partitions, so a partition id names one contiguous key range.
    # The group travels as one struct: struct equality treats NULL fields as
    # equal (a NULL group is a group of its own, as in a window), and it is a
    # plain equi-join key, so the join below reuses the window's partitioning.
    spread = (df.groupBy(*group, order_col).agg(F.count(F.lit(1)).alias(_COUNT))
              .repartitionByRange(n, *[F.col(c) for c in group], F.col(order_col).desc())
              .withColumn(_PART, F.spark_partition_id())
              .withColumn(_GROUP, F.struct(*[F.col(c) for c in group]))
              .checkpoint(eager=True))
    above = (Window.partitionBy(_PART, _GROUP).orderBy(F.col(order_col).desc())
             .rowsBetween(Window.unboundedPreceding, -1))
    local = spread.withColumn(_LOCAL, F.coalesce(F.sum(_COUNT).over(above), F.lit(0)))
    counts = spread.groupBy(_PART, _GROUP).agg(F.sum(_COUNT).alias("_n"))
    earlier = Window.partitionBy(_GROUP).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PART, _GROUP, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias(_BEFORE))
    # One row per (partition, group): broadcast when a count proves it small,
    # else a shuffled join that only moves the offsets.
    offsets, _ = bounded_broadcast(offsets, max_rows)
    pair = F.struct(*[F.col(c) for c in group], F.col(order_col)).alias(_PAIR)
    ranks = local.join(offsets, [_PART, _GROUP], "inner").select(
        pair, (F.col(_LOCAL) + F.col(_BEFORE) + 1).cast("int").alias(out))
    return df.select("*", pair).join(ranks, _PAIR, "inner").select(*df.columns, out)
