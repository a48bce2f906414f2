"""Range-split rank equals the window rank, also for a hot group spread over
many range partitions, with ties, NULL values and a NULL group."""

from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salesmart.operators.ranking import rank_desc


def _ranks(df):
    return sorted(tuple(r) for r in df.select("id", "g1", "g2", "v", "rnk").collect())


def _frame(spark, rows):
    rows = [(i, g1, g2, None if v is None else Decimal(v)) for i, g1, g2, v in rows]
    return spark.createDataFrame(rows, "id long, g1 long, g2 string, v decimal(18,2)")


def test_hot_group_over_many_partitions(spark):
    # group (1, 'm') holds 3,000 of 3,400 rows; values repeat (ties), some NULL
    rows = [(i, 1, "m", None if i % 97 == 0 else (i * 7919) % 250) for i in range(3000)]
    rows += [(3000 + i, i % 20, "n", i % 13) for i in range(380)]
    rows += [(4000 + i, None, None, i % 3) for i in range(20)]
    df = _frame(spark, rows)
    split = rank_desc(df, ["g1", "g2"], "v", groups_bounded=False, partitions=16)
    window = rank_desc(df, ["g1", "g2"], "v", groups_bounded=True)
    assert _ranks(split) == _ranks(window)
    # the hot group really was spread: more than one range partition holds it
    spread = (df.repartitionByRange(16, "g1", "g2", F.col("v").desc())
              .where("g1 = 1 AND g2 = 'm'").select(F.spark_partition_id().alias("p")).distinct().count())
    assert spread > 4


def test_plan_keeps_hot_group_out_of_one_window_partition(spark):
    df = _frame(spark, [(i, 1, "m", i % 50) for i in range(500)])
    text = rank_desc(df, ["g1", "g2"], "v", groups_bounded=False, partitions=8)._jdf.queryExecution() \
        .executedPlan().toString()
    # the row-level window is partitioned by (range partition id, group), not by the group alone
    assert "_rank_part" in text


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.one_of(st.none(), st.integers(0, 6))), min_size=1, max_size=60),
       st.integers(1, 7))
def test_split_rank_property(spark, pairs, parts):
    rows = [(i, g, "x", v) for i, (g, v) in enumerate(pairs)]
    df = _frame(spark, rows)
    split = rank_desc(df, ["g1", "g2"], "v", groups_bounded=False, partitions=parts)
    expected = {}
    for i, g, _, v in rows:
        greater = sum(1 for _, g2, _, v2 in rows
                      if g2 == g and v2 is not None and (v is None or v2 > v))
        expected[i] = 1 + greater
    assert {r.id: r.rnk for r in split.select("id", "rnk").collect()} == expected


def test_split_rank_with_shuffled_offsets(spark):
    """max_rows=0: the offsets are not broadcast; the struct-keyed sort-merge
    join reuses the window's partitioning and gives the same ranks."""
    rows = [(i, i % 3, "m" if i % 5 else None, None if i % 41 == 0 else (i * 31) % 17) for i in range(600)]
    df = _frame(spark, rows)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        split = rank_desc(df, ["g1", "g2"], "v", groups_bounded=False, partitions=6, max_rows=0)
        plan = split._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
        assert _ranks(split) == _ranks(rank_desc(df, ["g1", "g2"], "v", groups_bounded=True))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
