
from decimal import Decimal

from pyspark.sql import functions as F

from inputs import SF_SMALL
from salesmart.operators import enrich as E
from salesmart.operators import marts as M
from salesmart.sources.star import star_inputs


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_aggregate_first_equals_row_form(spark):
    s, c, st, t = star_inputs(spark, SF_SMALL)
    enriched = E.enrich(s, c, st, t)
    assert _rows(M.sales_team_mart(s, c, st, t)) == _rows(M.sales_team_mart_from_rows(M.sales_mart_rows(enriched)))
    assert _rows(M.customer_mart(s, c, st, t)) == _rows(M.customer_monthly_window(M.customer_mart_rows(enriched)))


def test_shuffle_path_equals_broadcast_path(spark):
    s, c, st, t = star_inputs(spark, SF_SMALL)
    assert _rows(M.sales_team_mart(s, c, st, t)) == _rows(M.sales_team_mart(s, c, st, t, max_rows=0))
    assert _rows(M.customer_mart(s, c, st, t)) == _rows(M.customer_mart(s, c, st, t, max_rows=0))


def test_partitioning_and_order_do_not_change_marts(spark):
    s, c, st, t = star_inputs(spark, SF_SMALL)
    base = _rows(M.sales_team_mart(s, c, st, t))
    shuffled = s.repartition(13, F.rand(seed=7)).orderBy(F.rand(seed=3))
    assert _rows(M.sales_team_mart(shuffled, c, st, t)) == base


def test_totals_conserved_and_leaders_exist(spark):
    s, c, st, t = star_inputs(spark, SF_SMALL)
    joined_total = E.enrich(s, c, st, t).agg(F.sum("total_cost")).first()[0]
    mart = M.sales_team_mart(s, c, st, t)
    assert mart.agg(F.sum("total_sales")).first()[0] == joined_total
    assert M.customer_mart(s, c, st, t).agg(F.sum("total_sales")).first()[0] == joined_total
    per_group = mart.groupBy("store_id", "sales_month").agg(
        F.sum((F.col("incentive") > 0).cast("int")).alias("leaders"),
        F.max("total_sales").alias("top"))
    assert per_group.where("leaders < 1").count() == 0
    paid = mart.where("incentive > 0").join(per_group, ["store_id", "sales_month"])
    assert paid.where("total_sales <> top").count() == 0
    for r in mart.where("incentive > 0").limit(50).collect():
        assert r.incentive == (r.total_sales * Decimal("0.01")).quantize(Decimal("0.01"), "ROUND_HALF_UP")


def test_parts_of_split_runs_merge_to_the_whole_mart(spark):
    """Three 'runs' that each hold part of every month: merging their parts
    gives the marts of all rows at once (totals and ranks whole)."""
    s, c, st, t = star_inputs(spark, SF_SMALL)
    enriched = E.enrich(s, c, st, t)
    runs = [enriched.where(F.abs(F.hash("customer_id", "sales_person_id", "total_cost")) % 3 == k)
            for k in range(3)]
    parts = M.both_parts(runs[0])
    for r in runs[1:]:
        parts = parts.unionByName(M.both_parts(r))
    sp = M.merge_parts(parts.where("mart = 'sales'"), M.SALES_KEYS)
    cp = M.merge_parts(parts.where("mart = 'customer'"), M.CUSTOMER_KEYS)
    whole_s = M.sales_team_mart_from_rows(M.sales_mart_rows(enriched), groups_bounded=True)
    assert _rows(M.sales_team_mart_from_parts(sp, t, groups_bounded=True)) == _rows(whole_s)
    assert _rows(M.sales_team_mart_from_parts(sp, t, groups_bounded=False)) == _rows(whole_s)
    assert _rows(M.customer_mart_from_parts(cp, c)) == _rows(M.customer_monthly_window(M.customer_mart_rows(enriched)))


def test_row_form_window_runs_over_aggregated_rows(spark):
    s, c, st, t = star_inputs(spark, SF_SMALL)
    df = M.customer_monthly_window(M.customer_mart_rows(E.enrich(s, c, st, t)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    # the Window's input is the final HashAggregate, not the joined sale rows
    window_at = plan.index("Window")
    assert "HashAggregate" in plan[window_at:]
    assert plan[window_at:].index("HashAggregate") < plan[window_at:].index("BroadcastHashJoin")
