"""Registered queries of the join, projection and mart operators.

Every query reads the driver's tables in full (or data Spark derives from
them); nothing is sampled, capped or filtered to a subset.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from salesmart.functions.columns import full_name, money_sum, month_of, month_start
from salesmart.operators import enrich as E
from salesmart.operators import marts as M
from salesmart.plans import oracle as O
from salesmart.plans.registry import register
from salesmart.sources.star import customer_dim, sales_from_star, star_inputs


def _rows_and_team_bound(spark, d):
    """Sales-mart rows of the enriched sales, and whether the sales-team
    dimension is proven small (which bounds every (store, month) rank group)."""
    enriched, small = E.enrich_with_bounds(*star_inputs(spark, d), order=E.FOR_SALES_TEAM)
    return M.sales_mart_rows(enriched), small["sales_team"]


# ------------------------------------------------------------------ joins J1–J4

@register("join_customer", O.star_sql("""
SELECT s.customer_id, s.store_id, s.sales_date, s.sales_person_id, s.total_cost,
       c.first_name, c.last_name, c.address, c.pincode, c.phone_number
FROM s_sales s JOIN d_customer c ON s.customer_id = c.customer_id"""))
def q_join_customer(spark, d):
    s, c, _, _ = star_inputs(spark, d)
    return E.join_customer(s, c)


@register("join_store", O.star_sql("""
SELECT s.customer_id, s.store_id, s.sales_date, s.sales_person_id, s.total_cost,
       st.address AS store_address, st.store_manager_name
FROM s_sales s JOIN d_store st ON s.store_id = st.id"""))
def q_join_store(spark, d):
    s, _, st, _ = star_inputs(spark, d)
    base = s.select("customer_id", "store_id", "sales_date", "sales_person_id", "total_cost")
    return E.join_store(base, st)


@register("join_sales_team", O.star_sql("""
SELECT s.customer_id, s.store_id, s.sales_date, s.sales_person_id, s.total_cost,
       t.first_name AS sales_person_first_name, t.last_name AS sales_person_last_name,
       t.address AS sales_person_address, t.pincode AS sales_person_pincode,
       t.manager_id, t.is_manager
FROM s_sales s JOIN d_team t ON s.sales_person_id = t.id"""))
def q_join_sales_team(spark, d):
    s, _, _, t = star_inputs(spark, d)
    base = s.select("customer_id", "store_id", "sales_date", "sales_person_id", "total_cost")
    return E.join_sales_team(base, t)


@register("enriched_sales", O.star_sql("SELECT * FROM enriched"))
def q_enriched(spark, d):
    return E.enrich(*star_inputs(spark, d))


# ------------------------------------------------------------ projections P3–P5

@register("customer_mart_rows", O.star_sql("""
SELECT customer_id, first_name, last_name, address, pincode, phone_number, sales_date, total_cost
FROM enriched"""))
def q_customer_mart_rows(spark, d):
    return M.customer_mart_rows(E.enrich(*star_inputs(spark, d)))


@register("sales_mart_rows", O.star_sql("""
SELECT store_id, sales_person_id, sales_person_first_name, sales_person_last_name,
       store_manager_name, manager_id, is_manager, sales_person_address, sales_person_pincode,
       sales_date, total_cost, substr(CAST(sales_date AS VARCHAR), 1, 7) AS sales_month
FROM enriched"""))
def q_sales_mart_rows(spark, d):
    return M.sales_mart_rows(E.enrich(*star_inputs(spark, d), order=E.FOR_SALES_TEAM))


# -------------------------------------------------------------- functions F1–F2

@register("sales_month", O.star_sql("""
SELECT substr(CAST(sales_date AS VARCHAR), 1, 7) AS sales_month, count(*) AS n_sales,
       CAST(sum(total_cost) AS DECIMAL(18,2)) AS total_sales
FROM s_sales GROUP BY 1"""))
def q_sales_month(spark, d):
    s = sales_from_star(spark, d)
    return s.groupBy(month_start("sales_date").alias("month")).agg(
        F.count(F.lit(1)).alias("n_sales"), money_sum("total_cost").alias("total_sales")
    ).select(month_of("month").alias("sales_month"), "n_sales", "total_sales")


@register("full_name", O.star_sql("""
SELECT customer_id, concat(first_name, ' ', last_name) AS full_name FROM d_customer"""))
def q_full_name(spark, d):
    c = customer_dim(spark, d)
    return c.select("customer_id", full_name("first_name", "last_name").alias("full_name"))


# ---------------------------------------------------------- aggregates A1–A7

@register("customer_monthly_window", O.star_sql("""
SELECT DISTINCT customer_id, concat(first_name, ' ', last_name) AS full_name, address, phone_number,
       substr(CAST(sales_date AS VARCHAR), 1, 7) AS sales_date_month,
       CAST(sum(total_cost) OVER (PARTITION BY customer_id, substr(CAST(sales_date AS VARCHAR), 1, 7))
            AS DECIMAL(18,2)) AS total_sales
FROM enriched"""))
def q_customer_monthly_window(spark, d):
    return M.customer_monthly_window(M.customer_mart_rows(E.enrich(*star_inputs(spark, d))))


@register("salesperson_monthly", O.star_sql("""
SELECT store_id, sales_person_id, full_name, sales_month, total_sales FROM monthly""",
                                            O.SALES_MART_SELECT))
def q_salesperson_monthly(spark, d):
    return M.salesperson_monthly(M.sales_mart_rows(E.enrich(*star_inputs(spark, d), order=E.FOR_SALES_TEAM)))


@register("salesperson_rank", O.star_sql("""
SELECT store_id, sales_person_id, full_name, sales_month, total_sales, rnk FROM ranked""",
                                         O.SALES_MART_SELECT))
def q_salesperson_rank(spark, d):
    rows, bounded = _rows_and_team_bound(spark, d)
    ranked = M.salesperson_rank(M.salesperson_monthly(rows), groups_bounded=bounded)
    return ranked.withColumn("rnk", F.col("rnk").cast("bigint"))


@register("salesperson_rank_range", O.star_sql("""
SELECT store_id, sales_person_id, full_name, sales_month, total_sales, rnk FROM ranked""",
                                               O.SALES_MART_SELECT))
def q_salesperson_rank_range(spark, d):
    """A4 by the range-split plan (the one taken when no bound proves the rank
    groups small), on the whole table, with as many range partitions as the
    session's shuffle setting."""
    rows, _ = _rows_and_team_bound(spark, d)
    ranked = M.salesperson_rank(M.salesperson_monthly(rows), groups_bounded=False)
    return ranked.withColumn("rnk", F.col("rnk").cast("bigint"))


@register("salesperson_incentive", O.star_sql("SELECT * FROM mart", O.SALES_MART_SELECT))
def q_salesperson_incentive(spark, d):
    rows, bounded = _rows_and_team_bound(spark, d)
    return M.sales_team_mart_from_rows(rows, groups_bounded=bounded)


@register("sales_team_mart", O.star_sql("SELECT * FROM mart", O.SALES_MART_SELECT))
def q_sales_team_mart(spark, d):
    return M.sales_team_mart(*star_inputs(spark, d))


@register("customer_mart", O.star_sql("SELECT * FROM cmart", O.CUSTOMER_MART_SELECT))
def q_customer_mart(spark, d):
    return M.customer_mart(*star_inputs(spark, d))
