"""DuckDB-runnable SQL for every registered query (the correctness oracle).

The views ``lineitem orders part supplier customer nation region`` are the
driver's parquet tables. The CTEs below restate the star mapping of
``salesmart.sources.star`` in SQL; each oracle appends its own final SELECT.
Money is DECIMAL(18,2), ids BIGINT, months 'YYYY-MM' strings, on both sides.
"""

from __future__ import annotations

SALES_CTE = """
s_sales AS (
  SELECT o.o_custkey AS customer_id,
         CAST(s.s_nationkey AS BIGINT) AS store_id,
         p.p_name AS product_name,
         CAST(o.o_orderdate AS DATE) AS sales_date,
         l.l_suppkey AS sales_person_id,
         CAST(p.p_retailprice AS DECIMAL(18,2)) AS price,
         CAST(l.l_quantity AS INTEGER) AS quantity,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS total_cost,
         l.l_returnflag, l.l_linestatus, o.o_orderstatus
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
)"""

DIM_CTE = """
d_customer AS (
  SELECT c.c_custkey AS customer_id, c.c_name AS first_name, c.c_mktsegment AS last_name,
         n.n_name AS address, CAST(c.c_nationkey AS VARCHAR) AS pincode,
         CAST(c.c_custkey AS VARCHAR) AS phone_number
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
),
d_store AS (
  SELECT CAST(n.n_nationkey AS BIGINT) AS id, r.r_name AS address, n.n_name AS store_manager_name
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
),
d_team AS (
  SELECT s.s_suppkey AS id, s.s_name AS first_name, n.n_name AS last_name,
         CAST(s.s_nationkey AS INTEGER) AS manager_id, 'N' AS is_manager,
         r.r_name AS address, CAST(s.s_nationkey AS VARCHAR) AS pincode
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
                  JOIN region r ON n.n_regionkey = r.r_regionkey
),
enriched AS (
  SELECT c.customer_id, c.first_name, c.last_name, c.address, c.pincode, c.phone_number,
         s.store_id, st.address AS store_address, st.store_manager_name,
         s.sales_date, s.sales_person_id,
         t.first_name AS sales_person_first_name, t.last_name AS sales_person_last_name,
         t.address AS sales_person_address, t.pincode AS sales_person_pincode,
         t.manager_id, t.is_manager, s.total_cost
  FROM s_sales s
  JOIN d_customer c ON s.customer_id = c.customer_id
  JOIN d_store st ON s.store_id = st.id
  JOIN d_team t ON s.sales_person_id = t.id
)"""

MONTH = "substr(CAST({} AS VARCHAR), 1, 7)"

SALES_MART_SELECT = """
monthly AS (
  SELECT store_id, sales_person_id,
         concat(sales_person_first_name, ' ', sales_person_last_name) AS full_name,
         substr(CAST(sales_date AS VARCHAR), 1, 7) AS sales_month,
         CAST(sum(total_cost) AS DECIMAL(18,2)) AS total_sales
  FROM enriched
  GROUP BY ALL
),
ranked AS (
  SELECT *, rank() OVER (PARTITION BY store_id, sales_month ORDER BY total_sales DESC) AS rnk
  FROM monthly
),
mart AS (
  SELECT store_id, sales_person_id, full_name, sales_month, total_sales,
         CAST(CASE WHEN rnk = 1 THEN round(total_sales * 0.01, 2) ELSE 0 END AS DECIMAL(18,2)) AS incentive
  FROM ranked
)"""

CUSTOMER_MART_SELECT = """
cmart AS (
  SELECT customer_id, concat(first_name, ' ', last_name) AS full_name, address, phone_number,
         substr(CAST(sales_date AS VARCHAR), 1, 7) AS sales_date_month,
         CAST(sum(total_cost) AS DECIMAL(18,2)) AS total_sales
  FROM enriched
  GROUP BY ALL
)"""


def with_ctes(*ctes: str, select: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + select


def star_sql(select: str, *extra: str, sales_where: str | None = None) -> str:
    """SQL over the sales + dimension CTEs and optional extra CTEs;
    ``sales_where`` restricts the sale rows that enter ``enriched``."""
    dims = DIM_CTE
    if sales_where:
        dims = dims.replace("FROM s_sales s\n", f"FROM (SELECT * FROM s_sales WHERE {sales_where}) s\n")
    return with_ctes(SALES_CTE, dims, *extra, select=select)
