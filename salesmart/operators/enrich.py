"""

Three inner equi-joins: sale ⋈ customer on customer_id, ⋈ store on
store.id = store_id, ⋈ sales_team on sales_team.id = sales_person_id. Rows
without a match in any dimension are dropped (inner-join semantics kept).
Columns are selected explicitly, so the wide row has no duplicate names.

Each dimension is projected to the columns used and broadcast only when a
counted bound proves it small; else the join shuffles on its key and AQE can
split a hot key's partition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.plans.joins import DEFAULT_BROADCAST_ROWS, bounded_broadcast, hint_if, small_enough

# Columns of the enriched row, in output order.
ENRICHED_COLUMNS = (
    "customer_id", "first_name", "last_name", "address", "pincode", "phone_number",
    "store_id", "store_address", "store_manager_name",
    "sales_date", "sales_person_id",
    "sales_person_first_name", "sales_person_last_name",
    "sales_person_address", "sales_person_pincode",
    "manager_id", "is_manager", "total_cost",
)


def _customer_side(customer: DataFrame) -> DataFrame:
    return customer.select("customer_id", "first_name", "last_name", "address", "pincode", "phone_number")


def _store_side(store: DataFrame) -> DataFrame:
    return store.select(
        F.col("id").alias("store_id"),
        F.col("address").alias("store_address"),
        "store_manager_name",
    )


def _team_side(sales_team: DataFrame) -> DataFrame:
    return sales_team.select(
        F.col("id").alias("sales_person_id"),
        F.col("first_name").alias("sales_person_first_name"),
        F.col("last_name").alias("sales_person_last_name"),
        F.col("address").alias("sales_person_address"),
        F.col("pincode").alias("sales_person_pincode"),
        "manager_id",
        "is_manager",
    )


def join_customer(sales: DataFrame, customer: DataFrame,
                  max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Sales ⋈ customer; drops product/price/quantity/extras and the
    customer joining date, keeps the customer's name, address, pincode, phone."""
    c, _ = bounded_broadcast(_customer_side(customer), max_rows)
    s = sales.select("customer_id", "store_id", "sales_date", "sales_person_id", "total_cost")
    return s.join(c, "customer_id", "inner")


def join_store(df: DataFrame, store: DataFrame,
               max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """… ⋈ store on store.id = store_id; keeps the store's address (as
    ``store_address``) and manager name."""
    st, _ = bounded_broadcast(_store_side(store), max_rows)
    return df.join(st, "store_id", "inner")


def join_sales_team(df: DataFrame, sales_team: DataFrame,
                    max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """J3 + P2: … ⋈ sales_team on id = sales_person_id, its name, address and
    pincode renamed to ``sales_person_*``."""
    t, _ = bounded_broadcast(_team_side(sales_team), max_rows)
    return df.join(t, "sales_person_id", "inner")


# Join orders: the reference's (customer, store, sales team), and the one for
# frames later grouped by store and sales person (customer last).
REFERENCE_ORDER = ("customer", "store", "sales_team")
FOR_SALES_TEAM = ("sales_team", "store", "customer")


def enrich(sales: DataFrame, customer: DataFrame, store: DataFrame, sales_team: DataFrame,
           max_rows: int = DEFAULT_BROADCAST_ROWS, order: tuple[str, ...] = REFERENCE_ORDER) -> DataFrame:
    """The full enrichment; output columns ``ENRICHED_COLUMNS``."""
    return enrich_with_bounds(sales, customer, store, sales_team, max_rows, order)[0]


def enrich_with_bounds(sales: DataFrame, customer: DataFrame, store: DataFrame, sales_team: DataFrame,
                       max_rows: int = DEFAULT_BROADCAST_ROWS,
                       order: tuple[str, ...] = REFERENCE_ORDER,
                       cluster: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, dict[str, bool]]:
    """J4, plus which dimensions were proven to hold at most ``max_rows`` rows
    (``customer``, ``store``, ``sales_team``). The three dimension size checks
    run as concurrent jobs.

    ``order`` only matters when a dimension is too big to broadcast: the last
    shuffled join hands its partitioning on to what follows, and an
    aggregation grouped by that key would reuse it (one task per key, with
    AQE unable to split a hot one). So a caller that groups by store and
    sales person joins the customer last (``FOR_SALES_TEAM``), one that groups
    by customer keeps the sales team last (the default).

    ``cluster`` redistributes the rows for the caller. It is applied after the
    shuffled joins and before the broadcast ones, which come last then and keep
    its distribution: their columns need not be shuffled.
    """
    sides = {"customer": (_customer_side(customer), "customer_id"),
             "store": (_store_side(store), "store_id"),
             "sales_team": (_team_side(sales_team), "sales_person_id")}
    small = dict(zip(sides, small_enough([side for side, _ in sides.values()], max_rows)))
    df = sales.select("customer_id", "store_id", "sales_date", "sales_person_id", "total_cost")
    for name in sorted(order, key=small.get) if cluster else order:
        if cluster and small[name]:
            df, cluster = cluster(df), None
        side, key = sides[name]
        df = df.join(hint_if(side, small[name]), key, "inner")
    if cluster:
        df = cluster(df)
    return df.select(*ENRICHED_COLUMNS), small
