"""

Two families of functions:

* row-level forms over the enriched frame (``customer_mart_rows``,
  ``sales_mart_rows`` and the aggregates derived from them), the shape the
  reference computes;
* aggregate-first marts (``customer_mart``, ``sales_team_mart``) that restrict
  the sale rows to keys present in all three dimensions (semi joins), sum per
  group with map-side partial aggregation, and only then join the small
  aggregated result to the dimension for names. Same rows as the reference
  when dimension keys are unique, which ``plans.joins.require_unique`` checks.

Money is decimal(18,2) throughout, summed exactly as bigint cents; rank ties
are stable. Months are grouped on the month's first day and formatted as
``YYYY-MM`` once per group, after the aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions.columns import cents, cents_to_money, full_name, incentive, month_of, month_start
from salesmart.operators.ranking import rank_desc
from salesmart.plans.joins import DEFAULT_BROADCAST_ROWS, hint_if, key_set, semi_join_all, small_enough

CUSTOMER_MART_COLUMNS = ("customer_id", "full_name", "address", "phone_number", "sales_date_month", "total_sales")
SALES_MART_COLUMNS = ("store_id", "sales_person_id", "full_name", "sales_month", "total_sales", "incentive")


# ---------------------------------------------------------------- projections

def customer_mart_rows(enriched: DataFrame) -> DataFrame:
    """The 8 columns the customer mart is built from."""
    return enriched.select("customer_id", "first_name", "last_name", "address", "pincode",
                           "phone_number", "sales_date", "total_cost")


def sales_mart_rows(enriched: DataFrame) -> DataFrame:
    """P4 + P5: the 11 sales-team columns plus ``sales_month``."""
    return enriched.select(
        "store_id", "sales_person_id", "sales_person_first_name", "sales_person_last_name",
        "store_manager_name", "manager_id", "is_manager",
        "sales_person_address", "sales_person_pincode", "sales_date", "total_cost",
        F.expr("substring(sales_date, 1, 7)").alias("sales_month"),
    )


# ------------------------------------------------------- aggregates over rows
#
# The row-form marts sum integer cents per (group keys, descriptive columns)
# first. The incremental job keeps such sums per group key only (*parts*): the
# parts of several runs merge by summing, and names are joined from the current
# dimensions when a month is finished (``*_from_parts``), never from all raw
# rows again.

CUSTOMER_KEYS, CUSTOMER_DESCRIBED = ["customer_id", "month"], ["full_name", "address", "phone_number"]
SALES_KEYS, SALES_DESCRIBED = ["store_id", "sales_person_id", "month"], ["full_name"]


def _parts(r: DataFrame, keys: list[str], described: list[str]) -> DataFrame:
    return r.groupBy(*keys, *described).agg(F.sum(cents("total_cost")).alias("cents"))


def both_parts(rows: DataFrame) -> DataFrame:
    """Parts of both marts from one pass over enriched rows: ``mart`` (sales or
    customer), the keys of that mart, ``month`` and ``cents``."""
    r = rows.select("store_id", "sales_person_id", "customer_id", month_start("sales_date").alias("month"),
                    cents("total_cost").alias("cents"))
    marts = F.explode(F.array(F.lit("sales"), F.lit("customer"))).alias("mart")
    sales = F.col("mart") == "sales"
    keyed = r.select("*", marts).select(
        "mart", *[F.when(sales, F.col(c)).alias(c) for c in ("store_id", "sales_person_id")],
        F.when(~sales, F.col("customer_id")).alias("customer_id"), "month", "cents")
    return keyed.groupBy("mart", "store_id", "sales_person_id", "customer_id", "month").agg(F.sum("cents").alias("cents"))


def merge_parts(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Sum the parts of several runs per key."""
    return parts.groupBy(*keys).agg(F.sum("cents").alias("cents"))


def _with_whole_totals(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct (keys, described) rows, each with the whole total of its keys.

    A window sum of the per-description sums per keys: its partition holds one
    row per distinct description of a key (one, unless the dimension repeats a
    key), never the sale rows, so a hot key has collapsed map-side before any
    shuffle.
    """
    whole = F.sum("cents").over(Window.partitionBy(*keys))
    return parts.withColumn("total_sales", cents_to_money(whole)).drop("cents")


def customer_parts(rows: DataFrame) -> DataFrame:
    """Partial state of A1 over customer-mart rows: ``customer_id, month, full_name,
    address, phone_number, cents``."""
    r = rows.select("customer_id", full_name("first_name", "last_name").alias("full_name"),
                    "address", "phone_number", month_start("sales_date").alias("month"),
                    "total_cost")
    return _parts(r, CUSTOMER_KEYS, CUSTOMER_DESCRIBED)


def sales_parts(rows: DataFrame) -> DataFrame:
    """Partial state of A2 over sales-mart rows: ``store_id, sales_person_id, month,
    full_name, cents``."""
    r = rows.select("store_id", "sales_person_id",
                    full_name("sales_person_first_name", "sales_person_last_name").alias("full_name"),
                    month_start("sales_date").alias("month"), "total_cost")
    return _parts(r, SALES_KEYS, SALES_DESCRIBED)


def _customer_finish(parts: DataFrame) -> DataFrame:
    out = _with_whole_totals(parts, CUSTOMER_KEYS)
    return out.withColumn("sales_date_month", month_of("month")).select(*CUSTOMER_MART_COLUMNS)


def _monthly_finish(parts: DataFrame) -> DataFrame:
    out = _with_whole_totals(parts, SALES_KEYS)
    return out.select("store_id", "sales_person_id", "full_name", month_of("month").alias("sales_month"),
                      "total_sales")


def customer_monthly_window(rows: DataFrame) -> DataFrame:
    """A1 + A3 over customer-mart rows: each distinct (customer, name, address,
    phone, month) row carries the customer's whole-month total.

    The reference writes ``sum() over (partition by customer, month)`` over
    the sale rows, then ``distinct``; that window would put all rows of one
    hot customer-month in one task. Sums per description first, then a window
    over those sums, give the same rows.
    """
    return _customer_finish(customer_parts(rows))


def salesperson_monthly(rows: DataFrame) -> DataFrame:
    """A2 + A3 over sales-mart rows: total per (store, person, month)."""
    return _monthly_finish(sales_parts(rows))


def salesperson_rank(monthly: DataFrame, groups_bounded: bool = False,
                     partitions: int | None = None, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """A4: ``rank()`` within (store, month) by total descending; ties share a
    rank. A (store, month) group holds each sales person at most once, so a
    counted bound on the sales-team dimension (``groups_bounded``) allows one
    window partition per group; without it the range-split rank is used,
    which never puts a whole hot store-month into one task."""
    return rank_desc(monthly, ["store_id", "sales_month"], "total_sales", "rnk",
                     groups_bounded=groups_bounded, partitions=partitions, max_rows=max_rows)


def salesperson_incentive(ranked: DataFrame) -> DataFrame:
    """A5: 1 % of the month total (rounded half up) for every rank-1 person."""
    return ranked.withColumn("incentive", incentive("total_sales", "rnk")).select(*SALES_MART_COLUMNS)


def sales_team_mart_from_rows(rows: DataFrame, groups_bounded: bool = False) -> DataFrame:
    """A7 over sales-mart rows (e.g. read back from the partitioned mart)."""
    return salesperson_incentive(salesperson_rank(salesperson_monthly(rows), groups_bounded))


def sales_team_mart_from_parts(parts: DataFrame, sales_team: DataFrame, groups_bounded: bool = False,
                               months_bounded: bool = False) -> DataFrame:
    """A7 from merged sales parts and the current sales team; ``groups_bounded``
    says the team is proven small. One row per (store, person, month). With
    ``months_bounded`` (the rows of each month are counted few) a month is
    ranked in one task, and the result is clustered by month."""
    team = sales_team.select(F.col("id").alias("sales_person_id"), full_name("first_name", "last_name").alias("full_name"))
    named = parts.join(hint_if(team, groups_bounded), "sales_person_id", "inner").select(
        "store_id", "sales_person_id", "full_name", month_of("month").alias("sales_month"),
        cents_to_money(F.col("cents")).alias("total_sales"))
    if months_bounded:
        named = named.hint("rebalance", "sales_month")
    return salesperson_incentive(salesperson_rank(named, groups_bounded))


def customer_mart_from_parts(parts: DataFrame, customer: DataFrame, small: bool = False) -> DataFrame:
    """A6 from merged customer parts and the current customers. One row per
    (customer, month)."""
    cust = customer.select("customer_id", full_name("first_name", "last_name").alias("full_name"), "address", "phone_number")
    return parts.join(hint_if(cust, small), "customer_id", "inner").select(
        "customer_id", "full_name", "address", "phone_number", month_of("month").alias("sales_date_month"),
        cents_to_money(F.col("cents")).alias("total_sales"))


# --------------------------------------------------------- aggregate-first marts

_DIMS = {
    "customer": ("customer_id", "customer_id"),
    "store": ("store_id", "id"),
    "sales_team": ("sales_person_id", "id"),
}


def _restricted_monthly(sales: DataFrame, checks, small: list[bool], group: list[str]) -> DataFrame:
    """Monthly sums of the sale rows that survive the three inner joins.

    ``checks`` are the dimensions applied here as semi joins (the remaining one
    is joined by the caller for its descriptive columns); ``small`` says which
    key sets were proven small enough to broadcast, in which case the fact side
    is not shuffled for them.

    A check on a key that is also a group key (the store of the sales-team
    mart) filters whole groups, so it runs on the aggregated rows, after the
    sum: fewer rows to probe, and the sum gets its own exchange on all group
    keys after map-side partial sums. Were it a shuffled semi join below the
    sum, the sum would reuse the semi join's partitioning on that one key,
    putting each store's rows in one task, and AQE could not split the hot
    one. The other checks run before the sum; when one of them is too big to
    broadcast, the rows are first pre-aggregated to (customer, store, person,
    month), which collapses hot keys map-side before the shuffled semi join.
    """
    before = [(c, sm) for c, sm in zip(checks, small) if c[1] not in group]
    after = [(c, sm) for c, sm in zip(checks, small) if c[1] in group]
    s = sales.select("customer_id", "store_id", "sales_person_id",
                     month_start("sales_date").alias("month"), cents("total_cost").alias("cents"))
    if not all(sm for _, sm in before):
        s = s.groupBy("customer_id", "store_id", "sales_person_id", "month").agg(
            F.sum("cents").alias("cents"))
    probe, _ = semi_join_all(s, [c for c, _ in before], small=[sm for _, sm in before])
    summed = probe.groupBy(*group).agg(cents_to_money(F.sum("cents")).alias("total_sales"))
    out, _ = semi_join_all(summed, [c for c, _ in after], small=[sm for _, sm in after])
    return out


def _plan_checks(dims: dict[str, DataFrame], semi: list[str], named: DataFrame, max_rows: int):
    """Key-set semi-join specs for ``semi`` plus one concurrent size check of
    every key set and of the ``named`` dimension projection."""
    checks = [(dims[d], *_DIMS[d]) for d in semi]
    sets = [key_set(k, fc, kc) for k, fc, kc in checks]
    small = small_enough(sets + [named], max_rows)
    return checks, small[:-1], small[-1]


def sales_team_mart(sales: DataFrame, customer: DataFrame, store: DataFrame, sales_team: DataFrame,
                    max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """A7, the flagship: store_id, sales_person_id, full_name, sales_month,
    total_sales, incentive."""
    team = sales_team.select(F.col("id").alias("sales_person_id"),
                             full_name("first_name", "last_name").alias("full_name"))
    dims = {"customer": customer, "store": store, "sales_team": sales_team}
    checks, small, team_small = _plan_checks(dims, ["customer", "store"], team, max_rows)
    monthly = _restricted_monthly(sales, checks, small, ["store_id", "sales_person_id", "month"])
    named = monthly.join(hint_if(team, team_small), "sales_person_id", "inner").select(
        "store_id", "sales_person_id", "full_name", month_of("month").alias("sales_month"), "total_sales")
    # Each person occurs once per (store, month): a team proven small bounds every rank group.
    return salesperson_incentive(salesperson_rank(named, groups_bounded=team_small, max_rows=max_rows))


def customer_mart(sales: DataFrame, customer: DataFrame, store: DataFrame, sales_team: DataFrame,
                  max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """customer_id, full_name, address, phone_number, sales_date_month, total_sales."""
    cust = customer.select("customer_id", full_name("first_name", "last_name").alias("full_name"),
                           "address", "phone_number")
    dims = {"customer": customer, "store": store, "sales_team": sales_team}
    checks, small, cust_small = _plan_checks(dims, ["store", "sales_team"], cust, max_rows)
    monthly = _restricted_monthly(sales, checks, small, ["customer_id", "month"])
    return monthly.join(hint_if(cust, cust_small), "customer_id", "inner").select(
        "customer_id", "full_name", "address", "phone_number",
        month_of("month").alias("sales_date_month"), "total_sales")
