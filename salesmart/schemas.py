"""

Ids are bigint (customer keys pass 2^31 at the target scale).

Money is decimal(18,2) everywhere: sums are exact, so rank ties do not depend
on partitioning or input order.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

# The mandatory header of a sales file, in canonical order.
MANDATORY_COLUMNS = (
    "customer_id",
    "store_id",
    "product_name",
    "sales_date",
    "sales_person_id",
    "price",
    "quantity",
    "total_cost",
)

EXTRA_COLUMN = "additional_column"

SALES = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("store_id", T.LongType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("sales_date", T.DateType()),
        T.StructField("sales_person_id", T.LongType()),
        T.StructField("price", MONEY),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("total_cost", MONEY),
        T.StructField(EXTRA_COLUMN, T.StringType()),
    ]
)

CUSTOMER = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("first_name", T.StringType()),
        T.StructField("last_name", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("pincode", T.StringType()),
        T.StructField("phone_number", T.StringType()),
        T.StructField("customer_joining_date", T.DateType()),
    ]
)

STORE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("address", T.StringType()),
        T.StructField("store_pincode", T.StringType()),
        T.StructField("store_manager_name", T.StringType()),
        T.StructField("store_opening_date", T.DateType()),
        T.StructField("reviews", T.StringType()),
    ]
)

SALES_TEAM = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("first_name", T.StringType()),
        T.StructField("last_name", T.StringType()),
        T.StructField("manager_id", T.IntegerType()),
        T.StructField("is_manager", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("pincode", T.StringType()),
        T.StructField("joining_date", T.DateType()),
    ]
)

SALES_MART = T.StructType(
    [
        T.StructField("store_id", T.LongType()),
        T.StructField("sales_person_id", T.LongType()),
        T.StructField("full_name", T.StringType()),
        T.StructField("sales_month", T.StringType()),
        T.StructField("total_sales", MONEY),
        T.StructField("incentive", MONEY),
    ]
)


def csv_schema(header: list[str], base: T.StructType = SALES) -> T.StructType:
    """Schema for a CSV file with the given header, in header order.

    Mandatory columns keep their declared types, any other column is read as
    string (it is only ever folded into ``additional_column``).
    """
    by_name = {f.name: f.dataType for f in base.fields}
    return T.StructType(
        [T.StructField(c, by_name.get(c, T.StringType()) if c in MANDATORY_COLUMNS else T.StringType())
         for c in header]
    )
