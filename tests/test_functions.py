"""Scalar helpers: exact money sums via cents, month key equivalence."""

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salesmart.functions.columns import money_sum, month_of, month_start

_money = st.decimals(min_value=Decimal("-99999999.99"), max_value=Decimal("99999999.99"), places=2,
                     allow_nan=False, allow_infinity=False)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.one_of(st.none(), _money), min_size=1, max_size=40))
def test_money_sum_is_exact(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v decimal(18,2)")
    got = df.agg(money_sum("v").alias("s")).first().s
    present = [v for v in values if v is not None]
    assert got == (sum(present, Decimal("0")) if present else None)
    assert df.agg(money_sum("v").alias("s")).schema["s"].dataType.simpleString() == "decimal(18,2)"


def test_money_sum_overflow_raises(spark):
    big = Decimal("9999999999999999.99")  # 10^18 cents: nine of them leave bigint
    df = spark.createDataFrame([(big,)] * 12, "v decimal(18,2)")
    with pytest.raises(Exception):
        df.agg(money_sum("v")).collect()


def test_month_start_keeps_the_month_string(spark):
    days = [dt.date(1992, 1, 1), dt.date(1998, 12, 31), dt.date(2025, 2, 28), None]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    rows = df.select(month_of("d").alias("a"), month_of(month_start("d")).alias("b")).collect()
    assert all(r.a == r.b for r in rows)
    assert [r.a for r in rows][:3] == ["1992-01", "1998-12", "2025-02"]
    assert df.select(F.countDistinct(month_start("d"))).first()[0] == 3
