import __spark_entry__ as entry
from salesmart.plans.registry import ORACLES, QUERIES


def test_entry_runs_on_smoke_data(spark):
    df = entry.entry(spark)
    assert df.columns == ["store_id", "sales_person_id", "full_name", "sales_month", "total_sales", "incentive"]
    assert df.count() > 0


def test_every_sales_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert len(QUERIES) >= 30
