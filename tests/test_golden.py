import os
from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from golden import dims, write_files
from salesmart.operators import enrich as E
from salesmart.operators import ingest as I
from salesmart.operators import marts as M
from salesmart.schemas import MANDATORY_COLUMNS
from salesmart.sources.files import read_headers

D = Decimal


def _gate(spark, root):
    return {r.file_path.rsplit("/", 1)[-1]: r for r in I.gate(read_headers(spark, root)).collect()}


def test_gate_accepts_a_b_and_rejects_c(spark, tmpdir_str):
    src = write_files(tmpdir_str)
    g = _gate(spark, src)
    assert g["a.csv"].accepted and g["b.csv"].accepted
    assert not g["c.csv"].accepted
    assert list(g["c.csv"].missing) == ["store_id"]
    assert list(g["b.csv"].extras) == ["payment_mode", "note"]
    assert list(g["a.csv"].extras) == []


def test_union_and_additional_column(spark, tmpdir_str):
    src = write_files(tmpdir_str)
    sales, _ = I.ingest(spark, src, error_root=f"{tmpdir_str}/errors")
    rows = sales.collect()
    assert len(rows) == 7  # the two equal rows of a.csv both stay
    extras = sorted((r.additional_column for r in rows), key=lambda v: (v is not None, v or ""))
    assert extras == [None, None, None, None, "", "UPI,x", "cash"]
    assert {r.price for r in rows} == {D("50.00"), D("1.50"), D("20.00"), D("12.50")}
    # the rejected file is quarantined line by line
    q = spark.read.text(f"{tmpdir_str}/errors/rows").collect()
    assert len(q) == 2


def test_no_accepted_file_raises(spark, tmpdir_str):
    import os
    os.makedirs(f"{tmpdir_str}/only_bad")
    with open(f"{tmpdir_str}/only_bad/c.csv", "w") as f:
        f.write("customer_id,product_name\n1,x\n")
    import pytest
    with pytest.raises(I.NoAcceptedFiles):
        I.ingest(spark, f"{tmpdir_str}/only_bad")


def _marts(spark, tmpdir_str, extra=None):
    src = write_files(tmpdir_str, extra)
    sales, _ = I.ingest(spark, src)
    customer, store, team = dims(spark)
    return sales, customer, store, team


EXPECTED_CUSTOMER = {
    (1, "Ana Bo", "2025-01", D("100.00")),
    (1, "Ana Bo", "2025-02", D("40.00")),
    (2, "Cy Di", "2025-01", D("9.00")),
    (3, None, "2025-02", D("52.50")),
}

EXPECTED_SALES = {
    (121, 1, "S1 T1", "2025-01", D("100.00"), D("1.00")),
    (121, 2, "S2 T2", "2025-01", D("9.00"), D("0.00")),
    (122, 4, "S4 T4", "2025-02", D("40.00"), D("0.40")),
    (122, 5, "S5 T5", "2025-02", D("40.00"), D("0.40")),
    (123, 7, "S7 T7", "2025-02", D("12.50"), D("0.13")),
}


def _cust_set(df):
    return {(r.customer_id, r.full_name, r.sales_date_month, r.total_sales) for r in df.collect()}


def _sales_set(df):
    return {(r.store_id, r.sales_person_id, r.full_name, r.sales_month, r.total_sales, r.incentive)
            for r in df.collect()}


def test_enriched_drops_unknown_customer(spark, tmpdir_str):
    sales, c, s, t = _marts(spark, tmpdir_str)
    assert E.enrich(sales, c, s, t).count() == 6


def test_customer_mart_both_forms(spark, tmpdir_str):
    sales, c, s, t = _marts(spark, tmpdir_str)
    assert _cust_set(M.customer_mart(sales, c, s, t)) == EXPECTED_CUSTOMER
    assert _cust_set(M.customer_mart(sales, c, s, t, max_rows=0)) == EXPECTED_CUSTOMER
    rows = M.customer_mart_rows(E.enrich(sales, c, s, t))
    assert _cust_set(M.customer_monthly_window(rows)) == EXPECTED_CUSTOMER


def test_sales_team_mart_ties_and_half_up(spark, tmpdir_str):
    sales, c, s, t = _marts(spark, tmpdir_str)
    assert _sales_set(M.sales_team_mart(sales, c, s, t)) == EXPECTED_SALES
    assert _sales_set(M.sales_team_mart(sales, c, s, t, max_rows=0)) == EXPECTED_SALES
    rows = M.sales_mart_rows(E.enrich(sales, c, s, t))
    assert _sales_set(M.sales_team_mart_from_rows(rows)) == EXPECTED_SALES


def test_unknown_store_and_seller_reach_no_mart(spark, tmpdir_str):
    extra = {"d.csv": "customer_id,store_id,product_name,sales_date,sales_person_id,price,quantity,total_cost\n"
                      "1,999,sugar,2025-01-05,1,50,1,50\n"
                      "2,121,sugar,2025-01-05,99,50,1,50\n"}
    sales, c, s, t = _marts(spark, tmpdir_str, extra)
    assert _cust_set(M.customer_mart(sales, c, s, t)) == EXPECTED_CUSTOMER
    assert _sales_set(M.sales_team_mart(sales, c, s, t)) == EXPECTED_SALES
    assert _cust_set(M.customer_mart(sales, c, s, t, max_rows=0)) == EXPECTED_CUSTOMER
    assert _sales_set(M.sales_team_mart(sales, c, s, t, max_rows=0)) == EXPECTED_SALES


def test_incentive_type_is_decimal(spark, tmpdir_str):
    sales, c, s, t = _marts(spark, tmpdir_str)
    m = M.sales_team_mart(sales, c, s, t)
    types = dict(m.dtypes)
    assert types["total_sales"] == "decimal(18,2)" and types["incentive"] == "decimal(18,2)"
    assert m.where(F.col("incentive") > 0).count() == 4


_names = st.sampled_from(list(MANDATORY_COLUMNS) + ["payment_mode", "note", "Store_ID", "x"])


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(_names, min_size=1, max_size=12, unique=True), min_size=1, max_size=6))
def test_gate_matches_set_semantics(spark, headers):
    """missing = mandatory − header, extras = header − mandatory (header
    order kept), case-sensitive, order-free acceptance."""
    df = spark.createDataFrame([(f"f{i}", h) for i, h in enumerate(headers)], "file_path string, header array<string>")
    got = {r.file_path: r for r in I.gate(df).collect()}
    for i, h in enumerate(headers):
        r = got[f"f{i}"]
        assert list(r.missing) == [c for c in MANDATORY_COLUMNS if c not in h]
        assert list(r.extras) == [c for c in h if c not in MANDATORY_COLUMNS]
        assert r.accepted == set(MANDATORY_COLUMNS).issubset(h)


def test_quarantine_copy_is_smaller_than_the_files(spark, tmpdir_str):
    src = f"{tmpdir_str}/src"
    os.makedirs(src)
    lines = ["customer_id,product_name"] + [f"{i % 90},product number {i % 7}" for i in range(5000)]
    with open(f"{src}/bad.csv", "w") as f:
        f.write("\n".join(lines) + "\n")
    I.quarantine(spark, I.gate(read_headers(spark, src)), f"{tmpdir_str}/errors")
    rows = f"{tmpdir_str}/errors/rows"
    assert sorted(r.value for r in spark.read.text(rows).collect()) == sorted(lines)
    written = sum(os.path.getsize(f"{at}/{n}") for at, _, names in os.walk(rows) for n in names if n.startswith("part-"))
    assert 2 * written < os.path.getsize(f"{src}/bad.csv")
