"""The golden case of FIXTURES.md §4: three hand-made files and dimensions."""

from __future__ import annotations

import datetime as dt
import os

A_CSV = """customer_id,store_id,product_name,sales_date,sales_person_id,price,quantity,total_cost
1,121,sugar,2025-01-02,1,50,2,100
2,121,clinic plus,2025-01-03,2,1.5,3,4.5
2,121,clinic plus,2025-01-03,2,1.5,3,4.5
9,121,sugar,2025-01-04,1,50,1,50
"""

B_CSV = """customer_id,store_id,product_name,sales_date,sales_person_id,price,quantity,total_cost,payment_mode,note
1,122,maida,2025-02-02,4,20,2,40,cash,
3,122,maida,2025-02-03,5,20,2,40,UPI,x
3,123,clinic plus,2025-02-03,7,12.5,1,12.5,,
"""

C_CSV = """customer_id,product_name,sales_date,sales_person_id,price,quantity,total_cost,payment_mode
1,maida,2025-02-02,"[4, 5, 6]",20,2,40,cash
"""


def write_files(root: str, extra: dict[str, str] | None = None) -> str:
    src = os.path.join(root, "source")
    os.makedirs(src, exist_ok=True)
    files = {"a.csv": A_CSV, "b.csv": B_CSV, "c.csv": C_CSV, **(extra or {})}
    for name, text in files.items():
        p = os.path.join(src, name)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "w") as f:
            f.write(text)
    return src


def dims(spark):
    from salesmart.schemas import CUSTOMER, SALES_TEAM, STORE
    customer = spark.createDataFrame([
        (1, "Ana", "Bo", "addr1", "111", "p1", dt.date(2024, 1, 1)),
        (2, "Cy", "Di", "addr2", "222", "p2", dt.date(2024, 1, 1)),
        (3, "Ed", None, "addr3", "333", "p3", dt.date(2024, 1, 1)),
    ], CUSTOMER)
    store = spark.createDataFrame([
        (i, f"store{i}", f"9{i}", f"mgr{i}", dt.date(2020, 1, 1), None) for i in (121, 122, 123, 124)
    ], STORE)
    team = spark.createDataFrame([
        (i, f"S{i}", f"T{i}", 0, "N", f"team addr{i}", f"5{i}", dt.date(2021, 1, 1)) for i in range(1, 10)
    ], SALES_TEAM)
    return customer, store, team
