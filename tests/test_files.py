import gzip
import os

import pytest
from pyspark.sql.types import StructType

from golden import A_CSV
from salesmart.plans import landing
from salesmart.schemas import SALES
from salesmart.sources.files import discover, read_headers


def _write(path, text, gz=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    if gz:
        with gzip.open(path, "wt") as f:
            f.write(text)
    else:
        with open(path, "w") as f:
            f.write(text)


def test_discovery_suffix_any_case_recursive(spark, tmpdir_str):
    root = f"{tmpdir_str}/src"
    _write(f"{root}/a.csv", A_CSV)
    _write(f"{root}/deep/er/B.CSV", A_CSV)
    _write(f"{root}/notes.txt", A_CSV)
    _write(f"{root}/c.csv.gz", A_CSV, gz=True)
    names = sorted(p.rsplit("/", 1)[-1] for p in (r.path for r in discover(spark, root).collect()))
    assert names == ["B.CSV", "a.csv"]


def test_discovery_empty_raises(spark, tmpdir_str):
    os.makedirs(f"{tmpdir_str}/empty/sub")
    _write(f"{tmpdir_str}/empty/sub/x.txt", "hello")
    with pytest.raises(FileNotFoundError):
        discover(spark, f"{tmpdir_str}/empty")


def test_headers_one_row_per_file_with_quotes(spark, tmpdir_str):
    root = f"{tmpdir_str}/h"
    _write(f"{root}/q.csv", '"customer_id","store_id"\n1,2\n3,4\n')
    _write(f"{root}/p.csv", A_CSV)
    h = {r.file_path.rsplit("/", 1)[-1]: list(r.header) for r in read_headers(spark, root).collect()}
    assert h["q.csv"] == ["customer_id", "store_id"]
    assert h["p.csv"][0] == "customer_id" and len(h["p.csv"]) == 8


def test_header_of_multi_split_file(spark, tmpdir_str):
    # a file larger than one split: only the first split's first line is the header
    root = f"{tmpdir_str}/big"
    body = "".join(f"{i},121,x,2025-01-01,1,1,1,1\n" for i in range(200_000))
    _write(f"{root}/big.csv", A_CSV.splitlines()[0] + "\n" + body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
    try:
        rows = read_headers(spark, root).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 1 and rows[0].header[0] == "customer_id"


def test_arrow_uri_aliases_hadoop_s3_schemes():
    from salesmart.sources.files import arrow_uri
    assert arrow_uri("s3a://bucket/in/a.csv") == "s3://bucket/in/a.csv"
    assert arrow_uri("S3N://bucket/a.csv") == "s3://bucket/a.csv"
    assert arrow_uri("file:/tmp/a.csv") == "file:/tmp/a.csv"
    assert arrow_uri("gs://b/a.csv") == "gs://b/a.csv"


def test_wide_header_is_read_to_its_end(spark, tmpdir_str):
    root = f"{tmpdir_str}/wide"
    names = [f"column_number_{i:05d}_" + "x" * 60 for i in range(20_000)]
    _write(f"{root}/w.csv", ",".join(names) + "\n1\n")
    for method in ("auto", "scan"):
        rows = read_headers(spark, root, method=method).collect()
        assert len(rows) == 1 and list(rows[0].header) == names


def test_path_forms():
    from salesmart.sources.paths import comparable, for_reader
    assert for_reader("file:/a/s[1] {b}*?.csv") == "file:/a/s\\[1\\] \\{b\\}\\*\\?.csv"
    assert comparable("file:///a/b/") == comparable("file:/a/b") == comparable("/a/b")


ODD_HEADERS = [
    "a,b,c", '"a,b",c', '"a","b c"', "a,,c", ",", "a,A,b", "price,price,Price,x", '"a\\"b",c', '"a,""b",c', 'a"b,c', '"a"b,c',
    "a.b,`c`,d e", " a ,b ", "_c2,,x", "note,note1,note", '"",a', "é,É,x", "a,b,",
]


@pytest.mark.parametrize("header", ODD_HEADERS)
@pytest.mark.parametrize("method", ["auto", "scan"])
def test_header_names_are_those_of_the_csv_reader(spark, tmpdir_str, header, method):
    path = f"{tmpdir_str}/x.csv"
    _write(path, header + "\n1,2,3\n")
    expected = spark.read.option("header", "true").csv(path).columns
    assert [list(r.header) for r in read_headers(spark, tmpdir_str, method=method).collect()] == [expected]


def test_files_with_odd_headers_are_folded_and_gated_like_others(spark, tmpdir_str):
    from salesmart.operators import ingest as I
    names = "customer_id,store_id,product_name,sales_date,sales_person_id,price,quantity,total_cost"
    row = "1,121,sugar,2025-01-02,1,50,2,100"
    _write(f"{tmpdir_str}/dots.csv", f'{names},"a,b",c.d,`e`\n{row},x,y,z\n')
    _write(f"{tmpdir_str}/twice.csv", f"{names},note,Note,,\n{row},p,q,,r\n")
    _write(f"{tmpdir_str}/own.csv", f"{names},source_file,_bad_row,additional_column\n{row},s,t,u\n")
    _write(f"{tmpdir_str}/price.csv", f"{names},Price\n{row},1\n")
    _write(f"{tmpdir_str}/blank.csv", "\n")
    gated = {r.file_path.rsplit("/", 1)[-1]: r for r in I.gate(read_headers(spark, tmpdir_str)).collect()}
    assert {n for n, r in gated.items() if r.accepted} == {"dots.csv", "twice.csv", "own.csv"}
    assert list(gated["price.csv"].missing) == ["price"] and len(gated["blank.csv"].missing) == 8
    assert list(gated["twice.csv"].extras) == ["note8", "Note9", "_c10", "_c11"]
    for with_bad in (False, True):
        sales = I.load_accepted(spark, I.gate(read_headers(spark, tmpdir_str)), with_source=True, with_bad=with_bad)
        got = {r.source_file.rsplit("/", 1)[-1]: (r.customer_id, str(r.price), r.additional_column) for r in sales.collect()}
        assert got == {"dots.csv": (1, "50.00", "x,y,z"), "twice.csv": (1, "50.00", "p,q,r"), "own.csv": (1, "50.00", "s,t,u")}


def test_drops_are_written_from_sales_joined_once(spark, tmpdir_str, monkeypatch):
    """No drop joins the star tables again, and each has its rows."""
    sales = [(i, i % 3, f"p, {i}", None, i % 5, None, i, None, None, "R", "O", s) for i, s in enumerate("FFFOOPX" * 9 + "F")]
    rows = spark.createDataFrame(sales, StructType([*SALES.fields]).add("l_returnflag", "string").add("l_linestatus", "string").add("o_orderstatus", "string"))
    joined = rows.join(spark.createDataFrame([("F",), ("O",), ("P",), ("X",)], "o_orderstatus string"), "o_orderstatus")
    monkeypatch.setattr(landing, "star_sales_with_status", lambda *_: joined)
    plans, write = [], landing._write_csv
    monkeypatch.setattr(landing, "_write_csv", lambda df, *more, **kw: (
        plans.append(df._jdf.queryExecution().optimizedPlan().toString()), write(df, *more, **kw)))
    root = landing.land(spark, "none", tmpdir_str, duplicate_clean=True)
    assert len(plans) == 5 and not any("Join" in p for p in plans)

    def names(folder):
        return sorted(r.product_name for r in spark.read.option("header", "true").csv(f"{root}/{folder}").collect())
    for status in "FOP":
        assert names(f"status={status}") == sorted(r[2] for r in sales if r[-1] == status)
    assert names("copy/status=F") == names("decoy_gz") == names("status=F")
    assert spark.read.text(f"{root}/decoy_txt").count() == 28
