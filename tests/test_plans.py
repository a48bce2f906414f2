"""Plan-shape checks: no Window in the customer mart, pruned scans, broadcast
semi joins when bounded, partition pruning on the partitioned mart."""

from inputs import SF_SMALL
from salesmart.operators import enrich as E
from salesmart.operators import marts as M
from salesmart.sinks import writers as W
from salesmart.sources.star import star_inputs


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _explain(df):
    import io
    import contextlib
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_customer_mart_has_no_window_and_no_fact_shuffle_before_partial_agg(spark):
    df = M.customer_mart(*star_inputs(spark, SF_SMALL))
    text = _explain(df)
    assert "Window" not in text
    assert "LeftSemi" in text and "BroadcastHashJoin" in text


def test_lineitem_scan_is_pruned(spark):
    text = _explain(M.sales_team_mart(*star_inputs(spark, SF_SMALL)))
    line = [ln for ln in text.splitlines() if "ReadSchema" in ln and "l_orderkey" in ln][0]
    assert "l_shipdate" not in line and "l_comment" not in line and "l_tax" not in line


def test_shuffled_semi_path_preaggregates(spark):
    s, c, st, t = star_inputs(spark, SF_SMALL)
    dims = {"customer": c, "store": st, "sales_team": t}
    checks = [(dims[d], *M._DIMS[d]) for d in ("customer", "store")]
    monthly = M._restricted_monthly(s, checks, [False, False], ["store_id", "sales_person_id", "month"])
    text = _explain(monthly)
    assert "LeftSemi" in text
    # pre-aggregate (partial/final) below the semi joins, final sum (partial/final) above them
    assert text.count("HashAggregate") >= 4
    below = text.split("LeftSemi")[-1]
    assert "HashAggregate" in below


def test_unbounded_team_takes_range_split_rank(spark):
    df = M.sales_team_mart(*star_inputs(spark, SF_SMALL), max_rows=0)
    assert "_rank_part" in df._jdf.queryExecution().executedPlan().toString()


def test_partitioned_mart_prunes_partitions(spark, tmpdir_str):
    rows = M.sales_mart_rows(E.enrich(*star_inputs(spark, SF_SMALL)))
    path = f"{tmpdir_str}/mart"
    W.write_partitioned(rows, path)
    df = spark.read.parquet(path).where("sales_month = '1996-03' AND store_id = 3")
    text = _explain(df)
    assert "PartitionFilters" in text and "sales_month" in text.split("PartitionFilters")[1].splitlines()[0]
    month_rows = rows.where("sales_month = '1996-03' AND store_id = 3").count()
    assert df.count() == month_rows


def test_every_sum_has_its_own_exchange_when_nothing_is_broadcast(spark):
    """At scale no side is broadcast. Then no final sum may reuse a join's
    partitioning (that would put a hot join key in one task and stop AQE from
    splitting it): each one reads an exchange of partial sums."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        s, c, st, t = star_inputs(spark, SF_SMALL)
        dims = {"customer": c, "store": st, "sales_team": t}
        team_checks = [(dims[d], *M._DIMS[d]) for d in ("customer", "store")]
        frames = {
            "sales-team monthly": M._restricted_monthly(s, team_checks, [False, False],
                                                        ["store_id", "sales_person_id", "month"]),
            "customer mart": M.customer_mart(s, c, st, t, max_rows=0),
        }
        for name, df in frames.items():
            plan = df._jdf.queryExecution().executedPlan().toString()
            lines = [ln.lstrip(" :+-") for ln in plan.splitlines()]
            finals = [i for i, ln in enumerate(lines)
                      if ln.startswith("HashAggregate") and "sum(" in ln and "partial_sum(" not in ln]
            assert finals, name
            for i in finals:
                assert lines[i + 1].startswith("Exchange"), f"{name}: sum over {lines[i + 1][:70]}"
                assert "partial_sum(" in lines[i + 2], f"{name}: no partial sum below {lines[i + 1][:70]}"
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_row_form_sums_have_their_own_exchange_when_nothing_is_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        s, c, st, t = star_inputs(spark, SF_SMALL)
        frames = {
            "sales parts": M.sales_parts(M.sales_mart_rows(E.enrich(s, c, st, t, max_rows=0,
                                                                    order=E.FOR_SALES_TEAM))),
            "customer parts": M.customer_parts(M.customer_mart_rows(E.enrich(s, c, st, t, max_rows=0))),
        }
        for name, df in frames.items():
            lines = [ln.lstrip(" :+-") for ln in df._jdf.queryExecution().executedPlan().toString().splitlines()]
            finals = [i for i, ln in enumerate(lines)
                      if ln.startswith("HashAggregate") and "sum(" in ln and "partial_sum(" not in ln]
            assert finals, name
            for i in finals:
                assert lines[i + 1].startswith("Exchange"), f"{name}: sum over {lines[i + 1][:70]}"
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_broadcast_proof_bounds_rows_and_bytes(spark):
    from salesmart.plans.joins import size_at_most, small_enough
    df = spark.createDataFrame([(i, "x" * 1000) for i in range(100)], "id long, s string")
    assert size_at_most(df, 100, 200_000)            # 100 rows, ~100.8 KB
    assert not size_at_most(df, 99, 10 ** 9)         # one row too many
    assert not size_at_most(df, 100, 50_000)         # rows fit, bytes do not
    assert small_enough([df, df.limit(10)], 50) == [False, True]
    assert small_enough([df], 0) == [False]


def test_size_check_shuffles_partial_sums_only(spark):
    from salesmart.plans.joins import size_sums
    df = spark.range(0, 1000, 1, 8).selectExpr("id", "cast(id as string) as name")
    plan = size_sums(df)._jdf.queryExecution().executedPlan().toString()
    assert "Limit" not in plan
    below = plan[plan.index("Exchange"):]
    assert "partial_count" in below.splitlines()[1]
