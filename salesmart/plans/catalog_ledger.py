"""Registered queries of the file ledger.

The file listing comes from the whole ``orders`` table: one landing file per
(order status, order month), ``landing/<status>/<YYYY-MM>.csv``; the same base
name exists under every status, so keying on the full path is exercised.

Scenario: run 1 activates the ``F`` and ``O`` files and completes only ``F``
(it crashes before ``O``); run 2 lists every file, resets what run 1 left
Active, activates all and completes all.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from salesmart.functions.columns import month_of
from salesmart.operators import ledger as L
from salesmart.plans.registry import register
from salesmart.session import scratch_dir
from salesmart.sources.star import table

RUN1 = dt.datetime(2025, 1, 1, 8, 0, 0)
RUN2 = dt.datetime(2025, 1, 2, 8, 0, 0)

_FILES_SQL = """
WITH files AS (
  SELECT DISTINCT o_orderstatus AS st,
         'landing/' || o_orderstatus || '/' || substr(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), 1, 7) || '.csv'
           AS file_location,
         substr(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), 1, 7) || '.csv' AS file_name
  FROM orders
)
"""


def listing(spark, d):
    o = table(spark, d, "orders")
    month = month_of(F.to_date("o_orderdate"))
    return o.select(
        F.concat(F.lit("landing/"), F.col("o_orderstatus"), F.lit("/"), month, F.lit(".csv"))
        .alias("file_location"),
        F.col("o_orderstatus").alias("st"),
    ).distinct()


def _run1(spark, d, root, complete_f=True):
    files = listing(spark, d)
    L.activate(files.where(F.col("st").isin("F", "O")), root, "run1", RUN1)
    if complete_f:
        L.complete(files.where(F.col("st") == "F"), root, "run1", RUN1 + dt.timedelta(minutes=5))
    return files


def _state(spark, root):
    return L.current_state(L.events(spark, root)).select("file_location", "file_name", "status", "n_events")


@register("ledger_activate", _FILES_SQL + """
SELECT file_location, file_name, 'A' AS status, CAST(1 AS BIGINT) AS n_events
FROM files WHERE st IN ('F', 'O')""")
def q_ledger_activate(spark, d):
    """L1: after run 1's activation every accepted file is Active once."""
    root = scratch_dir(spark, "ledger_activate")
    _run1(spark, d, root, complete_f=False)
    return _state(spark, root)


@register("ledger_inflight", _FILES_SQL + "SELECT file_location FROM files WHERE st = 'O'")
def q_ledger_inflight(spark, d):
    """Files of the full listing that run 1 left Active."""
    root = scratch_dir(spark, "ledger_inflight")
    files = _run1(spark, d, root)
    return L.inflight(files, L.events(spark, root))


@register("ledger_reset", _FILES_SQL + """
SELECT file_location, file_name, 'I' AS status, CAST(2 AS BIGINT) AS n_events
FROM files WHERE st IN ('F', 'O')""")
def q_ledger_reset(spark, d):
    """L3: run 2 turns run 1's left-over Active files Inactive."""
    root = scratch_dir(spark, "ledger_reset")
    files = _run1(spark, d, root)
    L.reset(spark, files, root, "run2", RUN2)
    return _state(spark, root)


@register("ledger_complete", _FILES_SQL + """
SELECT file_location, file_name, 'I' AS status,
       CAST(CASE WHEN st = 'P' THEN 2 ELSE 4 END AS BIGINT) AS n_events
FROM files""")
def q_ledger_complete(spark, d):
    """L4: after run 2 every listed file is Inactive; history is kept."""
    root = scratch_dir(spark, "ledger_complete")
    files = _run1(spark, d, root)
    L.reset(spark, files, root, "run2", RUN2)
    L.activate(files, root, "run2", RUN2 + dt.timedelta(minutes=1))
    L.complete(files, root, "run2", RUN2 + dt.timedelta(minutes=9))
    return _state(spark, root)


@register("ledger_compacted", _FILES_SQL + """
SELECT file_location, file_name, CASE WHEN st = 'F' THEN 'A' ELSE 'I' END AS status,
       CAST(CASE WHEN st = 'P' THEN 2 WHEN st = 'O' THEN 4 ELSE 5 END AS BIGINT) AS n_events
FROM files""")
def q_ledger_compacted(spark, d):
    """After both runs their days are merged; run 3 finds nothing in flight and
    activates the ``F`` files again. State and history are as without merging."""
    root = scratch_dir(spark, "ledger_compacted")
    files = _run1(spark, d, root)
    L.reset(spark, files, root, "run2", RUN2)
    L.activate(files, root, "run2", RUN2 + dt.timedelta(minutes=1))
    L.complete(files, root, "run2", RUN2 + dt.timedelta(minutes=9))
    L.compact(spark, root, RUN2 + dt.timedelta(days=1))
    L.reset(spark, files, root, "run3", RUN2 + dt.timedelta(days=2))
    L.activate(files.where(F.col("st") == "F"), root, "run3", RUN2 + dt.timedelta(days=2, minutes=1))
    return _state(spark, root)
