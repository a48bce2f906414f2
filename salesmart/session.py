"""Session and scratch-location helpers.

The library never changes a caller's session configuration. ``local_session``
is for tests and the bench only. Scratch output (round trips, ledgers,
streaming checkpoints) goes under the shared folder the cluster names in
``spark.checkpoint.dir``; a local folder is chosen only when that setting is
unset, as in tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "salesmart",
                  event_log_dir: str | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SALESMART_DRIVER_MEMORY", "8g"))
    )
    if event_log_dir:
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


class NoCheckpointDir(RuntimeError):
    """A cluster session without ``spark.checkpoint.dir``."""


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Taken from the session (``spark.checkpoint.dir``). Only a ``local[...]``
    session without one (tests, the bench) gets a fresh temporary folder; on a
    cluster a machine-local folder would not be shared by the executors, so a
    missing setting raises instead.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not sc.master.startswith("local"):
                raise NoCheckpointDir("set spark.checkpoint.dir to a folder shared by all executors")
            root = tempfile.mkdtemp(prefix="salesmart-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory URI under the checkpoint root."""
    return f"{checkpoint_root(spark).rstrip('/')}/salesmart/{name}/{uuid.uuid4().hex}"
