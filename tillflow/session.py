"""Spark session defaults and the shared checkpoint / warehouse location."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Session settings every job relies on. Dates are pinned to UTC so that DATE
# values never shift, and ANSI mode stays on (bad input must go through the
# try_* functions, never raise).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast joins only from measured sizes: no static (file-size estimate)
    # broadcast; AQE turns a join into a broadcast join once the materialised
    # side is known to be small. Explicit broadcast() is used only for the
    # 25-row geography and for per-partition offsets.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "16MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoints written by the ordering / quantile helpers are removed once
    # the DataFrames that use them are garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tillflow") -> SparkSession:
    """Session for local runs and tests; on a cluster use the provided session."""
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TILLFLOW_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
    )
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def configure(spark: SparkSession, conf: dict | None = None) -> SparkSession:
    """Apply the engine's runtime SQL settings to a session someone else built.

    Only SQL settings that can change at runtime are set (a cluster's
    checkpoint folder and resources are left alone).
    """
    for key, value in (conf or DEFAULT_CONF).items():
        if key.startswith("spark.sql."):
            spark.conf.set(key, value)
    return spark


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Runtime SQL settings for a block; afterwards they are as they were."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shuffles_dropped(spark: SparkSession):
    """A block whose writes remove their shuffle files once they are done.

    Spark keeps them until the driver happens to collect its garbage. A job of
    several writes would hold the shuffles of all of them, many times the input,
    while only the written tables are read again.
    """
    return settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that setting
    is always respected. Only when it is unset and the master is local (local
    runs, tests) is a fresh scratch folder created: on a cluster one machine's
    disk would hold tables that the other machines cannot read.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="tillflow-ckpt-", dir="/tmp")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for job-owned tables next to the checkpoint data (shared storage)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tillflow-tables/{name}"
