"""Spark session defaults and the shared folder that jobs may write scratch tables to."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Without it, every Column operation looks up its place in the calling code.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "caseload", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC dates, ANSI errors and adaptive execution; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder for tables between jobs: `spark.checkpoint.dir`, or else one in the warehouse.

    Nothing is set on the session. On a cluster, a warehouse on the driver's own disk is refused: executors
    would not see what others wrote there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if warehouse.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"name a shared folder in spark.checkpoint.dir: {warehouse} is the driver's own disk")
    return f"{warehouse}/_between_jobs"


def shared_folder(spark: SparkSession) -> str:
    """A fresh sub-folder of the shared root."""
    return f"{shared_root(spark)}/caseload-{uuid.uuid4().hex}"
