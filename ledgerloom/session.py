"""Spark session settings and the folder that all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

_local_dirs: dict[str, str] = {}


def build_session(app_name: str = "ledgerloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session for the batch job; a cluster's own settings win over nothing but the ones listed here."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder for tables written between stages: ``spark.checkpoint.dir`` as set on the session.

    Only a local-mode session without that setting gets a temporary folder, because there every
    task runs on this machine. On a cluster a missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not (spark.conf.get("spark.master", None) or "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="ledgerloom-")
    return _local_dirs[app]
