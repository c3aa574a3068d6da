"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Session defaults every job of this package relies on.  UTC pins toDate() and
# month partitioning; AQE re-plans joins and coalesces shuffle partitions at run
# time and splits skewed join partitions (one hot wallet / block).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(
    master: str | None = None,
    app_name: str = "gasledger",
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    ``master`` is only set when given: on a cluster the launcher decides it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_runtime_defaults(spark: SparkSession) -> None:
    """Turn on AQE and its skew-join split on a session built elsewhere.

    Nothing else of the caller's session is changed: dates and timestamps are
    zone-free by construction, and writers pass their overwrite mode per write.
    """
    for key in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled"):
        spark.conf.set(key, DEFAULT_CONF[key])


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session (the cluster names a shared
    folder there).  Only when it is unset -- local runs and tests -- a folder
    under the session's warehouse directory is registered instead.  Works on
    classic sessions and, without a SparkContext, from the session config.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if sc is not None and not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    if sc is None:
        return configured.rstrip("/")
    sc.setCheckpointDir(configured)
    return (sc.getCheckpointDir() or configured).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A named sub-folder of the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python can look at a local folder (tests only)."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
