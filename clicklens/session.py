"""Session construction and the shared scratch location.

On a cluster the session is built by the caller and ``spark.checkpoint.dir`` names a folder that
every executor can reach (HDFS, S3, ...). Scratch data that must outlive a task (stream input
batches, keyed state tables, lineage cuts) goes below that folder. Only when it is unset -- as in
local tests -- do we pick our own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of ours uses; the values are Spark's public configuration keys.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "clicklens",
                  extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench; on a cluster use the session you are given."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not _configured_dir(spark):
        _set_dir(spark, tempfile.mkdtemp(prefix="clicklens-cp-"))
    return spark


def _configured_dir(spark: SparkSession) -> str | None:
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        try:  # a directory set with SparkContext.setCheckpointDir (classic sessions only)
            d = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001 - e.g. a Spark Connect session has no SparkContext
            d = None
    return d or None


def _set_dir(spark: SparkSession, path: str) -> None:
    spark.conf.set("spark.checkpoint.dir", path)
    try:
        spark.sparkContext.setCheckpointDir(path)
    except Exception:  # noqa: BLE001 - no SparkContext (Spark Connect): the conf is enough for us
        pass


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh path below the cluster's shared checkpoint folder.

    Reads ``spark.checkpoint.dir`` from the session; sets a local one only where it is unset.
    Each call with no ``parts`` returns a new unique sub-folder.
    """
    base = _configured_dir(spark)
    if not base:
        # executors of a cluster do not share a local folder: only a local master may go without one
        if not spark.conf.get("spark.master", "local").startswith("local") or spark.conf.get(
                "spark.master", "local").startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="clicklens-cp-")
        _set_dir(spark, base)
    base = base.rstrip("/")
    sub = "/".join(parts) if parts else f"run-{uuid.uuid4().hex[:12]}"
    return f"{base}/clicklens/{sub}"
