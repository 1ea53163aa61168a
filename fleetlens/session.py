"""Session construction and the settings every job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the jobs assume; all are runtime-settable SQL confs.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str = "local[*]", app: str = "fleetlens",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Builder used by tests and bench; clusters pass their own settings."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {**RUNTIME_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_session(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session someone else built."""
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession, default: str | None = None) -> str:
    """Shared lineage-cut folder: the cluster's ``spark.checkpoint.dir``.

    Only when the session has none (tests, a laptop) is ``default`` installed.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir() if hasattr(spark.sparkContext, "getCheckpointDir") else None
    if not d:
        if default is None:
            raise RuntimeError("spark.checkpoint.dir is not set and no default was given")
        spark.sparkContext.setCheckpointDir(default)
        spark.conf.set("spark.checkpoint.dir", default)
        d = default
    return d


def _single_jvm(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local"


def has_shared_folder(spark: SparkSession) -> bool:
    """Whether ``shared_folder`` finds one."""
    return bool(spark.conf.get("spark.checkpoint.dir", None)) or _single_jvm(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's ``spark.checkpoint.dir``.

    Only a session without one that runs in a single JVM (tests, a laptop) gets a folder of its own.
    """
    if spark.conf.get("spark.checkpoint.dir", None):
        return checkpoint_dir(spark).rstrip("/")
    if _single_jvm(spark):
        return checkpoint_dir(spark, os.path.join(tempfile.gettempdir(), "fleetlens-checkpoints")).rstrip("/")
    raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
