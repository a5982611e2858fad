"""Session construction and the shared workspace.

All state the engine keeps between runs (checkpoints, staged runs, ledgers,
remembered schemas, tables written by the scenarios) lives under the folder the
cluster names in ``spark.checkpoint.dir``.  Only when that setting is absent --
a laptop or a unit test -- do we fall back to a fresh temporary folder and set
it as the context's checkpoint directory.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "landfall") -> SparkSession:
    """Session used by tests and the benchmark; clusters bring their own."""
    return (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def workspace(spark: SparkSession) -> str:
    """Root folder for engine state, on the cluster's shared checkpoint storage."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="landfall-"))
        root = spark.sparkContext.getCheckpointDir()
    return f"{root.rstrip('/')}/landfall"


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder under the workspace."""
    return f"{workspace(spark)}/{label}-{uuid.uuid4().hex[:12]}"


@contextmanager
def session_conf(spark: SparkSession, key: str, value: str):
    """Set a SQL conf for the statements planned inside the block."""
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)
