"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_FALLBACK_KEY = "parchline.shared.dir"


def build_session(app: str = "parchline", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators rely on.

    Shuffle width is left to the caller (``spark.sql.shuffle.partitions``): AQE merges small
    partitions downwards, so a cluster should set it generously.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a local session may fall back to a folder of its own; on a cluster a missing setting is
    an error, because a machine-local folder would be lost with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(_FALLBACK_KEY, None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="parchline-")
    spark.conf.set(_FALLBACK_KEY, root)
    return root


def fresh_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder name under the shared folder."""
    return os.path.join(shared_root(spark), f"{purpose}-{uuid.uuid4().hex}")
