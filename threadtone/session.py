"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession

_OWN_FOLDERS: dict[str, str] = {}


def build_session(
    app: str = "threadtone",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    options: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings the library counts on.

    Days are cut in the session time zone, so it is pinned.  Adaptive execution
    splits hot join keys and merges small shuffle partitions; on a cluster give
    ``shuffle_partitions`` as input bytes / 128 MB and let it merge downwards.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", shuffle_partitions)
    for key, value in (options or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Where intermediate tables go: the folder ``spark.checkpoint.dir`` names.

    All executors must see it and it must outlive them.  Only a local session
    without the setting gets a folder of its own, as in tests.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not (context.master == "local" or context.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _OWN_FOLDERS:
        _OWN_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="threadtone-")
    return _OWN_FOLDERS[context.applicationId]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has been written to yet."""
    return f"{shared_folder(spark)}/{name}-{uuid4().hex}"
