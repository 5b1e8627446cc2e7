"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job needs to give the same answer wherever it runs.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(
    app_name: str = "cadenza", master: str | None = None, **conf: str
) -> SparkSession:
    """Create (or reuse) a UTC, ANSI, adaptive session.

    Width settings such as ``spark.sql.shuffle.partitions`` are left to the cluster
    unless given in ``conf`` (keys with ``__`` in place of ``.``).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new, unused folder for checkpoints and intermediate tables.

    It lies below ``spark.checkpoint.dir``, which a cluster points at shared storage.
    Only a local session may fall back to a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder all executors share.")
        root = tempfile.mkdtemp(prefix="cadenza-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
