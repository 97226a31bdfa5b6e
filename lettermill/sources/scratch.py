"""Folders for what one step of a plan writes and the next reads."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it in ``spark.checkpoint.dir``.

    Without one, a session on one machine gets a temporary folder, which is set as its own; a cluster is an error.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not (context.master == "local" or context.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='lettermill-')}")
    return context._jsc.sc().getCheckpointDir().get().rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A folder name in shared storage that no other run uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
