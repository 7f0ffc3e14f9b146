"""Where written intermediate tables go."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="plumbline-")


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the shared folder the session names.

    The folder comes from ``spark.checkpoint.dir``, which on a cluster must be
    storage all executors see. Only a local session without that setting (a
    test) falls back to a temporary folder of its own.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
        base = _local_folder()
    return f"{base.rstrip('/')}/plumbline/{label}-{uuid.uuid4().hex}"
