"""Where written intermediate tables go."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the shared folder named by spark.checkpoint.dir.

    Only a local session without that setting falls back to a temporary folder; on a cluster
    executors could not read one another's files there, so the setting is required. The caller
    removes these folders; nothing here does.
    """
    root = spark.conf.get(_SETTING, None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError(f"set {_SETTING} to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="tripmill-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
