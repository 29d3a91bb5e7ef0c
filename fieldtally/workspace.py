"""Where a run keeps checkpoints and written tables."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession


def run_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder in the shared folder that the session names.

    Only a local session may go without ``spark.checkpoint.dir``; on a cluster a folder of the
    driver's machine would be out of the executors' sight.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="fieldtally-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid4().hex}"
