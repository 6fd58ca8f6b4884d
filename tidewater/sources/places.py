"""Where the engine's own files go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path under spark.checkpoint.dir, which a cluster's machines share; a local one only where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all machines share")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/tidewater/{name}-{uuid.uuid4().hex}"
