"""Folders of their own for tables that a query writes on its way."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below `spark.checkpoint.dir`, which driver and executors share.

    Where that is not set a temporary folder is made, on a local master only.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='ledgerstats-')}"
        spark.sparkContext.setCheckpointDir(folder)
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
