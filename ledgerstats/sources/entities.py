from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstats.schemas import ENTITY_RECORD


def read_entities(spark: SparkSession, path: str) -> DataFrame:
    """The entity catalogue from a landed JSON document: an array of objects.

    Each file is parsed as a stream by one task, in record order. A missing field
    is NULL; a malformed document fails the job.
    """
    records = (
        spark.read.schema(ENTITY_RECORD)
        .option("multiLine", True)
        .option("mode", "FAILFAST")
        .json(path)
    )
    return records.withColumn("_position", F.monotonically_increasing_id())
