"""Session settings the statistics rely on."""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

SETTINGS = {
    # Calendar days are UTC days.
    "spark.sql.session.timeZone": "UTC",
    # Overflow and malformed numbers fail the job instead of becoming NULL, then 0.
    "spark.sql.ansi.enabled": "true",
    # A hot join key is split over several tasks, also where the aggregation after the
    # join would otherwise reuse the join's partitioning.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # One day of a bounded table filters a table without bounds (at least 10 GB of scan)
    # before that is shuffled. By default Spark tries this for 10 MB of creating side only.
    # A filter takes 32 MB on each executor. Past its number of ids it lets more rows by,
    # up to all: days that large want tables bucketed by receipt id.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "64GB",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "32000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "32000000",
    "spark.sql.optimizer.runtime.bloomFilter.numBits": "268435456",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": "268435456",
}

TARGET_PARTITION_BYTES = 256 * 1024**2
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def configure(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Apply `SETTINGS`; with the input size known, also size shuffles for it.

    The number of partitions a shuffle starts with is in proportion to the input, and at
    least `spark.sql.shuffle.partitions`; each call sets it anew. Every statistic reads a
    few narrow columns, so the shuffle is smaller than the input and adaptive execution
    merges the partitions that turn out small.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    if input_bytes is not None:
        least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.conf.set(INITIAL_PARTITIONS, max(least, shuffle_partitions(input_bytes)))
    return spark


def shuffle_partitions(input_bytes: int) -> int:
    return max(1, math.ceil(input_bytes / TARGET_PARTITION_BYTES))
