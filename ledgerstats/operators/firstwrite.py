"""First write wins: rows whose key is already stored never change it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def first_per_key(rows: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    Catalyst keeps the first row per key before the shuffle as well as after it
    (`WindowGroupLimit`), so a hot key reaches its task as one row per input task.
    """
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


def new_rows(stored: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows of a batch, itself unique on `key`, whose key is not stored yet."""
    return batch.join(stored.select(*key), list(key), "left_anti").select(*batch.columns)


def insert_only(
    stored: DataFrame, batch: DataFrame, key: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """The table after inserting a batch that may repeat keys."""
    return stored.unionByName(new_rows(stored, first_per_key(batch, key, order), key))
