"""Small literal ledgers for the edge cases."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerstats.functions.calendar import DAY_NS, SECOND_NS
from ledgerstats.operators.periods import GRACE_NS
from ledgerstats.plans.registry import compute
from ledgerstats.schemas import ENTITY_RECORD, SOURCE_TABLES
from ledgerstats.sources.base import LedgerSource

MONDAY = 19723  # 2024-01-01
START = MONDAY * DAY_NS


def at(day: int = 0, seconds: int = 0, ns: int = 0) -> int:
    """Nanoseconds at a time of the ledger's day 0, 1, ..."""
    return START + day * DAY_NS + seconds * SECOND_NS + ns


class LiteralLedger(LedgerSource):
    """Rows given by table name; blocks by default make `days` days complete."""

    def __init__(self, spark: SparkSession, days: int = 1, entities=(), **rows):
        super().__init__(spark)
        self.rows = {
            "blocks": [("first", at(), Decimal(1)), ("last", at(days) + GRACE_NS, Decimal(1))],
            **rows,
        }
        self.records = list(entities)

    def stored(self, name: str) -> DataFrame:
        return self.spark.createDataFrame(self.rows.get(name, []), SOURCE_TABLES[name])

    def entities(self) -> DataFrame:
        names = ENTITY_RECORD.fieldNames()
        schema = T.StructType(ENTITY_RECORD.fields + [T.StructField("_position", T.LongType())])
        rows = [
            tuple(record.get(name) for name in names) + (position,)
            for position, record in enumerate(self.records)
        ]
        return self.spark.createDataFrame(rows, schema)


def rows(df: DataFrame) -> list[tuple]:
    return sorted(tuple(row) for row in df.collect())


def values(df: DataFrame) -> list:
    """Values of a one-column-per-period result, in period order."""
    return [row[1] for row in rows(df)]


def result(ledger: LedgerSource, name: str, timestamp: int | None = None) -> list[tuple]:
    return rows(compute(ledger, name, timestamp))
