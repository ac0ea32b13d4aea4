"""Which periods are computed, and the bounds and rows they give.

Bounds become literals on the raw nanosecond columns, so they reach the Parquet
scan. Only two numbers, the first and last block time, are read to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstats.functions.calendar import (
    DAY_NS,
    DAY_SECONDS,
    PERIOD_DAYS,
    SECOND_NS,
    as_date,
    period_of,
    period_start,
)
from ledgerstats.functions.wide import WIDE
from ledgerstats.functions.wide import zero as wide_zero

# Fixed value: a period is complete once the ledger is this far past its end, and
# receipts up to this long after a day still belong to the day's transactions.
GRACE_SECONDS = 600
GRACE_NS = GRACE_SECONDS * SECOND_NS


@dataclass(frozen=True)
class Period:
    """The days or weeks that start in `[first, stop)`, as day numbers."""

    unit: str
    first: int
    stop: int

    @property
    def from_ns(self) -> int:
        return self.first * DAY_NS

    @property
    def to_ns(self) -> int:
        return self.stop * DAY_NS

    @property
    def is_empty(self) -> bool:
        return self.first >= self.stop

    def of(self, time_ns: str) -> Column:
        """The period of each row, to group by."""
        return period_of(time_ns, self.unit).alias("period")


@dataclass(frozen=True)
class Extent:
    """Time of the first and of the last block, in nanoseconds."""

    first_ns: int
    last_ns: int


def ledger_extent(blocks: DataFrame, computed: bool = False) -> Extent | None:
    """From the blocks, or from the one row (first_ns, last_ns) that a source has computed."""
    if not computed:
        blocks = blocks.agg(
            F.min("block_timestamp").alias("first_ns"), F.max("block_timestamp").alias("last_ns")
        )
    row = blocks.select(*[F.col(c).cast("long") for c in ("first_ns", "last_ns")]).first()
    return None if row["first_ns"] is None else Extent(row["first_ns"], row["last_ns"])


def all_periods(extent: Extent | None, unit: str) -> Period:
    """Every complete period, from the one that holds the first block."""
    if extent is None:
        return Period(unit, 0, 0)
    first = period_start(extent.first_ns // DAY_NS, unit)
    return Period(unit, first, max(first, _complete_until(extent, unit)))


def one_period(extent: Extent | None, unit: str, timestamp: int) -> Period:
    """The period that holds `timestamp` (epoch seconds); empty while it is incomplete."""
    first = period_start(timestamp // DAY_SECONDS, unit)
    stop = first + PERIOD_DAYS[unit]
    complete = extent is not None and stop <= _complete_until(extent, unit)
    return Period(unit, first, stop if complete else first)


def _complete_until(extent: Extent, unit: str) -> int:
    seconds = extent.last_ns // SECOND_NS
    return period_start((seconds - GRACE_SECONDS) // DAY_SECONDS, unit)


def between(df: DataFrame, time_ns: str, from_ns: int, to_ns: int) -> DataFrame:
    """Rows in the half-open range."""
    return df.filter((F.col(time_ns) >= F.lit(from_ns)) & (F.col(time_ns) < F.lit(to_ns)))


def spine(spark: SparkSession, period: Period, name: str) -> DataFrame:
    """One row per period: its day number and, under `name`, its date."""
    step = PERIOD_DAYS[period.unit]
    days = spark.range(period.first, period.stop, step, numPartitions=1)
    return days.select(F.col("id").alias("period"), as_date("id").alias(name))


def one_row_per_period(values: DataFrame, period: Period, name: str) -> DataFrame:
    """Complete results keyed by `period` with a zero for each period without a row.

    `values` is grouped by period, so it holds at most one row per day of the
    ledger's life: that is the bound on what is broadcast here.
    """
    (value,) = [field for field in values.schema.fields if field.name != "period"]
    if value.dataType == WIDE:
        zero = wide_zero()
    else:
        text = value.dataType.simpleString() == "string"
        zero = F.lit("0" if text else 0).cast(value.dataType)
    return (
        spine(values.sparkSession, period, name)
        .join(F.broadcast(values), "period", "left")
        .select(name, F.coalesce(F.col(value.name), zero).alias(value.name))
    )


def rows_per_period(values: DataFrame, name: str) -> DataFrame:
    """Results keyed by `period` and more, with the period's date in front."""
    return values.select(
        as_date("period").alias(name), *[c for c in values.columns if c != "period"]
    )
