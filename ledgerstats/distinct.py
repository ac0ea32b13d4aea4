"""Exact distinct counts of any range of days from sets that are stored by day.

Each id gets a number, dense from 1, when it is first seen. A day's distinct ids are then bits:
rows of 32,768 numbers each, four kilobytes, as Spark's bitmap functions make them. The set of a
week is the union of its days' sets, so counting it reads no transaction again, and a rebuild
counts bits in place of ids.
"""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerstats import files
from ledgerstats.commits import Version
from ledgerstats.functions.calendar import as_date
from ledgerstats.logged import Inserted, LoggedStore
from ledgerstats.operators.periods import Period, one_row_per_period
from ledgerstats.schemas import DerivedTable

NUMBERS, SETS = "numbers_of_ids", "daily_sets"
TABLES: dict[str, DerivedTable] = {
    NUMBERS: DerivedTable(
        T.StructType([T.StructField("id", T.StringType()), T.StructField("number", T.LongType())]),
        key=("id",),
    ),
    SETS: DerivedTable(
        T.StructType(
            [
                T.StructField("day", T.DateType()),
                T.StructField("bucket", T.LongType()),
                T.StructField("bits", T.BinaryType()),
            ]
        ),
        key=("day", "bucket"),
        dated_by="day",
    ),
}
_PART_BITS = 33  # of a monotonically increasing id: the row within its task


class DistinctSets:
    """The stored sets of one kind of id below a root; several writers may add to them."""

    def __init__(self, store: LoggedStore):
        self.store = store
        self.spark = store.spark

    @classmethod
    def at(cls, spark, root: str, **options) -> DistinctSets:
        return cls(LoggedStore(spark, root, TABLES, **options))

    def add(self, ids: DataFrame, days: Period) -> None:
        """Store the sets of the days of `ids` (period, id), all ids of each day; a day that is
        stored stays as it is."""
        path = f"{self.store.root}/staged/{uuid.uuid4().hex}"
        ids.filter(F.col("id").isNotNull()).distinct().write.parquet(path)
        try:
            daily = self.spark.read.schema(ids.schema).parquet(path)
            self.number(daily.select("id").distinct())
            numbered = daily.join(self.store.read(NUMBERS), "id")
            bits = numbered.groupBy(
                as_date("period").alias("day"), F.bitmap_bucket_number("number").alias("bucket")
            ).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))
            self.store.insert(SETS, bits, days)
        finally:
            files.delete(self.spark, path)

    def number(self, ids: DataFrame) -> Inserted:
        """Give each new id the next number. Where another writer has numbered some meanwhile,
        the rest is numbered anew after its numbers."""
        rows = ids.withColumn("number", F.lit(0).cast("long"))
        return self.store.insert(NUMBERS, rows, complete=self._numbered)

    def _numbered(self, rows: DataFrame, base: Version) -> DataFrame:
        """`rows` numbered on from the rows that the version has."""
        so_far = sum(part.rows for part in base.parts)
        rows = rows.select("id", F.monotonically_increasing_id().alias("place"))
        part = F.shiftright("place", _PART_BITS).alias("part")
        # A row a task, from which follows where the numbers of each begin.
        counts = rows.groupBy(part).agg(F.count("*").alias("n"), F.min("place").alias("first"))
        earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        begins = counts.select(
            "part", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("begin")
        )
        placed = rows.select("id", "place", part).join(F.broadcast(begins), "part")
        number = F.lit(so_far + 1) + F.col("begin") + F.col("place") - F.col("first")
        return placed.select("id", number.alias("number"))

    def counts(self, period: Period, name: str) -> DataFrame:
        """(collected_for_day or _week, name): the distinct ids of each day or week of `period`,
        0 where there are none."""
        day = F.unix_date("day").cast("bigint")
        start = day if period.unit == "day" else day - F.pmod(day + 3, F.lit(7))
        first, stop = (F.date_from_unix_date(F.lit(d)) for d in (period.first, period.stop))
        union = (
            self.store.read(SETS)
            .filter((F.col("day") >= first) & (F.col("day") < stop))
            .groupBy(start.alias("period"), "bucket")
            .agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
        )
        counts = union.groupBy("period").agg(F.sum("n").cast("int").alias(name))
        return one_row_per_period(counts, period, f"collected_for_{period.unit}")


def days_of(period: Period) -> Period:
    """The days of a range of weeks."""
    return replace(period, unit="day")
