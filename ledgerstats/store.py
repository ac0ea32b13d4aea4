"""Stored derived tables: Parquet directories that only gain rows, or are replaced whole.

A table is `<root>/<name>/v<number>`. A rebuild writes the next version and readers move
to it once Spark has marked it complete, so they never see a half-written or missing
table; the version before stays for queries already running. There is one writer per
table: Parquet has no transactions between writers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstats import files
from ledgerstats.operators.firstwrite import new_rows
from ledgerstats.operators.periods import Period
from ledgerstats.schemas import DERIVED_TABLES, DerivedTable


#: Files, markers included, of a table of one row a period.
MOST_FILES = 32


class Store:
    def __init__(
        self, spark: SparkSession, root: str, tables: dict[str, DerivedTable] = DERIVED_TABLES
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.tables = tables

    def read(self, name: str) -> DataFrame:
        """The table as it is now; empty, with its columns, while nothing is stored."""
        table = self.tables[name]
        versions = self._versions(name)
        if not versions:
            return self.spark.createDataFrame([], table.schema)
        stored = self.spark.read.schema(table.schema).parquet(self._path(name, versions[-1]))
        return stored.select(*table.columns)

    def insert(self, name: str, rows: DataFrame, period: Period | None = None) -> None:
        """Add the rows whose key is not stored yet; the rows are unique on the key.

        `period` is the one the rows belong to: where the key fixes a row's time, only
        that period's stored keys are read. Repeating an insert that was cut short
        completes it.
        """
        versions = self._versions(name)
        if not versions:
            self.replace(name, rows)
            return
        table = self.tables[name]
        stored = self.read(name)
        if period is not None and table.dated_by:
            stored = stored.filter(within(period, table.schema[table.dated_by]))
        fresh = new_rows(stored, declared_rows(name, table, rows), table.key)
        path = self._path(name, versions[-1])
        self._write(table, fresh, path)
        one_row_a_period = table.key == (table.dated_by,)
        if one_row_a_period and len(files.children(self.spark, path)) > MOST_FILES:
            self.compact(name)

    def compact(self, name: str) -> None:
        """Write the table's rows anew in as few files as their size asks for.

        A table of one row a period does so by itself once it has more than `MOST_FILES`
        files; for a larger one the caller decides when rewriting it is worth while.
        """
        self.replace(name, self.read(name))

    def replace(self, name: str, rows: DataFrame) -> None:
        """Make the rows the whole table."""
        table = self.tables[name]
        before, numbers = self._versions(name)[-1:], self._numbers(name)
        number = max(numbers, default=0) + 1
        self._write(table, declared_rows(name, table, rows), self._path(name, number))
        for old in set(numbers) - set(before):
            files.delete(self.spark, self._path(name, old))

    def drop(self, name: str) -> None:
        files.delete(self.spark, f"{self.root}/{name}")

    def _path(self, name: str, number: int) -> str:
        return f"{self.root}/{name}/v{number:08d}"

    def _numbers(self, name: str) -> list[int]:
        names = files.children(self.spark, f"{self.root}/{name}")
        return [int(n[1:]) for n in names if n.startswith("v") and n[1:].isdigit()]

    def _versions(self, name: str) -> list[int]:
        """Complete versions, oldest first."""
        return [
            number
            for number in self._numbers(name)
            if files.exists(self.spark, f"{self._path(name, number)}/_SUCCESS")
        ]

    @staticmethod
    def _write(table: DerivedTable, rows: DataFrame, path: str) -> None:
        """A table of many rows per day is kept by day: `rebalance` gathers a day's rows
        into few files and still splits a day too large for one task."""
        if table.partition_by is None:
            rows.hint("rebalance").write.mode("append").parquet(path)
            return
        (
            rows.hint("rebalance", table.partition_by)
            .sortWithinPartitions(*table.key)
            .write.mode("append")
            .partitionBy(table.partition_by)
            .parquet(path)
        )


def within(period: Period, field: T.StructField) -> Column:
    if isinstance(field.dataType, T.DateType):
        first, stop = (F.date_from_unix_date(F.lit(d)) for d in (period.first, period.stop))
    else:
        first, stop = F.lit(period.from_ns), F.lit(period.to_ns)
    return (F.col(field.name) >= first) & (F.col(field.name) < stop)


def declared_rows(name: str, table: DerivedTable, rows: DataFrame) -> DataFrame:
    """The declared columns in order; NULL where none is allowed fails the write."""

    def column(field) -> Column:
        value = F.col(field.name).cast(field.dataType)
        if field.name not in table.nullable:
            error = F.raise_error(F.lit(f"NULL in {name}.{field.name}"))
            value = F.when(value.isNull(), error.cast(field.dataType)).otherwise(value)
        return value.alias(field.name)

    return rows.select(*[column(field) for field in table.schema.fields])
