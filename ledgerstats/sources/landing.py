"""Ledger tables landed in buckets of their join keys, so that joins on them move no rows.

A landed table is an external catalog table below one root: partitioned by day where it has a
time, bucketed and sorted by the column it is joined on. All of a ledger's tables have the same
number of buckets, so a task joins one bucket of either side, whatever the tables' size.
The values that statistics read in the JSON arguments of actions are columns beside the text,
parsed once, when they are landed.
Landing a period again replaces its days.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstats import files
from ledgerstats.functions.calendar import DAY_NS, as_date, period_of
from ledgerstats.functions.jsonargs import ARGUMENTS, parsed
from ledgerstats.operators.periods import Extent, between
from ledgerstats.schemas import SOURCE_TABLES, TIME_COLUMN
from ledgerstats.sources.base import LedgerSource
from ledgerstats.sources.catalog import CatalogSource
from ledgerstats.sources.parquet import extent_of_files

DAY, ACTIONS = "day", "action_receipt_actions"
_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


@dataclass(frozen=True)
class Layout:
    """How a table is landed: of which ledger table, in buckets of which column, if any.

    Rows without the bucketed column match nothing. They are left out where `keyed` says that
    the copy serves joins alone; elsewhere they are few and share a bucket.
    """

    of: str
    by: str | None = None
    keyed: bool = False

    @property
    def columns(self) -> list[T.StructField]:
        fields = [f for f in SOURCE_TABLES[self.of].fields if not self.keyed or f.name == self.by]
        if self.of == ACTIONS:
            fields += [T.StructField(name, T.StringType()) for name in ARGUMENTS]
        return fields

    @property
    def day_column(self) -> str | None:
        return DAY if self.of in TIME_COLUMN else None


LAYOUTS: dict[str, Layout] = {
    "blocks": Layout("blocks", "block_hash"),
    "chunks": Layout("chunks", "included_in_block_hash"),
    "transactions": Layout("transactions"),
    "receipts": Layout("receipts", "receipt_id"),
    "action_receipt_actions": Layout("action_receipt_actions", "receipt_id"),
    "execution_outcomes": Layout("execution_outcomes", "receipt_id"),
    "accounts": Layout("accounts"),
    # An account is joined on either of two receipts, so each has a copy of its own.
    "accounts_by_creation": Layout("accounts", "created_by_receipt_id", keyed=True),
    "accounts_by_deletion": Layout("accounts", "deleted_by_receipt_id", keyed=True),
}


def create_tables(spark: SparkSession, database: str, root: str, buckets: int) -> None:
    """The landed tables in a catalog that may not know them yet; those it knows stay."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name, layout in LAYOUTS.items():
        table = f"`{database}`.`{name}`"
        if spark.catalog.tableExists(f"{database}.{name}"):
            continue
        fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in layout.columns]
        fields += [f"{DAY} DATE"] if layout.day_column else []
        by_day = f"PARTITIONED BY ({DAY})" if layout.day_column else ""
        by = f"(`{layout.by}`)"
        in_buckets = f"CLUSTERED BY {by} SORTED BY {by} INTO {buckets} BUCKETS" if layout.by else ""
        spark.sql(
            f"CREATE TABLE {table} ({', '.join(fields)}) USING parquet {by_day} {in_buckets} "
            f"LOCATION '{root.rstrip('/')}/{name}'"
        )
        if layout.day_column and files.exists(spark, f"{root.rstrip('/')}/{name}"):
            spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")


def land(
    source: LedgerSource,
    database: str,
    root: str,
    buckets: int,
    from_ns: int | None = None,
    to_ns: int | None = None,
    tables: Iterable[str] = tuple(LAYOUTS),
) -> LandedSource:
    """Land the rows of `[from_ns, to_ns)`, whole days, or of all time, and open the tables.

    The days of tables with a time are replaced, so a landing that was cut short or is repeated
    leaves no row twice. Tables without a time are replaced whole. `tables` names some of
    `LAYOUTS`, by default all.
    """
    spark = source.spark
    bounded = from_ns is not None and to_ns is not None
    if bounded and (from_ns % DAY_NS or to_ns % DAY_NS):
        raise ValueError("a landing takes whole days")
    create_tables(spark, database, root, buckets)
    for name in tables:
        layout = LAYOUTS[name]
        if bounded and layout.day_column:
            rows = source.between(layout.of, from_ns, to_ns)
        else:
            rows = source.table(layout.of)
        if layout.of == ACTIONS:
            rows = parsed(rows, tuple(ARGUMENTS))
        own = rows.select(*[f.name for f in layout.columns])
        _write(own, f"{database}.{name}", layout, buckets)
    return LandedSource(spark, database, source.entities_path, source.entities)


def _write(rows: DataFrame, table: str, layout: Layout, buckets: int) -> None:
    names = rows.columns
    if layout.keyed:
        rows = rows.filter(F.col(layout.by).isNotNull())
    if layout.day_column:
        day = rows.withColumn("_day", period_of(TIME_COLUMN[layout.of]))
        rows = day.withColumn(DAY, as_date("_day")).select(*names, DAY)
    if layout.by:
        # A task has one bucket: a file of it for each day, and not one for each other task.
        rows = rows.repartition(buckets, layout.by)
    elif layout.day_column:
        rows = rows.hint("rebalance", DAY)
    with _days_replaced(rows.sparkSession):
        rows.write.mode("overwrite").insertInto(table)


@contextmanager
def _days_replaced(spark: SparkSession) -> Iterator[None]:
    """An overwrite replaces the partitions it has rows for. Writes into a catalog table take
    this from the session alone."""
    before = spark.conf.get(_OVERWRITE, None)
    spark.conf.set(_OVERWRITE, "dynamic")
    try:
        yield
    finally:
        spark.conf.unset(_OVERWRITE) if before is None else spark.conf.set(_OVERWRITE, before)


class LandedSource(CatalogSource):
    """A ledger that `land` has written."""

    is_laid_out = True

    def __init__(self, spark, database: str, entities_path: str | None = None, records=None):
        super().__init__(spark, database, entities_path, day_column=DAY)
        self._records = records

    def table(self, name: str, by: str | None = None) -> DataFrame:
        """A whole table, by a column: the copy in buckets of it, without rows that lack it."""
        for copy, layout in LAYOUTS.items():
            if layout.of == name and layout.by == by and layout.keyed:
                fields = {f.name: f.dataType for f in SOURCE_TABLES[name].fields}
                others = [F.lit(None).cast(t).alias(c) for c, t in fields.items() if c != by]
                rows = self.spark.table(f"{self.database}.{copy}").select(by, *others)
                return rows.select(*fields)
        return super().table(name, by)

    def extent(self) -> Extent | None:
        """From the footers of the first and last day's blocks, as the catalog lists the days."""
        table = f"`{self.database}`.blocks"
        days = sorted(r[0] for r in self.spark.sql(f"SHOW PARTITIONS {table}").collect())
        about = self.spark.sql(f"DESCRIBE FORMATTED {table}").filter("col_name = 'Location'")
        root = about.first()["data_type"]
        folders = [f"{root}/{day}" for day in sorted({days[0], days[-1]})] if days else []
        return (extent_of_files(self.spark, folders) if days else None) or super().extent()

    def actions(
        self, *arguments: str, from_ns: int | None = None, to_ns: int | None = None
    ) -> DataFrame:
        """The arguments were parsed when they were landed: the scan reads the asked ones'
        columns and not the text."""
        rows = self.stored(ACTIONS)
        if from_ns is not None:
            first, last = (
                F.date_from_unix_date(F.lit(ns // DAY_NS)) for ns in (from_ns, to_ns - 1)
            )
            rows = between(rows, TIME_COLUMN[ACTIONS], from_ns, to_ns)
            rows = rows.filter(F.col(DAY).between(first, last))
        return rows.select(*SOURCE_TABLES[ACTIONS].fieldNames(), *arguments)

    def entities(self) -> DataFrame:
        return self._records() if self._records else super().entities()
