from __future__ import annotations

from abc import ABC, abstractmethod

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstats.functions.calendar import DAY_NS
from ledgerstats.functions.jsonargs import parsed
from ledgerstats.operators.periods import Extent, between, ledger_extent
from ledgerstats.schemas import SOURCE_TABLES, TIME_COLUMN
from ledgerstats.sources.entities import read_entities


class LedgerSource(ABC):
    """The seven ledger tables and the entity records, as DataFrames.

    With `day_column`, every table that has a time column also has this date column: the
    UTC day of its time. Where tables are partitioned by it, a period opens only its own
    days.
    """

    def __init__(
        self, spark: SparkSession, entities_path: str | None = None, day_column: str | None = None
    ):
        self.spark = spark
        self.entities_path = entities_path
        self.day_column = day_column

    #: Whether the tables are stored by their join keys, so that joins on them move no rows.
    is_laid_out = False

    @abstractmethod
    def stored(self, name: str) -> DataFrame:
        """A whole table as it is stored."""

    def table(self, name: str, by: str | None = None) -> DataFrame:
        """A whole table with the columns of `SOURCE_TABLES`.

        `by` names the column that the caller joins on; rows without it may be missing.
        """
        return declared(name, self.stored(name))

    def between(self, name: str, from_ns: int, to_ns: int) -> DataFrame:
        """The rows of a table whose own time lies in `[from_ns, to_ns)`."""
        rows = between(self.stored(name), TIME_COLUMN[name], from_ns, to_ns)
        if self.day_column:
            first, last = (
                F.date_from_unix_date(F.lit(ns // DAY_NS)) for ns in (from_ns, to_ns - 1)
            )
            rows = rows.filter(F.col(self.day_column).between(first, last))
        return declared(name, rows)

    def actions(
        self, *arguments: str, from_ns: int | None = None, to_ns: int | None = None
    ) -> DataFrame:
        """The receipt actions, of a range or all, with columns of `ARGUMENTS`."""
        name = "action_receipt_actions"
        rows = self.table(name) if from_ns is None else self.between(name, from_ns, to_ns)
        return parsed(rows, arguments)

    def entities(self) -> DataFrame:
        """The catalogue's records in `ENTITY_RECORD` form, numbered by `_position`."""
        return read_entities(self.spark, self.entities_path)

    def size_in_bytes(self) -> int | None:
        """Stored size of the tables, where it is known without reading them."""
        return None

    def extent(self) -> Extent | None:
        """How far the ledger reaches now: a Spark job over one column of the blocks."""
        return ledger_extent(self.table("blocks"))


def declared(name: str, rows: DataFrame) -> DataFrame:
    """Rows with the declared columns, in order and of the declared types."""
    types = {field.name: field.dataType for field in rows.schema.fields}
    return rows.select(
        *[
            field.name
            if types[field.name] == field.dataType
            else F.col(field.name).cast(field.dataType).alias(field.name)
            for field in SOURCE_TABLES[name].fields
        ]
    )
