from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstats import files
from ledgerstats.functions.calendar import DAY_NS
from ledgerstats.operators.periods import Extent, between
from ledgerstats.schemas import SOURCE_TABLES, TIME_COLUMN
from ledgerstats.sources.base import LedgerSource, declared

EPOCH = dt.date(1970, 1, 1)


#: Footers that the driver reads at most; past that many files the column is scanned.
MOST_FOOTERS = 64


def extent_of_files(spark: SparkSession, folders: list[str]) -> Extent | None:
    """The extent of the blocks in folders, from the footers; none where these do not tell."""
    names = [
        f"{folder}/{name}"
        for folder in folders
        for name in files.children(spark, folder)
        if not name.startswith(("_", "."))
    ]
    if len(names) > MOST_FOOTERS or not all(name.endswith(".parquet") for name in names):
        return None
    bounds = [files.parquet_bounds(spark, name, TIME_COLUMN["blocks"]) for name in names]
    if None in bounds or not (known := [x for found in bounds for x in found]):
        return None
    return Extent(min(x[0] for x in known), max(x[1] for x in known))


class ParquetSource(LedgerSource):
    """Tables landed as `<root>/<table>`, read with their declared columns."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        entities_path: str | None = None,
        day_column: str | None = None,
    ):
        self.root = root.rstrip("/")
        super().__init__(spark, entities_path or f"{self.root}/entities.json", day_column)
        self._schemas: dict[str, T.StructType] = {}

    def stored(self, name: str) -> DataFrame:
        return self._read(name, [])

    def between(self, name: str, from_ns: int, to_ns: int) -> DataFrame:
        """Opens the period's day directories alone, so that Spark's estimate of the size,
        by which it decides on filters and broadcasts, is that of the period too."""
        rows = self._read(name, self._days(name, from_ns, to_ns))
        rows = between(rows, TIME_COLUMN[name], from_ns, to_ns)
        if self.day_column:
            first, last = (
                F.date_from_unix_date(F.lit(ns // DAY_NS)) for ns in (from_ns, to_ns - 1)
            )
            rows = rows.filter(F.col(self.day_column).between(first, last))
        return declared(name, rows)

    def extent(self) -> Extent | None:
        """From the minima and maxima in the files' footers, of the first and last day directory
        where there are some: no job runs. Where a file lacks them, where the time is no whole
        number, or where there are very many files, the column is scanned."""
        path = f"{self.root}/blocks"
        days = self._day_directories("blocks")
        paths = [f"{path}/{day}" for day in sorted({days[0], days[-1]})] if days else [path]
        return extent_of_files(self.spark, paths) or super().extent()

    def _day_directories(self, name: str) -> list[str]:
        if not self.day_column:
            return []
        prefix = f"{self.day_column}="
        children = files.children(self.spark, f"{self.root}/{name}")
        return [c for c in children if c.startswith(prefix) and c[len(prefix) :][:1].isdigit()]

    def _days(self, name: str, from_ns: int, to_ns: int) -> list[str]:
        """Day directories within the bounds; none where all or no days are."""
        if not self.day_column or name not in TIME_COLUMN:
            return []
        prefix = f"{self.day_column}="
        children = files.children(self.spark, f"{self.root}/{name}")
        days = [c for c in children if c.startswith(prefix)]
        first, last = (
            prefix + (EPOCH + dt.timedelta(days=ns // DAY_NS)).isoformat()
            for ns in (from_ns, to_ns - 1)
        )
        held = [c for c in days if first <= c <= last]
        return [] if len(held) == len(days) else held

    def _read(self, name: str, days: list[str]) -> DataFrame:
        path = f"{self.root}/{name}"
        reader = self.spark.read.schema(self._schema(name)).option("basePath", path)
        return reader.parquet(*([f"{path}/{day}" for day in days] or [path]))

    def _schema(self, name: str) -> T.StructType:
        """The declared columns with the files' own types, which may be wider: a time that
        was landed as decimal(20,0) is compared as it is and cast behind the scan."""
        if name not in self._schemas:
            fields = SOURCE_TABLES[name].fields
            own = self.spark.read.parquet(f"{self.root}/{name}").schema
            types = {f.name: f.dataType for f in own.fields}
            fields = [T.StructField(f.name, types.get(f.name, f.dataType)) for f in fields]
            if self.day_column and name in TIME_COLUMN:
                fields.append(T.StructField(self.day_column, T.DateType()))
            self._schemas[name] = T.StructType(fields)
        return self._schemas[name]

    def size_in_bytes(self) -> int:
        return sum(files.size_in_bytes(self.spark, f"{self.root}/{t}") for t in SOURCE_TABLES)
