from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerstats.schemas import SOURCE_TABLES
from ledgerstats.sources.base import LedgerSource


class CatalogSource(LedgerSource):
    """Tables of a catalog database.

    Tables bucketed on their receipt id with one bucket count join without moving rows.
    """

    def __init__(
        self,
        spark: SparkSession,
        database: str,
        entities_path: str | None = None,
        day_column: str | None = None,
    ):
        super().__init__(spark, entities_path, day_column)
        self.database = database

    def stored(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.database}.{name}")

    def size_in_bytes(self) -> int | None:
        """What the optimizer estimates for the tables, which is the stored size unless the
        catalog has statistics; a table without an estimate counts as nothing."""
        sizes = [
            int(str(self.stored(t)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
            for t in SOURCE_TABLES
            if self.spark.catalog.tableExists(f"{self.database}.{t}")
        ]
        unknown = int(self.spark.conf.get("spark.sql.defaultSizeInBytes", str(2**63 - 1)))
        return sum(s for s in sizes if s < unknown)
