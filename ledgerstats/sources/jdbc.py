from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerstats.operators.periods import Extent, between, ledger_extent
from ledgerstats.schemas import TIME_COLUMN
from ledgerstats.sources.base import LedgerSource, declared


class JdbcSource(LedgerSource):
    """Tables of a live database, a period read by `readers` connections in parallel.

    The driver's jar and credentials are the caller's: `options` goes to Spark's
    JDBC reader as it is. `whole_table_split` gives the SQL of a number from 0 to
    `readers - 1` for each row of a table that is read whole, in the database's own words,
    such as a hash of its id modulo the readers; such a table is then read by as many
    connections, and by one without it.
    """

    def __init__(
        self,
        spark: SparkSession,
        options: dict[str, str],
        entities_path: str | None = None,
        readers: int = 16,
        whole_table_split: dict[str, str] | None = None,
    ):
        super().__init__(spark, entities_path)
        self.whole_table_split = whole_table_split or {}
        self.options = options
        self.readers = readers

    def stored(self, name: str, **more: str) -> DataFrame:
        reader = self.spark.read.format("jdbc").options(**self.options).options(**more)
        return (reader if "dbtable" in more else reader.option("dbtable", name)).load()

    def table(self, name: str, by: str | None = None) -> DataFrame:
        return declared(name, self.stored(name, **self.whole_table_options(name)))

    def whole_table_options(self, name: str) -> dict[str, str]:
        """A table as a query with the number of its part, by which its reads are split."""
        if name not in self.whole_table_split:
            return {}
        return {
            "dbtable": f"(SELECT t.*, {self.whole_table_split[name]} AS read_part"
            f" FROM {name} t) split",
            "partitionColumn": "read_part",
            "lowerBound": "0",
            "upperBound": str(self.readers),
            "numPartitions": str(self.readers),
        }

    def extent(self) -> Extent | None:
        """One row that the database computes."""
        return ledger_extent(self.stored("blocks", **self.extent_options()), computed=True)

    @staticmethod
    def extent_options() -> dict[str, str]:
        time = TIME_COLUMN["blocks"]
        query = f"SELECT min({time}) AS first_ns, max({time}) AS last_ns FROM blocks"
        return {"dbtable": f"({query}) extent"}

    def between(self, name: str, from_ns: int, to_ns: int) -> DataFrame:
        rows = self.stored(name, **self.split_options(name, from_ns, to_ns))
        return declared(name, between(rows, TIME_COLUMN[name], from_ns, to_ns))

    def split_options(self, name: str, from_ns: int, to_ns: int) -> dict[str, str]:
        if to_ns - from_ns < self.readers:
            return {}
        return {
            "partitionColumn": TIME_COLUMN[name],
            "lowerBound": str(from_ns),
            "upperBound": str(to_ns),
            "numPartitions": str(self.readers),
        }
