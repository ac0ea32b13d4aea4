"""Where the ledger tables come from."""

from ledgerstats.sources.base import LedgerSource
from ledgerstats.sources.catalog import CatalogSource
from ledgerstats.sources.entities import read_entities
from ledgerstats.sources.events import EventLedger
from ledgerstats.sources.jdbc import JdbcSource
from ledgerstats.sources.landing import LandedSource, land
from ledgerstats.sources.parquet import ParquetSource

__all__ = [
    "CatalogSource",
    "EventLedger",
    "JdbcSource",
    "LandedSource",
    "LedgerSource",
    "ParquetSource",
    "land",
    "read_entities",
]
