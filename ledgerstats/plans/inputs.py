from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ledgerstats.operators.periods import Period
from ledgerstats.operators.shares import joined_by_share, shares_for
from ledgerstats.sources.base import LedgerSource


@dataclass(frozen=True)
class Inputs:
    """What a statistic may read: ledger tables, and derived tables it depends on."""

    source: LedgerSource
    derived: Callable[[str], DataFrame]
    #: Whether one period of many is computed, so that most rows of a whole table drop out.
    one_period: bool = False
    #: Keys of one Bloom filter; by default as the session is set.
    keys_per_filter: int | None = None

    def table(self, name: str, by: str | None = None) -> DataFrame:
        """A whole table, laid out by the column `by` where the source has it so."""
        return self.source.table(name, by)

    def actions(self, *arguments: str, period: Period | None = None) -> DataFrame:
        """The receipt actions of the period, or all, with columns of `ARGUMENTS`."""
        if period is None:
            return self.source.actions(*arguments)
        return self.source.actions(*arguments, from_ns=period.from_ns, to_ns=period.to_ns)

    def matched(self, rows: DataFrame, whole: DataFrame, key: str) -> DataFrame:
        """The period's rows joined with those of a whole table."""
        split = self.one_period and not self.source.is_laid_out
        shares = shares_for(rows, self.keys_per_filter) if split else 1
        return joined_by_share(rows, whole, key, shares)

    def between(self, name: str, from_ns: int, to_ns: int) -> DataFrame:
        return self.source.between(name, from_ns, to_ns)
