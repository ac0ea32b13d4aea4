"""The statistics by name: unit of time, plan, and the derived tables they read."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ledgerstats.operators.periods import (
    Extent,
    Period,
    all_periods,
    one_period,
    one_row_per_period,
)
from ledgerstats.plans import accounts, activity, contracts, deposits, entities, gas
from ledgerstats.plans.inputs import Inputs
from ledgerstats.schemas import DERIVED_TABLES, DerivedTable
from ledgerstats.sources.base import LedgerSource


@dataclass(frozen=True)
class Statistic:
    name: str
    plan: Callable[[Inputs, Period], DataFrame]
    unit: str | None = "day"  # None: a snapshot without a period
    depends_on: tuple[str, ...] = ()
    rollup_of: str | None = None
    rollup: Callable[[DataFrame, Period], DataFrame] | None = None

    @property
    def table(self) -> DerivedTable:
        return DERIVED_TABLES[self.name]


@dataclass(frozen=True)
class Shared:
    """Statistics of one row a day that come from one join: `plan` gives, by period, a column
    for each, named as its table's. Tables laid out by their join keys move nothing for a join,
    so what would have to leave such a layout is not shared there."""

    plan: Callable[[Inputs, Period], DataFrame]
    statistics: tuple[str, ...]
    leaves_layout: bool = False

    def member(self, values: DataFrame, name: str, period: Period) -> DataFrame:
        """One statistic's rows from what the plan has given."""
        column = DERIVED_TABLES[name].columns[-1]
        return one_row_per_period(values.select("period", column), period, "collected_for_day")


SHARED: tuple[Shared, ...] = (
    Shared(gas.gas_and_fees, ("daily_gas_used", "daily_tokens_spent_on_fees")),
    Shared(
        accounts.new_and_deleted_accounts,
        ("daily_deleted_accounts_count", "daily_new_accounts_count"),
        leaves_layout=True,
    ),
)


def shared_by(names: Iterable[str], source: LedgerSource) -> list[Shared]:
    """The joins that two or more of the named statistics have in common."""
    wanted = set(names)
    return [
        shared
        for shared in SHARED
        if len(wanted.intersection(shared.statistics)) > 1
        and not (shared.leaves_layout and source.is_laid_out)
    ]


_OUTGOING = "daily_outgoing_transactions_per_account_count"
_PER_CONTRACT = "daily_receipts_per_contract_count"

STATISTICS: dict[str, Statistic] = {
    statistic.name: statistic
    for statistic in [
        Statistic(
            entities.ACCOUNTS_ADDED, entities.accounts_added, depends_on=(entities.CATALOGUE,)
        ),
        Statistic(
            "daily_active_accounts_count",
            activity.active_accounts_count,
            rollup_of=_OUTGOING,
            rollup=activity.active_accounts_rollup,
        ),
        Statistic(
            "daily_active_contracts_count",
            contracts.active_contracts_count,
            rollup_of=_PER_CONTRACT,
            rollup=contracts.active_contracts_rollup,
        ),
        Statistic("daily_deleted_accounts_count", accounts.deleted_accounts_count),
        Statistic("daily_deposit_amount", deposits.deposit_amount),
        Statistic("daily_gas_used", gas.gas_used),
        Statistic("daily_ingoing_transactions_per_account_count", activity.ingoing_transactions),
        Statistic("daily_new_accounts_count", accounts.new_accounts_count),
        Statistic(
            "daily_new_accounts_per_ecosystem_entity_count",
            entities.new_accounts_per_entity,
            depends_on=(entities.ACCOUNTS_ADDED,),
        ),
        Statistic(
            "daily_new_contracts_count",
            contracts.new_contracts_count,
            rollup_of="deployed_contracts",
            rollup=contracts.new_contracts_rollup,
        ),
        Statistic(
            "daily_new_unique_contracts_count",
            contracts.new_unique_contracts_count,
            depends_on=("deployed_contracts",),
        ),
        Statistic(_OUTGOING, activity.outgoing_transactions),
        Statistic(_PER_CONTRACT, contracts.receipts_per_contract),
        Statistic("daily_tokens_spent_on_fees", gas.tokens_spent_on_fees),
        Statistic("daily_transaction_count_by_gas_burnt_ranges", gas.transactions_by_gas_burnt),
        Statistic(
            "daily_transactions_count",
            activity.transactions_count,
            rollup_of=_OUTGOING,
            rollup=activity.transactions_count_rollup,
        ),
        Statistic("deployed_contracts", contracts.deployed_contracts),
        Statistic(
            "weekly_active_accounts_count",
            activity.active_accounts_count,
            unit="week",
            rollup_of=_OUTGOING,
            rollup=activity.active_accounts_rollup,
        ),
        Statistic(entities.CATALOGUE, entities.catalogue, unit=None),
    ]
}


#: Statistics beside the nineteen, for sums past 38 digits. A run computes them by name.
WIDE_STATISTICS: dict[str, Statistic] = {
    statistic.name: statistic
    for statistic in [
        Statistic("daily_deposit_amount_wide", deposits.deposit_amount_stored),
        Statistic("daily_tokens_spent_on_fees_wide", gas.tokens_spent_on_fees_stored),
    ]
}


def statistic_of(name: str) -> Statistic:
    return STATISTICS[name] if name in STATISTICS else WIDE_STATISTICS[name]


def prerequisites(names: Iterable[str]) -> dict[str, set[str]]:
    """The named statistics and all they depend on, each with those to compute before it."""
    graph: dict[str, set[str]] = {}
    waiting = list(names)
    while waiting:
        name = waiting.pop()
        if name not in graph:
            graph[name] = set(statistic_of(name).depends_on)
            waiting.extend(graph[name])
    for name, before in graph.items():
        if statistic_of(name).rollup_of in graph:
            before.add(statistic_of(name).rollup_of)
    return graph


def compute(
    source: LedgerSource,
    name: str,
    timestamp: int | None = None,
    keys_per_filter: int | None = None,
) -> DataFrame:
    """A statistic straight from the ledger, nothing stored: every complete period, or
    the one that holds `timestamp`. Derived tables it reads cover every complete period.

    The ids of one period are dealt into shares of `keys_per_filter`, by default what the
    session's Bloom filters hold, where they filter tables of all time.
    """
    extent = source.extent() if statistic_of(name).unit else None

    def plan(name: str, timestamp: int | None = None) -> DataFrame:
        statistic = statistic_of(name)
        inputs = Inputs(source, plan, timestamp is not None, keys_per_filter)
        return statistic.plan(inputs, period_for(extent, statistic.unit, timestamp))

    return plan(name, timestamp)


def period_for(
    extent: Extent | None, unit: str | None, timestamp: int | None = None
) -> Period | None:
    if unit is None:
        return None
    if timestamp is None:
        return all_periods(extent, unit)
    return one_period(extent, unit, timestamp)
