"""Statistics that need the same join: one exchange, the same rows."""

from __future__ import annotations

import re

import pytest

from ledgerstats.logged import LoggedStore
from ledgerstats.operators.periods import all_periods
from ledgerstats.plans import accounts, gas, registry
from ledgerstats.plans.inputs import Inputs
from ledgerstats.plans.registry import SHARED, STATISTICS, compute, shared_by
from ledgerstats.run import StatisticsFailed, run
from ledgerstats.sources import EventLedger
from ledgerstats.store import Store
from tests.ledgers import MONDAY, rows
from tests.test_scale import NO_BROADCAST, plan, settings

SMALL = "/root/testdata/sf0.001"


def exchanges(df) -> int:
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


@pytest.mark.parametrize("shared", SHARED, ids=lambda s: s.plan.__name__)
def test_a_shared_join_moves_its_tables_once(spark, shared):
    ledger = EventLedger(spark, SMALL)
    period = all_periods(ledger.extent(), "day")
    with settings(spark, **NO_BROADCAST):
        values = shared.plan(Inputs(ledger, ledger.table), period)
        apart = [compute(ledger, name) for name in shared.statistics]
        assert exchanges(values) == max(map(exchanges, apart))
        assert exchanges(values) < sum(map(exchanges, apart))
    for name, df in zip(shared.statistics, apart):
        found = shared.member(values, name, period)
        assert found.dtypes == df.dtypes and rows(found) == rows(df)


@pytest.mark.parametrize("kind", [Store, LoggedStore])
@pytest.mark.parametrize("timestamp", [None, (MONDAY + 3) * 86_400])
def test_runs_compute_a_shared_join_once(spark, tmp_path, monkeypatch, kind, timestamp):
    calls = []

    def counted(plan_):
        return lambda inputs, period: (calls.append(plan_.__name__), plan_(inputs, period))[1]

    once = tuple(
        registry.Shared(counted(s.plan), s.statistics, s.leaves_layout) for s in SHARED
    )
    monkeypatch.setattr(registry, "SHARED", once)
    names = [name for s in SHARED for name in s.statistics]
    ledger, store = EventLedger(spark, SMALL), kind(spark, str(tmp_path))
    run(ledger, store, names, timestamp=timestamp, rebuild=timestamp is None)
    assert sorted(calls) == ["gas_and_fees", "new_and_deleted_accounts"]
    for name in names:
        assert rows(store.read(name)) == rows(compute(ledger, name, timestamp))
    assert not list((tmp_path / "_shared").iterdir())


def test_where_a_shared_join_fails_each_statistic_stands_alone(spark, tmp_path, monkeypatch):
    def broken(inputs, period):
        raise ArithmeticError("fees past 38 digits")

    monkeypatch.setattr(registry, "SHARED", (registry.Shared(broken, SHARED[0].statistics),))
    fees = STATISTICS["daily_tokens_spent_on_fees"]
    alone = registry.Statistic(fees.name, broken)
    monkeypatch.setitem(STATISTICS, fees.name, alone)
    ledger, store = EventLedger(spark, SMALL), Store(spark, str(tmp_path))
    with pytest.raises(StatisticsFailed) as failure:
        run(ledger, store, SHARED[0].statistics, rebuild=True)
    assert list(failure.value.errors) == [fees.name]
    assert rows(store.read("daily_gas_used")) == rows(compute(ledger, "daily_gas_used"))


def test_what_is_shared(spark):
    ledger = EventLedger(spark, SMALL)
    assert shared_by(["daily_gas_used"], ledger) == []
    both = ["daily_gas_used", "daily_tokens_spent_on_fees", "daily_new_accounts_count"]
    assert [s.plan for s in shared_by(both, ledger)] == [gas.gas_and_fees]
    assert [s.plan for s in shared_by(STATISTICS, ledger)] == [
        gas.gas_and_fees, accounts.new_and_deleted_accounts,
    ]
    ledger.is_laid_out = True
    assert [s.plan for s in shared_by(STATISTICS, ledger)] == [gas.gas_and_fees]
