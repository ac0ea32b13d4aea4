"""Storage: first write wins, replacement, and runs that store what they compute."""

from __future__ import annotations

import datetime as dt
import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerstats.operators.firstwrite import insert_only
from ledgerstats.operators.periods import Period
from ledgerstats.plans import registry
from ledgerstats.plans.registry import STATISTICS, compute, prerequisites
from ledgerstats.run import DependencyFailed, StatisticsFailed, run
from ledgerstats.schemas import DERIVED_TABLES, SOURCE_TABLES
from ledgerstats.sources import EventLedger, ParquetSource
from ledgerstats.store import Store
from tests.ledgers import MONDAY, LiteralLedger, at, rows

SMALL = "/root/testdata/sf0.001"
DAY0, DAY1 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
COUNTS = "daily_transactions_count"
PER_ACCOUNT = "daily_outgoing_transactions_per_account_count"


def frame(spark, name, data):
    return spark.createDataFrame(data, DERIVED_TABLES[name].schema)


def test_an_absent_table_is_empty(spark, tmp_path):
    stored = Store(spark, str(tmp_path)).read(PER_ACCOUNT)
    assert stored.columns == DERIVED_TABLES[PER_ACCOUNT].columns
    assert stored.count() == 0


@pytest.mark.parametrize("period", [None, Period("day", MONDAY, MONDAY + 2)])
def test_first_write_wins(spark, tmp_path, period):
    store = Store(spark, str(tmp_path))
    store.insert(PER_ACCOUNT, frame(spark, PER_ACCOUNT, [(DAY0, "a", 1)]), period)
    again = [(DAY0, "a", 2), (DAY0, "b", 3), (DAY1, "a", 4)]
    store.insert(PER_ACCOUNT, frame(spark, PER_ACCOUNT, again), period)
    store.insert(PER_ACCOUNT, frame(spark, PER_ACCOUNT, again), period)
    assert rows(store.read(PER_ACCOUNT)) == [(DAY0, "a", 1), (DAY0, "b", 3), (DAY1, "a", 4)]
    assert sorted(os.listdir(tmp_path / PER_ACCOUNT)) == ["v00000001"]


def test_one_row_per_key_within_a_batch(spark):
    stored = spark.createDataFrame([("a", 1)], "k string, v int")
    batch = spark.createDataFrame([("a", 0), ("b", 3), ("b", 2), ("c", 1)], "k string, v int")
    merged = insert_only(stored, batch, ["k"], [F.col("v")])
    assert rows(merged) == [("a", 1), ("b", 2), ("c", 1)]


def test_replacing_moves_to_a_new_version(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    for value in (1, 2, 3):
        before = store.read(COUNTS)
        store.replace(COUNTS, frame(spark, COUNTS, [(DAY0, value)]))
        assert [r[1] for r in rows(before)] == [value - 1] * (value > 1)
        assert rows(store.read(COUNTS)) == [(DAY0, value)]
    assert sorted(os.listdir(tmp_path / COUNTS)) == ["v00000002", "v00000003"]


def test_an_unfinished_version_is_not_read(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.replace(COUNTS, frame(spark, COUNTS, [(DAY0, 1)]))
    (tmp_path / COUNTS / "v00000002").mkdir()
    assert rows(store.read(COUNTS)) == [(DAY0, 1)]
    store.replace(COUNTS, frame(spark, COUNTS, [(DAY0, 5)]))
    assert rows(store.read(COUNTS)) == [(DAY0, 5)]
    assert sorted(os.listdir(tmp_path / COUNTS)) == ["v00000001", "v00000003"]


def test_an_empty_result_is_stored(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.replace(PER_ACCOUNT, frame(spark, PER_ACCOUNT, []))
    assert rows(store.read(PER_ACCOUNT)) == []
    store.insert(PER_ACCOUNT, frame(spark, PER_ACCOUNT, [(DAY0, "a", 1)]))
    assert rows(store.read(PER_ACCOUNT)) == [(DAY0, "a", 1)]


def test_a_large_day_is_written_by_several_tasks(spark, tmp_path):
    """`rebalance` does not gather one day, however large, into one task."""
    store = Store(spark, str(tmp_path))
    accounts = spark.range(0, 200_000, numPartitions=8).select(
        F.lit(DAY0).alias("collected_for_day"),
        F.concat(F.lit("account-with-a-long-name-"), "id").alias("account_id"),
        F.lit(1).cast("bigint").alias("outgoing_transactions_count"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256KB")
    try:
        store.replace(PER_ACCOUNT, accounts)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    day = tmp_path / PER_ACCOUNT / "v00000001" / "collected_for_day=2024-01-01"
    assert len([f for f in os.listdir(day) if f.endswith(".parquet")]) > 1
    assert store.read(PER_ACCOUNT).count() == 200_000


def test_a_null_where_none_is_allowed_fails(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    with pytest.raises(Exception, match="NULL in daily_transactions_count.transactions_count"):
        store.replace(COUNTS, frame(spark, COUNTS, [(DAY0, None)]))
    assert store.read(COUNTS).count() == 0


def test_drop(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.replace(COUNTS, frame(spark, COUNTS, [(DAY0, 1)]))
    store.drop(COUNTS)
    store.drop(COUNTS)
    assert store.read(COUNTS).count() == 0


def test_dependencies_come_first_and_once():
    added = "daily_accounts_added_per_ecosystem_entity"
    per_entity = "daily_new_accounts_per_ecosystem_entity_count"
    assert prerequisites([per_entity] * 2) == {
        per_entity: {added}, added: {"near_ecosystem_entities"}, "near_ecosystem_entities": set(),
    }
    assert prerequisites(["weekly_active_accounts_count"]) == {
        "weekly_active_accounts_count": set()
    }
    everything = prerequisites(STATISTICS)
    assert everything.keys() == STATISTICS.keys()
    assert everything["weekly_active_accounts_count"] == {PER_ACCOUNT}


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    """The fixture ledger of the smallest scale, written as the seven tables and the JSON."""
    root = tmp_path_factory.mktemp("landed")
    events = EventLedger(spark, SMALL)
    for name in SOURCE_TABLES:
        events.table(name).write.parquet(f"{root}/{name}")
    records = events.entities().orderBy("_position").drop("_position").collect()
    text = json.dumps([{k: v for k, v in r.asDict().items() if v is not None} for r in records])
    (root / "entities.json").write_text(text)
    return ParquetSource(spark, str(root))


@pytest.fixture(scope="module")
def rebuilt(spark, landed, tmp_path_factory):
    store = Store(spark, str(tmp_path_factory.mktemp("rebuilt")))
    computed = run(landed, store, rebuild=True)
    assert sorted(computed) == sorted(STATISTICS)
    for name, before in prerequisites(STATISTICS).items():
        assert all(computed.index(other) < computed.index(name) for other in before)
    return store


@pytest.mark.parametrize("name", sorted(STATISTICS))
def test_a_rebuild_stores_what_the_events_give(spark, rebuilt, name):
    expected = compute(EventLedger(spark, SMALL), name).select(*DERIVED_TABLES[name].columns)
    key = DERIVED_TABLES[name].key
    ours = rebuilt.read(name)
    assert ours.schema.simpleString() == expected.schema.simpleString()
    assert ours.orderBy(*key).collect() == expected.orderBy(*key).collect()
    assert ours.select(*key).distinct().count() == ours.count()


def test_single_days_in_order_equal_a_rebuild(spark, landed, rebuilt, tmp_path):
    """Every statistic over its first four days, one run per day, the second day twice."""
    store = Store(spark, str(tmp_path))
    days = [MONDAY, MONDAY + 1, MONDAY + 1, MONDAY + 2, MONDAY + 3]
    for day in days:
        run(landed, store, timestamp=day * 86_400 + 7_200)
    end = at(4)
    for name, table in DERIVED_TABLES.items():
        whole = rebuilt.read(name)
        first = table.columns[0]
        if first == "collected_for_day":
            whole = whole.filter(F.col(first) < F.lit(dt.date(2024, 1, 5)))
        elif first == "collected_for_week":
            whole = whole.filter(F.col(first) == F.lit(DAY0))
        elif table.columns[-1].endswith("_timestamp"):
            whole = whole.filter(F.col(table.columns[-1]) < end)
        key = list(table.key)
        assert (
            store.read(name).orderBy(*key).collect() == whole.orderBy(*key).collect()
        ), name


def test_an_incomplete_period_stores_nothing(spark, landed, tmp_path):
    store = Store(spark, str(tmp_path))
    last_day = MONDAY + 29
    names = ["daily_new_unique_contracts_count", COUNTS, "weekly_active_accounts_count"]
    run(landed, store, names, timestamp=last_day * 86_400)
    assert [store.read(n).count() for n in names] == [0, 0, 0]


def test_timestamp_zero_is_a_timestamp(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    run(LiteralLedger(spark), store, [COUNTS], timestamp=0)
    assert rows(store.read(COUNTS)) == [(dt.date(1970, 1, 1), 0)]


def test_yesterday_is_the_default(spark, tmp_path):
    today = (dt.datetime.now(dt.timezone.utc).date() - DAY0).days
    store = Store(spark, str(tmp_path))
    run(LiteralLedger(spark, days=today), store, [COUNTS])
    assert rows(store.read(COUNTS)) == [(DAY0 + dt.timedelta(today - 1), 0)]


def test_one_failure_does_not_stop_the_others(spark, tmp_path, monkeypatch):
    def broken(inputs, period):
        raise OSError("source is gone")

    broken_one = registry.Statistic("deployed_contracts", broken)
    monkeypatch.setitem(STATISTICS, "deployed_contracts", broken_one)
    store = Store(spark, str(tmp_path))
    names = ["daily_new_unique_contracts_count", COUNTS, "deployed_contracts"]
    with pytest.raises(StatisticsFailed) as failure:
        run(LiteralLedger(spark), store, names, timestamp=MONDAY * 86_400)
    errors = failure.value.errors
    assert sorted(errors) == ["daily_new_unique_contracts_count", "deployed_contracts"]
    assert isinstance(errors["daily_new_unique_contracts_count"], DependencyFailed)
    assert store.read(COUNTS).count() == 1


def test_arguments_that_do_not_fit(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    with pytest.raises(ValueError, match="takes no timestamp"):
        run(LiteralLedger(spark), store, rebuild=True, timestamp=0)
    with pytest.raises(ValueError, match="unknown statistics: nothing"):
        run(LiteralLedger(spark), store, ["nothing"])


def test_out_of_order_days_keep_the_first_write(spark, tmp_path):
    """A stored row never changes, so a later day run first keeps its time."""

    def grant(time):
        body = (
            '{"access_key":{"permission":{"permission_kind":"FUNCTION_CALL",'
            '"permission_details":{"receiver_id":"c1"}}}}'
        )
        return ("r", "ADD_KEY", body, "x", "p", time)

    ledger = LiteralLedger(
        spark,
        days=2,
        entities=[{"slug": "e", "contract": "c1", "category": "app"}],
        action_receipt_actions=[grant(at(0)), grant(at(1))],
        blocks=[("a", at(), Decimal(1)), ("b", at(2, 600), Decimal(1))],
    )
    name = "daily_accounts_added_per_ecosystem_entity"
    store = Store(spark, str(tmp_path))
    for day in (MONDAY + 1, MONDAY):
        run(ledger, store, [name], timestamp=day * 86_400)
    assert rows(store.read(name)) == [("e", "x", at(1))]
    run(ledger, store, [name], rebuild=True)
    assert rows(store.read(name)) == [("e", "x", at(0))]


def test_many_inserts_leave_few_files(spark, tmp_path):
    """A table of one row a period is rewritten now and then, and keeps every row."""
    store = Store(spark, str(tmp_path))
    days = [DAY0 + dt.timedelta(days=i) for i in range(40)]
    for i, day in enumerate(days):
        store.insert(COUNTS, frame(spark, COUNTS, [(day, i)]))
    assert rows(store.read(COUNTS)) == [(day, i) for i, day in enumerate(days)]
    newest = max((tmp_path / COUNTS).iterdir())
    assert len([f for f in newest.iterdir() if f.suffix == ".parquet"]) <= 32
