"""Tables landed in buckets: joins without an exchange, the same rows, days replaced."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from ledgerstats.plans.registry import STATISTICS, compute
from ledgerstats.run import run
from ledgerstats.schemas import SOURCE_TABLES
from ledgerstats.sources import EventLedger, LandedSource, land
from ledgerstats.sources.landing import LAYOUTS, create_tables
from ledgerstats.store import Store
from tests.ledgers import MONDAY, LiteralLedger, at, rows
from tests.test_scale import NO_BROADCAST, plan, settings

SMALL = "/root/testdata/sf0.001"
DAY = (MONDAY + 3) * 86_400


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("buckets"))
    yield land(EventLedger(spark, SMALL), "bucketed_ledger", root, 4)
    spark.sql("DROP DATABASE bucketed_ledger CASCADE")


@pytest.mark.parametrize("name", sorted(SOURCE_TABLES))
def test_landed_tables_hold_the_ledgers_rows(spark, landed, name):
    source = EventLedger(spark, SMALL)
    assert landed.table(name).dtypes == source.table(name).dtypes
    assert sorted(map(str, landed.table(name).collect())) == sorted(
        map(str, source.table(name).collect())
    )


JOINED = {
    "daily_deleted_accounts_count": "receipt_id",
    "daily_deposit_amount": "receipt_id",
    "daily_gas_used": "block_hash",
    "daily_new_accounts_count": "receipt_id",
    "daily_tokens_spent_on_fees": "block_hash",
    "daily_transaction_count_by_gas_burnt_ranges": "receipt_id",
}


@pytest.mark.parametrize("timestamp", [None, DAY])
@pytest.mark.parametrize("name", sorted(JOINED))
def test_joins_on_bucketed_keys_move_no_rows(spark, landed, name, timestamp):
    with settings(spark, **NO_BROADCAST):
        df = compute(landed, name, timestamp)
        text = plan(df)
        # What is left to move are counts by period or, for gas ranges, by transaction.
        exchanged = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
        moved = {column for keys in exchanged for column in re.findall(r"(\w+)#", keys)}
        assert moved and moved <= {
            "period", "transaction_hash",
            "_groupingexpression",  # the range of gas
        }
        assert "SortMergeJoin" in text or "ShuffledHashJoin" in text
        expected = compute(EventLedger(spark, SMALL), name, timestamp).collect()
        assert sorted(df.collect()) == sorted(expected)


@pytest.mark.parametrize("name", sorted(STATISTICS))
def test_statistics_of_landed_tables_are_those_of_the_ledger(spark, landed, name):
    expected = compute(EventLedger(spark, SMALL), name)
    key = STATISTICS[name].table.key
    found = compute(landed, name).orderBy(*key).collect()
    assert found == expected.orderBy(*key).collect()


@pytest.mark.parametrize(
    "name,column",
    [
        ("daily_deposit_amount", "args_deposit"),
        ("deployed_contracts", "args_code_sha256"),
        ("daily_accounts_added_per_ecosystem_entity", "args_permitted_contract"),
    ],
)
def test_scans_read_parsed_arguments_and_not_their_text(landed, name, column):
    text = plan(compute(landed, name))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    read = {column for schema in schemas for column in re.findall(r"(\w+):", schema)}
    assert column in read and "args" not in read
    assert "json" not in text


def test_the_extent_comes_from_the_footers_of_two_days(spark, landed, monkeypatch):
    expected = EventLedger(spark, SMALL).extent()
    with monkeypatch.context() as m:
        m.setattr("ledgerstats.sources.base.ledger_extent", None)  # no scan
        assert landed.extent() == expected
    # Without footers that tell, and without rows.
    monkeypatch.setattr("ledgerstats.files.parquet_bounds", lambda *a: None)
    assert landed.extent() == expected
    spark.sql("CREATE DATABASE IF NOT EXISTS empty_ledger")
    try:
        create_tables(spark, "empty_ledger", "/tmp/none-there", 2)
        assert LandedSource(spark, "empty_ledger").extent() is None
    finally:
        spark.sql("DROP DATABASE empty_ledger CASCADE")


def test_one_day_opens_its_own_directories(landed):
    text = plan(compute(landed, "daily_new_accounts_count", DAY))
    assert re.search(r"PartitionFilters: \[[^\]]*day#\d+ >= 2024-01-04", text)
    assert "SelectedBucketsCount: 4 out of 4" in text


def test_landing_a_day_again_replaces_it(spark, tmp_path):
    source, root = EventLedger(spark, SMALL), str(tmp_path)
    try:
        for first, last in ((0, 2), (1, 3), (1, 3)):
            ledger = land(source, "by_day_ledger", root, 3, at(first), at(last))
        for name in ("receipts", "blocks"):
            assert rows(ledger.table(name)) == rows(source.between(name, at(0), at(3)))
        assert ledger.table("accounts").count() == source.table("accounts").count()
        with pytest.raises(ValueError, match="whole days"):
            land(source, "by_day_ledger", root, 3, at(0, 1), at(1))
    finally:
        spark.sql("DROP DATABASE by_day_ledger CASCADE")


def test_a_new_catalog_opens_what_was_landed(spark, tmp_path):
    source, root = EventLedger(spark, SMALL), str(tmp_path)
    try:
        land(source, "first_ledger", root, 3)
        create_tables(spark, "second_ledger", root, 3)
        ledger = LandedSource(spark, "second_ledger")
        assert rows(ledger.table("receipts")) == rows(source.table("receipts"))
        assert ledger.extent() == source.extent()
    finally:
        for name in ("first_ledger", "second_ledger"):
            spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_a_bucket_of_a_day_is_one_file(spark, landed):
    found = landed.spark.table("bucketed_ledger.receipts").select(
        "day", F.input_file_name().alias("file")
    )
    files = found.distinct().groupBy("day").count().collect()
    assert files and max(r["count"] for r in files) <= 4


def test_rows_without_a_key_do_not_share_a_bucket(spark, tmp_path):
    accounts = [(None, None)] * 50 + [("r1", None), ("r2", "r3")]
    receipts = [(r, "x", "t", at(0, 5)) for r in ("r1", "r2", "r3")]
    ledger = LiteralLedger(spark, accounts=accounts, receipts=receipts)
    try:
        landed = land(ledger, "null_ledger", str(tmp_path), 2)
        assert landed.table("accounts").count() == 52
        assert spark.table("null_ledger.accounts_by_creation").count() == 2
        for name, n in (("daily_new_accounts_count", 2), ("daily_deleted_accounts_count", 1)):
            assert [r[1] for r in compute(landed, name).collect()] == [n]
    finally:
        spark.sql("DROP DATABASE null_ledger CASCADE")


def test_runs_store_the_same_from_landed_tables(spark, landed, tmp_path):
    names = [*JOINED, "daily_new_unique_contracts_count"]
    store = Store(spark, str(tmp_path))
    run(landed, store, names, timestamp=DAY)
    for name in JOINED:
        expected = compute(EventLedger(spark, SMALL), name, DAY).collect()
        assert sorted(store.read(name).collect()) == sorted(expected)


def test_every_layout_is_of_a_ledger_table_and_its_column():
    for layout in LAYOUTS.values():
        assert layout.by is None or layout.by in SOURCE_TABLES[layout.of].fieldNames()
    assert {layout.of for layout in LAYOUTS.values()} == set(SOURCE_TABLES)
