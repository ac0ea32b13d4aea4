"""What the plans look like and how they take skew: properties that hold at any size."""

from __future__ import annotations

import re
from collections import Counter
from contextlib import contextmanager
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerstats import files
from ledgerstats.functions.calendar import DAY_NS
from ledgerstats.plans.registry import STATISTICS, compute
from ledgerstats.schemas import SOURCE_TABLES, TIME_COLUMN
from ledgerstats.session import INITIAL_PARTITIONS, SETTINGS, configure, shuffle_partitions
from ledgerstats.sources import CatalogSource, EventLedger, JdbcSource, ParquetSource
from tests.ledgers import MONDAY, LiteralLedger, at

SMALL = "/root/testdata/sf0.001"
NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1"}

# The source columns each statistic needs, and no others.
READS = {
    "daily_accounts_added_per_ecosystem_entity": {
        "args", "action_kind", "receipt_receiver_account_id",
        "receipt_included_in_block_timestamp",
    },
    "daily_active_accounts_count": {"signer_account_id", "block_timestamp"},
    "daily_active_contracts_count": {
        "action_kind", "receipt_receiver_account_id", "receipt_included_in_block_timestamp",
    },
    "daily_deleted_accounts_count": {
        "deleted_by_receipt_id", "receipt_id", "included_in_block_timestamp",
    },
    "daily_deposit_amount": {
        "receipt_id", "action_kind", "args", "receipt_predecessor_account_id",
        "executed_in_block_timestamp", "status",
    },
    "daily_gas_used": {
        "block_hash", "block_timestamp", "included_in_block_hash", "gas_used",
    },
    "daily_ingoing_transactions_per_account_count": {
        "transaction_hash", "signer_account_id", "block_timestamp", "receiver_account_id",
        "originated_from_transaction_hash", "included_in_block_timestamp",
    },
    "daily_new_accounts_count": {
        "created_by_receipt_id", "receipt_id", "included_in_block_timestamp",
    },
    "daily_new_contracts_count": {
        "receipt_id", "action_kind", "receipt_included_in_block_timestamp",
        "receiver_account_id", "included_in_block_timestamp",
    },
    "daily_outgoing_transactions_per_account_count": {"signer_account_id", "block_timestamp"},
    "daily_receipts_per_contract_count": {
        "receipt_id", "action_kind", "receipt_receiver_account_id",
        "receipt_included_in_block_timestamp",
    },
    "daily_tokens_spent_on_fees": {
        "block_hash", "block_timestamp", "gas_price", "included_in_block_hash", "gas_used",
    },
    "daily_transaction_count_by_gas_burnt_ranges": {
        "receipt_id", "originated_from_transaction_hash", "included_in_block_timestamp",
        "gas_burnt",
    },
    "daily_transactions_count": {"block_timestamp"},
    "deployed_contracts": {
        "receipt_id", "action_kind", "args", "receipt_included_in_block_timestamp",
        "receiver_account_id", "included_in_block_timestamp",
    },
    "weekly_active_accounts_count": {"signer_account_id", "block_timestamp"},
}


@contextmanager
def settings(spark, **values):
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    """The smallest fixture ledger by day, with a date column as partition."""
    root = tmp_path_factory.mktemp("by_day")
    events = EventLedger(spark, SMALL)
    for name in SOURCE_TABLES:
        df = events.table(name)
        if name in TIME_COLUMN:
            day = F.expr(f"date_from_unix_date(CAST({TIME_COLUMN[name]} div {DAY_NS} AS INT))")
            df.withColumn("day", day).write.partitionBy("day").parquet(f"{root}/{name}")
        else:
            df.write.parquet(f"{root}/{name}")
    (root / "entities.json").write_text('[{"slug":"e","contract":"c1","category":"app"}]')
    return ParquetSource(spark, str(root), day_column="day")


@pytest.mark.parametrize("name", sorted(STATISTICS))
def test_plans_stay_in_joins_and_aggregations_spark_can_spread(spark, landed, name):
    with settings(spark, **NO_BROADCAST):
        text = plan(compute(landed, name))
    for unwanted in ("Cartesian", "NestedLoop", "Python", "Pandas", "SinglePartition",
                     "CollectLimit", "collect_"):
        assert unwanted not in text
    # The one hinted broadcast holds a row per period; nothing else is hinted.
    per_period = STATISTICS[name].table.key in [("collected_for_day",), ("collected_for_week",)]
    assert text.count("BroadcastExchange") == per_period
    assert text.count("Range (") == per_period


@pytest.mark.parametrize("name", sorted(READS))
def test_scans_read_the_needed_columns(landed, name):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan(compute(landed, name)))
    read = {column for schema in schemas for column in re.findall(r"(\w+):", schema)}
    assert read - {"slug", "contract"} == READS[name]


@pytest.mark.parametrize("name", sorted(set(READS)))
def test_period_bounds_reach_the_scan(landed, name):
    """As row-group filters on the nanoseconds, and as the day directories to open."""
    text = plan(compute(landed, name, timestamp=(MONDAY + 3) * 86_400))
    first = f"{TIMED[name]},{at(0 if STATISTICS[name].unit == 'week' else 3)}"
    assert f"GreaterThanOrEqual({first})" in text
    assert re.search(r"PartitionFilters: \[[^\]]*day#\d+ >= 2024-01-0", text)


TIMED = {
    name: (
        "executed_in_block_timestamp" if name == "daily_deposit_amount"
        else "block_timestamp" if "block_timestamp" in columns
        else "included_in_block_timestamp" if "included_in_block_timestamp" in columns
        else "receipt_included_in_block_timestamp"
    )
    for name, columns in READS.items()
}


@pytest.mark.parametrize(
    "name,key",
    [
        ("daily_transaction_count_by_gas_burnt_ranges", "receipt_id"),
        ("daily_new_accounts_count", "created_by_receipt_id"),
        ("daily_deleted_accounts_count", "deleted_by_receipt_id"),
        ("daily_gas_used", "included_in_block_hash"),
    ],
)
def test_one_day_filters_the_unbounded_table_before_its_shuffle(spark, landed, name, key):
    """The day's ids reach the other table's scan, below its aggregation. Spark does this
    for large scans only; the test lowers that size. The side that gives the ids may be as
    large as one day, and is then far from as large as all days of its table."""
    day = (MONDAY + 3) * 86_400
    bounded = "blocks" if key == "included_in_block_hash" else "receipts"
    creation = "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold"
    whole = files.size_in_bytes(spark, f"{landed.root}/{bounded}")
    large = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    expected = compute(landed, name, timestamp=day).collect()
    with settings(spark, **NO_BROADCAST, **{large: "0", creation: str(whole // 4)}):
        df = compute(landed, name, timestamp=day)
        filters = [line for line in plan(df).splitlines() if "might_contain" in line]
        assert len(filters) == 1 and re.search(rf"xxhash64\({key}#\d+", filters[0])
        assert sorted(df.collect()) == sorted(expected)


@pytest.mark.parametrize("name", sorted(set(READS)))
def test_day_directories_do_not_change_results(spark, landed, name):
    expected = compute(EventLedger(spark, SMALL), name).collect()
    if name != "daily_accounts_added_per_ecosystem_entity":
        assert sorted(compute(landed, name).collect()) == sorted(expected)
    single = compute(landed, name, timestamp=(MONDAY + 3) * 86_400).collect()
    direct = compute(EventLedger(spark, SMALL), name, timestamp=(MONDAY + 3) * 86_400).collect()
    if name != "daily_accounts_added_per_ecosystem_entity":
        assert sorted(single) == sorted(direct)


SKEW = {
    **NO_BROADCAST,
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}
N = 120_000


class HotLedger(LiteralLedger):
    """Tables given as DataFrames of many rows."""

    def stored(self, name):
        rows = self.rows.get(name, [])
        return super().stored(name) if isinstance(rows, list) else rows


def ids(spark, n=N):
    return spark.range(0, n, numPartitions=8).withColumn("s", F.col("id").cast("string"))


def test_a_hot_transaction_is_split_over_tasks(spark):
    """A third of all receipts belongs to one transaction and each reaches an account."""
    hot = F.when(F.col("id") % 3 == 0, F.lit("0")).otherwise(F.col("s"))
    ledger = HotLedger(
        spark,
        transactions=ids(spark).select(
            F.col("s").alias("transaction_hash"),
            F.lit("signer").alias("signer_account_id"),
            F.lit(at(0, 5)).alias("block_timestamp"),
        ),
        receipts=ids(spark).select(
            F.col("s").alias("receipt_id"),
            F.concat(F.lit("account-with-a-long-name-"), "s").alias("receiver_account_id"),
            hot.alias("originated_from_transaction_hash"),
            F.lit(at(0, 6)).alias("included_in_block_timestamp"),
        ),
    )
    with settings(spark, **SKEW):
        df = compute(ledger, "daily_ingoing_transactions_per_account_count")
        found = df.collect()
        text = plan(df)
    assert "SortMergeJoin(skew=true)" in text
    assert len(found) == N
    assert {row.ingoing_transactions_count for row in found} == {1}


def test_a_hot_account_and_day_is_counted_in_parts(spark):
    ledger = HotLedger(
        spark,
        transactions=ids(spark).select(
            F.col("s").alias("transaction_hash"),
            F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("s")).alias("signer_account_id"),
            F.lit(at(0, 5)).alias("block_timestamp"),
        ),
    )
    counts = compute(ledger, "daily_outgoing_transactions_per_account_count")
    (row,) = counts.filter("account_id = 'hot'").collect()
    assert row.outgoing_transactions_count == N - N // 3
    assert "partial_count(1)" in plan(counts)
    (day,) = compute(ledger, "daily_active_accounts_count").collect()
    assert day.active_accounts_count == N // 3 + 1


def shuffled_rows(df) -> int:
    """Largest number of rows any exchange of an executed query wrote."""
    written, stack = [], [df._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
            continue
        if name.endswith("QueryStage"):
            stack.append(node.plan())
            continue
        metrics = node.metrics()
        if name == "Exchange" and metrics.contains("shuffleRecordsWritten"):
            written.append(metrics.apply("shuffleRecordsWritten").value())
        children = node.children()
        stack.extend(children.apply(i) for i in range(children.size()))
    return max(written)


def test_many_rows_of_one_receipt_or_block_shuffle_as_few(spark):
    """All accounts, actions and chunks hang on one receipt or block."""
    one = spark.createDataFrame(
        [("r", "a", "t", at(0, 5))], SOURCE_TABLES["receipts"]
    )
    outcome = [("r", at(0, 6), Decimal(0), "SUCCESS_VALUE")]
    actions = ids(spark).select(
        F.lit("r").alias("receipt_id"),
        F.when(F.col("id") % 2 == 0, "TRANSFER").otherwise("DEPLOY_CONTRACT").alias("action_kind"),
        F.when(F.col("id") % 2 == 0, '{"deposit":"2"}')
        .otherwise(F.concat(F.lit('{"code_sha256":"'), F.col("s"), F.lit('"}')))
        .alias("args"),
        F.lit("a").alias("receipt_receiver_account_id"),
        F.lit("p").alias("receipt_predecessor_account_id"),
        F.lit(at(0, 5)).alias("receipt_included_in_block_timestamp"),
    )
    ledger = HotLedger(
        spark,
        receipts=one,
        accounts=ids(spark).select(
            F.lit("r").alias("created_by_receipt_id"), F.lit("r").alias("deleted_by_receipt_id")
        ),
        action_receipt_actions=actions,
        execution_outcomes=spark.createDataFrame(outcome, SOURCE_TABLES["execution_outcomes"]),
        chunks=ids(spark).select(
            F.lit("first").alias("included_in_block_hash"),
            F.lit(3).cast("decimal(20,0)").alias("gas_used"),
        ),
    )
    expected = {
        "daily_new_accounts_count": N,
        "daily_deleted_accounts_count": N,
        "daily_deposit_amount": Decimal(N),
        "daily_new_contracts_count": 1,
        "daily_gas_used": Decimal(3 * N),
        "daily_tokens_spent_on_fees": Decimal(3 * N),
        "daily_new_unique_contracts_count": 1,
    }
    with settings(spark, **NO_BROADCAST):
        for name, value in expected.items():
            df = compute(ledger, name)
            assert [row[1] for row in df.collect()] == [value], name
            assert shuffled_rows(df) <= 64, name


def test_a_hot_contract_without_a_broadcast_catalogue(spark):
    """Two thirds of all keys are for one contract; the catalogue is shuffled."""
    contract = F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("c"), "s"))
    entities = [{"slug": "busy", "contract": "hot", "category": "app"}]
    entities += [
        {"slug": f"e{i}", "contract": f"c{i}", "category": "app"} for i in range(0, 300, 3)
    ]
    grants = ids(spark).select(
        F.col("s").alias("receipt_id"),
        F.lit("ADD_KEY").alias("action_kind"),
        F.concat(
            F.lit('{"access_key":{"permission":{"permission_kind":"FUNCTION_CALL",'
                  '"permission_details":{"receiver_id":"'), contract, F.lit('"}}}}'),
        ).alias("args"),
        F.concat(F.lit("account-with-a-long-name-"), "s").alias("receipt_receiver_account_id"),
        F.lit("p").alias("receipt_predecessor_account_id"),
        (F.col("id") + at(0)).alias("receipt_included_in_block_timestamp"),
    )
    ledger = HotLedger(spark, entities=entities, action_receipt_actions=grants)
    small = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    with settings(spark, **SKEW | small):
        df = compute(ledger, "daily_accounts_added_per_ecosystem_entity")
        found = Counter(row.entity_id for row in df.collect())
        text = plan(df)
    assert found["busy"] == N - N // 3
    assert len(found) == 101
    assert re.search(r"SortMergeJoin\(skew=true\) \[contract_id#\d+\]", text)


def test_tables_bucketed_by_receipt_join_without_a_shuffle(spark, landed, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS bucketed_ledger")
    try:
        for name in ("receipts", "execution_outcomes", "blocks"):
            writer = landed.table(name).write.mode("overwrite")
            if name != "blocks":
                writer = writer.bucketBy(4, "receipt_id").sortBy("receipt_id")
            writer.option("path", str(tmp_path / name)).saveAsTable(f"bucketed_ledger.{name}")
        source = CatalogSource(spark, "bucketed_ledger", "unused")
        name = "daily_transaction_count_by_gas_burnt_ranges"
        with settings(spark, **NO_BROADCAST):
            df = compute(source, name)
            assert "hashpartitioning(receipt_id" not in plan(df)
            assert sorted(df.collect()) == sorted(compute(landed, name).collect())
    finally:
        spark.sql("DROP DATABASE bucketed_ledger CASCADE")


def test_a_database_period_is_split_over_readers(spark):
    source = JdbcSource(spark, {"url": "jdbc:none"}, "unused", readers=24)
    assert source.split_options("receipts", at(0), at(1)) == {
        "partitionColumn": "included_in_block_timestamp",
        "lowerBound": str(at(0)),
        "upperBound": str(at(1)),
        "numPartitions": "24",
    }
    assert source.split_options("receipts", at(0), at(0)) == {}


def test_a_database_table_is_split_and_its_extent_computed_there(spark):
    """The options alone: no database runs here."""
    split = {"accounts": "mod(hash(created_by_receipt_id), 8)"}
    source = JdbcSource(spark, {"url": "jdbc:none"}, "unused", 8, split)
    assert source.whole_table_options("chunks") == {}
    options = source.whole_table_options("accounts")
    assert "mod(hash(created_by_receipt_id), 8) AS read_part FROM accounts" in options["dbtable"]
    assert (options["partitionColumn"], options["numPartitions"]) == ("read_part", "8")
    assert "min(block_timestamp) AS first_ns" in source.extent_options()["dbtable"]


def test_shuffles_are_sized_for_the_input(spark):
    assert shuffle_partitions(0) == 1
    assert shuffle_partitions(1024**4) == 4_096
    assert shuffle_partitions(100 * 1024**4) == 409_600
    assert all(spark.conf.get(key) == value for key, value in SETTINGS.items())
    with settings(spark, **{INITIAL_PARTITIONS: "4", "spark.sql.shuffle.partitions": "4"}):
        configure(spark, 10 * 1024**4)
        assert spark.conf.get(INITIAL_PARTITIONS) == "40960"
        configure(spark, 1)
        assert spark.conf.get(INITIAL_PARTITIONS) == "4"


def test_catalog_tables_have_a_size(spark, landed, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS sized_ledger")
    try:
        for name in SOURCE_TABLES:
            table = landed.table(name).write.mode("overwrite")
            table.option("path", str(tmp_path / name)).saveAsTable(f"sized_ledger.{name}")
        size = CatalogSource(spark, "sized_ledger", "unused").size_in_bytes()
        stored = sum(f.stat().st_size for f in tmp_path.rglob("*.parquet"))
        assert stored / 2 < size < 4 * stored
    finally:
        spark.sql("DROP DATABASE sized_ledger CASCADE")
