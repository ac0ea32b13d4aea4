"""How many transactions there are, who signs them and whom they reach."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstats.functions.calendar import DAY_NS
from ledgerstats.operators.periods import (
    GRACE_NS,
    Period,
    one_row_per_period,
    rows_per_period,
)
from ledgerstats.plans.inputs import Inputs


def _transactions(inputs: Inputs, period: Period) -> DataFrame:
    return inputs.between("transactions", period.from_ns, period.to_ns)


def transactions_count(inputs: Inputs, period: Period) -> DataFrame:
    counts = (
        _transactions(inputs, period)
        .groupBy(period.of("block_timestamp"))
        .agg(F.count(F.lit(1)).alias("transactions_count"))
    )
    return one_row_per_period(counts, period, "collected_for_day")


def active_accounts_count(inputs: Inputs, period: Period) -> DataFrame:
    """Distinct signers of each day or week."""
    counts = (
        _transactions(inputs, period)
        .groupBy(period.of("block_timestamp"))
        .agg(F.count_distinct("signer_account_id").cast("int").alias("active_accounts_count"))
    )
    return one_row_per_period(counts, period, f"collected_for_{period.unit}")


def outgoing_transactions(inputs: Inputs, period: Period) -> DataFrame:
    counts = (
        _transactions(inputs, period)
        .groupBy(period.of("block_timestamp"), F.col("signer_account_id").alias("account_id"))
        .agg(F.count(F.lit(1)).alias("outgoing_transactions_count"))
    )
    return rows_per_period(counts, "collected_for_day")


def ingoing_transactions(inputs: Inputs, period: Period) -> DataFrame:
    """Transactions of a day with a receipt at the account, the signer's own excluded.

    The receipts of a day's transactions run on into the next day's first minutes. That
    bound depends on each transaction's day; the bounds of the whole range are stated on
    the receipts as well, since they do not follow from those on the transactions and
    keep the join small. The distinct count starts from the join's own partitioning by
    hash, and only counts per account move after it.
    """
    transactions = _transactions(inputs, period).select(
        "transaction_hash", "signer_account_id", period.of("block_timestamp")
    )
    receipts = inputs.between("receipts", period.from_ns, period.to_ns + GRACE_NS).select(
        "originated_from_transaction_hash", "receiver_account_id", "included_in_block_timestamp"
    )
    day_start = F.col("period") * DAY_NS
    belongs = (
        (F.col("originated_from_transaction_hash") == F.col("transaction_hash"))
        & (F.col("signer_account_id") != F.col("receiver_account_id"))
        & (F.col("included_in_block_timestamp") >= day_start)
        & (F.col("included_in_block_timestamp") < day_start + (DAY_NS + GRACE_NS))
    )
    counts = (
        receipts.join(transactions, belongs)
        .groupBy("period", F.col("receiver_account_id").alias("account_id"))
        .agg(F.count_distinct("transaction_hash").alias("ingoing_transactions_count"))
    )
    return rows_per_period(counts, "collected_for_day")


# The same results from the per-account table, once a rebuild has just written it: one
# row per account and day instead of one per transaction.


def _per_account(stored: DataFrame, period: Period) -> DataFrame:
    day = F.unix_date("collected_for_day").cast("bigint")
    dates = [F.date_from_unix_date(F.lit(d)) for d in (period.first, period.stop)]
    return stored.filter(
        (F.col("collected_for_day") >= dates[0]) & (F.col("collected_for_day") < dates[1])
    ).withColumn("period", day if period.unit == "day" else day - F.pmod(day + 3, F.lit(7)))


def transactions_count_rollup(stored: DataFrame, period: Period) -> DataFrame:
    counts = (
        _per_account(stored, period)
        .groupBy("period")
        .agg(F.sum("outgoing_transactions_count").alias("transactions_count"))
    )
    return one_row_per_period(counts, period, "collected_for_day")


def active_accounts_rollup(stored: DataFrame, period: Period) -> DataFrame:
    """An account has one row per day, so a day needs no distinct count; a week does."""
    accounts = F.count("account_id") if period.unit == "day" else F.count_distinct("account_id")
    counts = (
        _per_account(stored, period)
        .groupBy("period")
        .agg(accounts.cast("int").alias("active_accounts_count"))
    )
    return one_row_per_period(counts, period, f"collected_for_{period.unit}")
