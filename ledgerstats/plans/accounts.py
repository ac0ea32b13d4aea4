"""Accounts that appear and disappear."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstats.operators.periods import Period, one_row_per_period
from ledgerstats.plans.inputs import Inputs


def _accounts_by_receipt(
    inputs: Inputs, period: Period, receipt_column: str, name: str
) -> DataFrame:
    """Accounts by the day of the receipt that a column of theirs names.

    Accounts are counted per receipt first: that takes the shuffle the join needs
    anyway, and a receipt named by very many accounts moves as a few partial counts.
    """
    per_receipt = (
        inputs.table("accounts", by=receipt_column)
        .filter(F.col(receipt_column).isNotNull())
        .groupBy(F.col(receipt_column).alias("receipt_id"))
        .agg(F.count(F.lit(1)).alias("accounts"))
    )
    receipts = inputs.between("receipts", period.from_ns, period.to_ns).select(
        "receipt_id", period.of("included_in_block_timestamp")
    )
    counts = (
        inputs.matched(receipts, per_receipt, "receipt_id")
        .groupBy("period")
        .agg(F.sum("accounts").cast("int").alias(name))
    )
    return one_row_per_period(counts, period, "collected_for_day")


def new_accounts_count(inputs: Inputs, period: Period) -> DataFrame:
    return _accounts_by_receipt(inputs, period, "created_by_receipt_id", "new_accounts_count")


def deleted_accounts_count(inputs: Inputs, period: Period) -> DataFrame:
    return _accounts_by_receipt(inputs, period, "deleted_by_receipt_id", "deleted_accounts_count")


def new_and_deleted_accounts(inputs: Inputs, period: Period) -> DataFrame:
    """(period, new_accounts_count, deleted_accounts_count) from one join.

    An account is counted at the receipt that created it and at the one that deleted it, so the
    receipts, which are far more, are moved once for both.
    """
    both = [
        F.struct(F.col(f"{verb}_by_receipt_id").alias("receipt_id"), *[
            F.lit(int(verb == other)).alias(other) for other in ("created", "deleted")
        ])
        for verb in ("created", "deleted")
    ]
    per_receipt = (
        inputs.table("accounts")
        .select(F.explode(F.array(*both)).alias("at"))
        .filter(F.col("at.receipt_id").isNotNull())
        .groupBy(F.col("at.receipt_id").alias("receipt_id"))
        .agg(F.sum("at.created").alias("created"), F.sum("at.deleted").alias("deleted"))
    )
    receipts = inputs.between("receipts", period.from_ns, period.to_ns).select(
        "receipt_id", period.of("included_in_block_timestamp")
    )
    return (
        inputs.matched(receipts, per_receipt, "receipt_id")
        .groupBy("period")
        .agg(
            F.sum("created").cast("int").alias("new_accounts_count"),
            F.sum("deleted").cast("int").alias("deleted_accounts_count"),
        )
    )
