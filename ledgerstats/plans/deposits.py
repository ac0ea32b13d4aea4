"""Tokens moved by successful calls and transfers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerstats.functions.wide import from_digits
from ledgerstats.functions.widesum import limbs_of, sum_limbs, with_digits
from ledgerstats.operators.periods import Period, one_row_per_period
from ledgerstats.plans.inputs import Inputs


def _deposits(inputs: Inputs) -> DataFrame:
    """The deposits of all actions, as text."""
    return (
        inputs.actions("args_deposit")
        .filter(F.col("receipt_predecessor_account_id") != "system")
        .filter(F.col("action_kind").isin("FUNCTION_CALL", "TRANSFER"))
        .select("receipt_id", F.col("args_deposit").alias("deposit"))
    )


def _successful(inputs: Inputs, period: Period) -> DataFrame:
    """Successful outcomes with the day of their execution."""
    return (
        inputs.between("execution_outcomes", period.from_ns, period.to_ns)
        .filter(F.col("status").isin("SUCCESS_VALUE", "SUCCESS_RECEIPT_ID"))
        .select("receipt_id", period.of("executed_in_block_timestamp"))
    )


def deposit_amount(inputs: Inputs, period: Period) -> DataFrame:
    """Deposits by the day they were executed; a sum past 38 digits fails the job.

    Nothing bounds how long a receipt waits for its execution, so all actions are read for
    any period; the ids of the period's outcomes filter them in the scan. They are summed
    per receipt on the way into the join's shuffle.
    """
    outcomes = _successful(inputs, period)
    per_receipt = (
        _deposits(inputs)
        .withColumn("deposit", F.col("deposit").cast("decimal(38,0)"))
        .filter(F.col("deposit") > 0)
        .groupBy("receipt_id")
        .agg(F.sum("deposit").alias("deposit"))
    )
    totals = (
        inputs.matched(outcomes, per_receipt, "receipt_id")
        .groupBy("period")
        .agg(F.sum("deposit").alias("deposit_amount"))
    )
    return one_row_per_period(totals, period, "collected_for_day")


def deposit_amount_wide(inputs: Inputs, period: Period) -> DataFrame:
    """The same as text, exact for deposits and sums of any declared width."""
    outcomes = _successful(inputs, period)
    limbs = limbs_of(F.col("deposit"), 5)
    names = [f"_limb{i}" for i in range(len(limbs))]
    per_receipt = (
        _deposits(inputs)
        .filter(F.col("deposit").isNotNull())
        .groupBy("receipt_id")
        .agg(*sum_limbs(limbs))
    )
    again: list[Column] = [F.sum(name).alias(name) for name in names]
    sums = inputs.matched(outcomes, per_receipt, "receipt_id").groupBy("period").agg(*again)
    return one_row_per_period(
        with_digits(sums, len(limbs), "deposit_amount"), period, "collected_for_day"
    )


def deposit_amount_stored(inputs: Inputs, period: Period) -> DataFrame:
    """The same as a number of up to fifty digits, which a store declares and compares."""
    return deposit_amount_wide(inputs, period).withColumn(
        "deposit_amount", from_digits(F.col("deposit_amount"))
    )
