"""Contracts that are called and contracts that are deployed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstats.operators.periods import Period, one_row_per_period, rows_per_period
from ledgerstats.plans.inputs import Inputs


def _calls(inputs: Inputs, period: Period) -> DataFrame:
    return inputs.between("action_receipt_actions", period.from_ns, period.to_ns).filter(
        F.col("action_kind") == "FUNCTION_CALL"
    )


def active_contracts_count(inputs: Inputs, period: Period) -> DataFrame:
    counts = (
        _calls(inputs, period)
        .groupBy(period.of("receipt_included_in_block_timestamp"))
        .agg(
            F.count_distinct("receipt_receiver_account_id")
            .cast("int")
            .alias("active_contracts_count")
        )
    )
    return one_row_per_period(counts, period, "collected_for_day")


def receipts_per_contract(inputs: Inputs, period: Period) -> DataFrame:
    """Calls of each contract: a receipt with two of them counts twice."""
    counts = (
        _calls(inputs, period)
        .groupBy(
            period.of("receipt_included_in_block_timestamp"),
            F.col("receipt_receiver_account_id").alias("contract_id"),
        )
        .agg(F.count("receipt_id").alias("receipts_count"))
    )
    return rows_per_period(counts, "collected_for_day")


def active_contracts_rollup(stored: DataFrame, period: Period) -> DataFrame:
    """Active contracts from the per-contract table a rebuild has just written."""
    first, stop = (F.date_from_unix_date(F.lit(d)) for d in (period.first, period.stop))
    day = F.col("collected_for_day")
    counts = (
        stored.filter((day >= first) & (day < stop))
        .groupBy(F.unix_date(day).cast("bigint").alias("period"))
        .agg(F.count("contract_id").cast("int").alias("active_contracts_count"))
    )
    return one_row_per_period(counts, period, "collected_for_day")


def _deploying_receipts(inputs: Inputs, period: Period) -> DataFrame:
    """Receipts of the period that deploy code, once each, with the lowest code hash.

    Actions carry a copy of their receipt's time, so the period bounds them as well.
    They are reduced to one row per receipt on the way into the join's shuffle.
    """
    deployments = (
        inputs.actions("args_code_sha256", period=period)
        .filter(F.col("action_kind") == "DEPLOY_CONTRACT")
        .select("receipt_id", F.col("args_code_sha256").alias("code"))
        .groupBy("receipt_id")
        .agg(F.min("code").alias("contract_code_sha256"))
    )
    receipts = inputs.between("receipts", period.from_ns, period.to_ns).select(
        "receipt_id", "receiver_account_id", "included_in_block_timestamp"
    )
    return receipts.join(deployments, "receipt_id")


def new_contracts_count(inputs: Inputs, period: Period) -> DataFrame:
    """Distinct accounts deployed to; an account deployed to again counts again."""
    counts = (
        _deploying_receipts(inputs, period)
        .groupBy(period.of("included_in_block_timestamp"))
        .agg(F.count_distinct("receiver_account_id").cast("int").alias("new_contracts_count"))
    )
    return one_row_per_period(counts, period, "collected_for_day")


def deployed_contracts(inputs: Inputs, period: Period) -> DataFrame:
    """Deployments, one per receipt: of several in one receipt the lowest code hash."""
    return _deploying_receipts(inputs, period).select(
        "contract_code_sha256",
        F.col("receiver_account_id").alias("deployed_to_account_id"),
        F.col("receipt_id").alias("deployed_by_receipt_id"),
        F.col("included_in_block_timestamp").alias("deployed_at_block_timestamp"),
    )


def new_contracts_rollup(stored: DataFrame, period: Period) -> DataFrame:
    """Accounts deployed to, from the table of deployments a rebuild has just written."""
    time = F.col("deployed_at_block_timestamp")
    counts = (
        stored.filter((time >= F.lit(period.from_ns)) & (time < F.lit(period.to_ns)))
        .groupBy(period.of("deployed_at_block_timestamp"))
        .agg(F.count_distinct("deployed_to_account_id").cast("int").alias("new_contracts_count"))
    )
    return one_row_per_period(counts, period, "collected_for_day")


def new_unique_contracts_count(inputs: Inputs, period: Period) -> DataFrame:
    """Code by the day it was first deployed, over all deployments up to the period's end.

    Only the period's own codes are grouped. Earlier deployments serve to tell which of
    them are not new, and are first reduced to the period's codes, so that what is shuffled
    follows the period and not the history.
    """
    deployed, code = inputs.derived("deployed_contracts"), "contract_code_sha256"
    time = F.col("deployed_at_block_timestamp")
    first_seen = (
        deployed.filter((time >= F.lit(period.from_ns)) & (time < F.lit(period.to_ns)))
        .groupBy(code)
        .agg(F.min("deployed_at_block_timestamp").alias("first_deployed"))
    )
    seen = deployed.filter(time < F.lit(period.from_ns)).select(code)
    known = seen.join(first_seen.select(code), code, "left_semi").distinct()
    counts = (
        first_seen.join(known, code, "left_anti")
        .groupBy(period.of("first_deployed"))
        .agg(F.count(F.lit(1)).cast("int").alias("new_unique_contracts_count"))
    )
    return one_row_per_period(counts, period, "collected_for_day")
