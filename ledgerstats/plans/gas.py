"""Gas used, what it cost, and how transactions spread over gas ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerstats.functions.wide import from_digits
from ledgerstats.functions.widesum import limbs_of, product_limbs, sum_limbs, with_digits
from ledgerstats.operators.periods import Period, one_row_per_period, rows_per_period
from ledgerstats.plans.inputs import Inputs

# Width of a gas range, in teragas and in gas.
RANGE_TERAGAS = 50
RANGE_GAS = 50_000_000_000_000


def _gas_per_block(inputs: Inputs, period: Period) -> DataFrame:
    """Blocks of the period with the gas of their chunks.

    Chunks are summed per block on the way into the join's shuffle, however many of
    them one block holds.
    """
    per_block = (
        inputs.table("chunks")
        .groupBy(F.col("included_in_block_hash").alias("block_hash"))
        .agg(F.sum("gas_used").alias("block_gas"))
    )
    blocks = inputs.between("blocks", period.from_ns, period.to_ns).select(
        "block_hash", "gas_price", period.of("block_timestamp")
    )
    return inputs.matched(blocks, per_block, "block_hash")


def _total_gas() -> Column:
    return F.sum("block_gas").cast("decimal(30,0)").alias("gas_used")


def _total_fees() -> Column:
    fee = (F.col("block_gas") * F.col("gas_price")).cast("decimal(38,0)")
    return F.sum(fee).alias("tokens_spent_on_fees")


def gas_used(inputs: Inputs, period: Period) -> DataFrame:
    totals = _gas_per_block(inputs, period).groupBy("period").agg(_total_gas())
    return one_row_per_period(totals, period, "collected_for_day")


def tokens_spent_on_fees(inputs: Inputs, period: Period) -> DataFrame:
    totals = _gas_per_block(inputs, period).groupBy("period").agg(_total_fees())
    return one_row_per_period(totals, period, "collected_for_day")


def gas_and_fees(inputs: Inputs, period: Period) -> DataFrame:
    """(period, gas_used, tokens_spent_on_fees) from one join."""
    return _gas_per_block(inputs, period).groupBy("period").agg(_total_gas(), _total_fees())


def tokens_spent_on_fees_wide(inputs: Inputs, period: Period) -> DataFrame:
    """The same as text, exact also beyond 38 digits."""
    gas = limbs_of(F.col("block_gas").cast("string"), 4)
    price = limbs_of(F.col("gas_price").cast("string"), 4)
    limbs = product_limbs(gas, price)
    sums = _gas_per_block(inputs, period).groupBy("period").agg(*sum_limbs(limbs))
    totals = with_digits(sums, len(limbs), "tokens_spent_on_fees")
    return one_row_per_period(totals, period, "collected_for_day")


def tokens_spent_on_fees_stored(inputs: Inputs, period: Period) -> DataFrame:
    """The same as a number of up to fifty digits, which a store declares and compares."""
    return tokens_spent_on_fees_wide(inputs, period).withColumn(
        "tokens_spent_on_fees", from_digits(F.col("tokens_spent_on_fees"))
    )


def transactions_by_gas_burnt(inputs: Inputs, period: Period) -> DataFrame:
    """Transactions per gas range, a range named by its upper end.

    Gas is summed per transaction over the receipts of one day, so a transaction that
    runs past midnight is counted on both days. `div` of the 30-digit sum by a range's
    gas stays within a bigint.
    """
    receipts = inputs.between("receipts", period.from_ns, period.to_ns).select(
        "receipt_id",
        F.col("originated_from_transaction_hash").alias("transaction_hash"),
        period.of("included_in_block_timestamp"),
    )
    outcomes = inputs.table("execution_outcomes").select("receipt_id", "gas_burnt")
    gas_per_transaction = (
        inputs.matched(receipts, outcomes, "receipt_id")
        .groupBy("period", "transaction_hash")
        .agg(F.sum("gas_burnt").alias("gas"))
    )
    top = F.expr(f"cast((gas div {RANGE_GAS}BD + 1) * {RANGE_TERAGAS} as int)")
    counts = gas_per_transaction.groupBy("period", top.alias("top_of_range_in_teragas")).agg(
        F.count("transaction_hash").alias("transactions_count")
    )
    return rows_per_period(counts, "collected_for_day")
