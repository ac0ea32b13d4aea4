"""The entity catalogue and the accounts that grant its contracts an access key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstats.functions.contracts import CONTRACT_SEPARATOR, category_flags, identifier
from ledgerstats.operators.firstwrite import first_per_key
from ledgerstats.operators.periods import Period, rows_per_period
from ledgerstats.plans.inputs import Inputs
from ledgerstats.schemas import ENTITY_RECORD

# Fixed value: the entity that stands for the network itself gains no accounts.
NETWORK_ENTITY = "near"

CATALOGUE = "near_ecosystem_entities"
ACCOUNTS_ADDED = "daily_accounts_added_per_ecosystem_entity"


def catalogue(inputs: Inputs, period: Period | None = None) -> DataFrame:
    """The first record of each slug, with a flag per category word."""
    records = first_per_key(inputs.source.entities(), ["slug"], [F.col("_position")])
    return records.select(*ENTITY_RECORD.fieldNames(), *category_flags(F.col("category")))


def contract_entities(entities: DataFrame) -> DataFrame:
    """The one entity of each listed contract: of several, the lowest."""
    listed = entities.filter(F.length("contract") > 0).select(
        identifier(F.col("slug")).alias("entity_id"),
        F.explode(F.split("contract", CONTRACT_SEPARATOR)).alias("contract_id"),
    )
    contract = identifier(F.col("contract_id"))
    # The length follows from the contract and changes no group, but the rows are then not
    # dealt out by contract alone: a join on it shuffles them anew, and only a join of two
    # such shuffles is one whose skew adaptive execution can split.
    return (
        listed.groupBy(contract.alias("contract_id"), F.length(contract).alias("length"))
        .agg(F.min("entity_id").alias("entity_id"))
        .drop("length")
    )


def accounts_added(
    inputs: Inputs, period: Period, network_entity: str = NETWORK_ENTITY
) -> DataFrame:
    """When each account first gave a contract of an entity a function-call key.

    Keys are reduced to the first of each contract and account before the join. The
    catalogue has no broadcast hint: Spark broadcasts it while its size is within
    `spark.sql.autoBroadcastJoinThreshold`. Otherwise both sides are shuffled by contract,
    and adaptive execution splits a contract that many accounts gave keys.
    """
    granted = (
        inputs.actions("args_permission_kind", "args_permitted_contract", period=period)
        .filter(F.col("action_kind") == "ADD_KEY")
        .filter(F.col("args_permission_kind") == "FUNCTION_CALL")
        .groupBy(
            F.col("args_permitted_contract").alias("contract_id"),
            F.col("receipt_receiver_account_id").alias("account_id"),
        )
        .agg(F.min("receipt_included_in_block_timestamp").alias("added_at"))
    )
    return (
        granted.join(contract_entities(inputs.derived(CATALOGUE)), "contract_id")
        .filter(~F.col("entity_id").isin(F.col("account_id"), F.lit(network_entity)))
        .groupBy("entity_id", "account_id")
        .agg(F.min("added_at").alias("added_at_block_timestamp"))
    )


def new_accounts_per_entity(inputs: Inputs, period: Period) -> DataFrame:
    added_at = F.col("added_at_block_timestamp")
    counts = (
        inputs.derived(ACCOUNTS_ADDED)
        .filter((added_at >= F.lit(period.from_ns)) & (added_at < F.lit(period.to_ns)))
        .groupBy(period.of("added_at_block_timestamp"), "entity_id")
        .agg(F.count(F.lit(1)).alias("new_accounts_count"))
    )
    return rows_per_period(counts, "collected_for_day")
