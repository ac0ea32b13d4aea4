"""Column contracts of the ledger tables that are read and of the tables that are written.

All names, types and keys here are fixed values: readers of the derived tables
rely on them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from ledgerstats.functions.wide import WIDE

GAS = T.DecimalType(20, 0)
GAS_TOTAL = T.DecimalType(30, 0)
BALANCE = T.DecimalType(38, 0)


def _columns(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, type_, True) for name, type_ in types.items()])


_TEXT, _LONG, _INT, _DATE, _BOOL = (
    T.StringType(),
    T.LongType(),
    T.IntegerType(),
    T.DateType(),
    T.BooleanType(),
)

SOURCE_TABLES: dict[str, T.StructType] = {
    "blocks": _columns(block_hash=_TEXT, block_timestamp=_LONG, gas_price=BALANCE),
    "chunks": _columns(included_in_block_hash=_TEXT, gas_used=GAS),
    "transactions": _columns(
        transaction_hash=_TEXT, signer_account_id=_TEXT, block_timestamp=_LONG
    ),
    "receipts": _columns(
        receipt_id=_TEXT,
        receiver_account_id=_TEXT,
        originated_from_transaction_hash=_TEXT,
        included_in_block_timestamp=_LONG,
    ),
    "action_receipt_actions": _columns(
        receipt_id=_TEXT,
        action_kind=_TEXT,
        args=_TEXT,
        receipt_receiver_account_id=_TEXT,
        receipt_predecessor_account_id=_TEXT,
        receipt_included_in_block_timestamp=_LONG,
    ),
    "execution_outcomes": _columns(
        receipt_id=_TEXT, executed_in_block_timestamp=_LONG, gas_burnt=GAS, status=_TEXT
    ),
    "accounts": _columns(created_by_receipt_id=_TEXT, deleted_by_receipt_id=_TEXT),
}

# The column, in nanoseconds since the epoch, by which each table is restricted to a period.
TIME_COLUMN: dict[str, str] = {
    "blocks": "block_timestamp",
    "transactions": "block_timestamp",
    "receipts": "included_in_block_timestamp",
    "action_receipt_actions": "receipt_included_in_block_timestamp",
    "execution_outcomes": "executed_in_block_timestamp",
}

ENTITY_RECORD = _columns(
    slug=_TEXT,
    title=_TEXT,
    oneliner=_TEXT,
    website=_TEXT,
    category=_TEXT,
    status=_TEXT,
    contract=_TEXT,
    logo=_TEXT,
)


@dataclass(frozen=True)
class DerivedTable:
    """A stored result: its columns, its primary key, and which columns may hold NULL.

    `dated_by` is a column whose value follows from the key, so that a row can only
    conflict with stored rows of its own period.
    """

    schema: T.StructType
    key: tuple[str, ...]
    nullable: frozenset[str] = frozenset()
    partition_by: str | None = None
    dated_by: str | None = None

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


def _per_day(value: str, type_: T.DataType) -> DerivedTable:
    return DerivedTable(
        _columns(collected_for_day=_DATE, **{value: type_}),
        key=("collected_for_day",),
        dated_by="collected_for_day",
    )


def _per_day_and(key: str, key_type: T.DataType, count: str) -> DerivedTable:
    return DerivedTable(
        _columns(collected_for_day=_DATE, **{key: key_type, count: _LONG}),
        key=("collected_for_day", key),
        partition_by="collected_for_day",
        dated_by="collected_for_day",
    )


DERIVED_TABLES: dict[str, DerivedTable] = {
    "daily_accounts_added_per_ecosystem_entity": DerivedTable(
        _columns(entity_id=_TEXT, account_id=_TEXT, added_at_block_timestamp=_LONG),
        key=("entity_id", "account_id"),
    ),
    "daily_active_accounts_count": _per_day("active_accounts_count", _INT),
    "daily_active_contracts_count": _per_day("active_contracts_count", _INT),
    "daily_deleted_accounts_count": _per_day("deleted_accounts_count", _INT),
    "daily_deposit_amount": _per_day("deposit_amount", BALANCE),
    "daily_gas_used": _per_day("gas_used", GAS_TOTAL),
    "daily_ingoing_transactions_per_account_count": _per_day_and(
        "account_id", _TEXT, "ingoing_transactions_count"
    ),
    "daily_new_accounts_count": _per_day("new_accounts_count", _INT),
    "daily_new_accounts_per_ecosystem_entity_count": _per_day_and(
        "entity_id", _TEXT, "new_accounts_count"
    ),
    "daily_new_contracts_count": _per_day("new_contracts_count", _INT),
    "daily_new_unique_contracts_count": _per_day("new_unique_contracts_count", _INT),
    "daily_outgoing_transactions_per_account_count": _per_day_and(
        "account_id", _TEXT, "outgoing_transactions_count"
    ),
    "daily_receipts_per_contract_count": _per_day_and("contract_id", _TEXT, "receipts_count"),
    "daily_tokens_spent_on_fees": _per_day("tokens_spent_on_fees", BALANCE),
    "daily_transaction_count_by_gas_burnt_ranges": _per_day_and(
        "top_of_range_in_teragas", _INT, "transactions_count"
    ),
    "daily_transactions_count": _per_day("transactions_count", _LONG),
    "deployed_contracts": DerivedTable(
        _columns(
            contract_code_sha256=_TEXT,
            deployed_to_account_id=_TEXT,
            deployed_by_receipt_id=_TEXT,
            deployed_at_block_timestamp=_LONG,
        ),
        key=("deployed_by_receipt_id",),
        dated_by="deployed_at_block_timestamp",
    ),
    "weekly_active_accounts_count": DerivedTable(
        _columns(collected_for_week=_DATE, active_accounts_count=_INT),
        key=("collected_for_week",),
        dated_by="collected_for_week",
    ),
    # Sums of up to fifty digits.
    "daily_deposit_amount_wide": _per_day("deposit_amount", WIDE),
    "daily_tokens_spent_on_fees_wide": _per_day("tokens_spent_on_fees", WIDE),
    "near_ecosystem_entities": DerivedTable(
        T.StructType(
            ENTITY_RECORD.fields
            + _columns(
                is_app=_BOOL, is_nft=_BOOL, is_guild=_BOOL, is_defi=_BOOL, is_dao=_BOOL
            ).fields
        ),
        key=("slug",),
        nullable=frozenset(ENTITY_RECORD.fieldNames()[1:])
        | {"is_app", "is_nft", "is_guild", "is_defi", "is_dao"},
    ),
}
