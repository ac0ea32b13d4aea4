"""DuckDB SQL for every query of `__spark_entry__`, over the driver's own views.

Each statement starts with the same CTEs (FIXTURES.md section 2) and is written for the
whole range of complete periods.
"""

from __future__ import annotations

LEDGER = """
WITH ev AS (
  SELECT event_id, user_id, event_type,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         epoch_us(ts) * 1000 AS ts_ns,
         CAST(round(value * 100) AS BIGINT) AS cents
  FROM events),
fx_transactions AS (
  SELECT CAST(event_id // 4 AS VARCHAR) AS transaction_hash,
         'u' || user_id AS signer_account_id,
         ts_ns AS block_timestamp
  FROM ev WHERE event_id % 4 = 0),
fx_receipts AS (
  SELECT CAST(event_id AS VARCHAR) AS receipt_id,
         'u' || user_id AS receiver_account_id,
         CAST(event_id // 4 AS VARCHAR) AS originated_from_transaction_hash,
         ts_ns AS included_in_block_timestamp
  FROM ev),
fx_actions AS (
  SELECT CAST(event_id AS VARCHAR) AS receipt_id,
         'u' || user_id AS receipt_receiver_account_id,
         CASE WHEN k % 10 = 0 THEN 'system' ELSE 'u' || (k % 50) END
           AS receipt_predecessor_account_id,
         ts_ns AS receipt_included_in_block_timestamp,
         CASE event_type WHEN 'click' THEN 'FUNCTION_CALL' WHEN 'purchase' THEN 'TRANSFER'
                         WHEN 'view' THEN 'ADD_KEY' WHEN 'signup' THEN 'CREATE_ACCOUNT'
                         ELSE 'DEPLOY_CONTRACT' END AS action_kind,
         CASE WHEN event_type IN ('click', 'purchase')
                THEN '{"deposit":"' || (CASE WHEN k % 5 = 0 THEN '0'
                     ELSE CAST(cents AS VARCHAR) || '0000000000000000000000' END) || '"}'
              WHEN event_type = 'view' AND k % 4 = 0
                THEN '{"access_key":{"permission":{"permission_kind":"FULL_ACCESS"}}}'
              WHEN event_type = 'view'
                THEN '{"access_key":{"permission":{"permission_kind":"FUNCTION_CALL",'
                  || '"permission_details":{"receiver_id":"c' || (k % 70) || '"}}}}'
              WHEN event_type = 'error'
                THEN '{"code_sha256":"h' || ((user_id * 100 + k) % 1500) || '"}'
              ELSE '{}' END AS args
  FROM ev
  UNION ALL
  SELECT CAST(event_id AS VARCHAR), 'u' || user_id, 'u' || (k % 50), ts_ns,
         CASE WHEN event_type = 'error' THEN 'DEPLOY_CONTRACT' ELSE 'FUNCTION_CALL' END,
         CASE WHEN event_type = 'error'
                THEN '{"code_sha256":"h' || ((user_id * 100 + k + 7) % 1500) || '"}'
              ELSE '{"deposit":"1"}' END
  FROM ev WHERE event_id % 9 = 0),
fx_outcomes AS (
  SELECT CAST(event_id AS VARCHAR) AS receipt_id,
         ts_ns + k * 1000000000 AS executed_in_block_timestamp,
         cents * 50000000000 AS gas_burnt,
         CASE event_id % 7 WHEN 0 THEN 'FAILURE' WHEN 1 THEN 'UNKNOWN'
                           WHEN 2 THEN 'SUCCESS_RECEIPT_ID' ELSE 'SUCCESS_VALUE' END AS status
  FROM ev),
fx_accounts AS (
  SELECT CAST(event_id AS VARCHAR) AS created_by_receipt_id,
         CASE WHEN k % 3 = 0 THEN CAST(event_id + 200 AS VARCHAR) END AS deleted_by_receipt_id
  FROM ev WHERE event_type = 'signup'),
fx_blocks AS (
  SELECT CAST(ts_ns // 3600000000000 AS VARCHAR) AS block_hash,
         min(ts_ns) AS block_timestamp,
         100000000 + max(k) AS gas_price
  FROM ev GROUP BY ts_ns // 3600000000000),
fx_chunks AS (
  SELECT CAST(ts_ns // 3600000000000 AS VARCHAR) AS included_in_block_hash,
         CAST(sum(cents * 50000000000) AS BIGINT) AS gas_used
  FROM ev GROUP BY ts_ns // 3600000000000, user_id % 4),
fx_entities AS (
  SELECT CASE n_nationkey WHEN 0 THEN 'near' WHEN 2 THEN 'u7' WHEN 3 THEN 'o''k'
                          ELSE lower(n_name) END AS slug,
         n_name AS title,
         CASE n_regionkey WHEN 0 THEN 'app nft' WHEN 1 THEN 'defi'
                          WHEN 2 THEN 'dao guild' ELSE 'app' END AS category,
         CASE WHEN n_nationkey = 2
                THEN 'c2, c27, c50, c51, c53, c54, c55, c57, c58, c59, c61, c62, c63, c65, c66, c67'
              WHEN n_nationkey % 5 = 4 THEN ''
              WHEN n_nationkey % 5 = 3 THEN ' ''c' || n_nationkey || ''''
              WHEN n_nationkey = 5 THEN 'c5, c1'
              ELSE 'c' || n_nationkey || ', c' || (n_nationkey + 25) END AS contract
  FROM nation),
extent AS (
  SELECT min(block_timestamp) // 86400000000000 AS genesis_day,
         (max(block_timestamp) // 1000000000 - 600) // 86400 AS end_day
  FROM fx_blocks),
days AS (
  SELECT unnest(generate_series(genesis_day, end_day - 1)) AS d FROM extent),
weeks AS (
  SELECT unnest(generate_series(genesis_day - (genesis_day + 3) % 7,
                                end_day - (end_day + 3) % 7 - 7, 7)) AS d
  FROM extent),
contract_map AS (
  SELECT replace(trim(c), '''', '') AS contract_id, min(replace(trim(slug), '''', '')) AS entity_id
  FROM (SELECT slug, unnest(string_split(contract, ', ')) AS c
        FROM fx_entities WHERE length(contract) > 0) AS listed
  GROUP BY 1),
added AS (
  SELECT entity_id, account_id, min(added_at) AS added_at
  FROM (SELECT json_extract_string(args, '$.access_key.permission.permission_details.receiver_id')
                 AS contract_id,
               receipt_receiver_account_id AS account_id,
               receipt_included_in_block_timestamp AS added_at
        FROM fx_actions, extent
        WHERE action_kind = 'ADD_KEY'
          AND json_extract_string(args, '$.access_key.permission.permission_kind')
                = 'FUNCTION_CALL'
          AND receipt_included_in_block_timestamp < end_day * 86400000000000) AS granted
  JOIN contract_map USING (contract_id)
  WHERE entity_id <> account_id AND entity_id <> 'near'
  GROUP BY entity_id, account_id),
deployed AS (
  SELECT receipt_id, min(json_extract_string(args, '$.code_sha256')) AS code,
         any_value(receiver_account_id) AS account_id,
         any_value(included_in_block_timestamp) AS deployed_at
  FROM fx_actions JOIN fx_receipts USING (receipt_id), extent
  WHERE action_kind = 'DEPLOY_CONTRACT'
    AND included_in_block_timestamp < end_day * 86400000000000
  GROUP BY receipt_id),
reached AS (
  SELECT t.d, account_id, transaction_hash
  FROM (SELECT transaction_hash, signer_account_id, block_timestamp // 86400000000000 AS d
        FROM fx_transactions) AS t
  JOIN (SELECT originated_from_transaction_hash AS transaction_hash,
               receiver_account_id AS account_id, included_in_block_timestamp AS included
        FROM fx_receipts) AS r USING (transaction_hash)
  WHERE signer_account_id <> account_id
    AND included >= t.d * 86400000000000
    AND included < (t.d + 1) * 86400000000000 + 600000000000)
"""

DAY = "DATE '1970-01-01' + CAST(d AS INTEGER)"


def _per_period(value: str, type_: str, values: str, spine: str = "days") -> str:
    """`values` has columns d and v; periods without a row give zero."""
    date = "collected_for_week" if spine == "weeks" else "collected_for_day"
    return (
        f"{LEDGER}, found AS ({values})\n"
        f"SELECT {DAY} AS {date}, CAST(coalesce(v, 0) AS {type_}) AS {value}\n"
        f"FROM {spine} LEFT JOIN found USING (d)"
    )


def _per_key(columns: str, values: str) -> str:
    return (
        f"{LEDGER}, found AS ({values})\n"
        f"SELECT {DAY} AS collected_for_day, {columns}\n"
        "FROM found JOIN days USING (d)"
    )


def _day(column: str) -> str:
    return f"{column} // 86400000000000"


_SIGNERS_PER_DAY = (
    f"SELECT {_day('block_timestamp')} AS d, count(DISTINCT signer_account_id) AS v "
    "FROM fx_transactions GROUP BY 1"
)
_DEPOSITS = (
    f"SELECT {_day('executed_in_block_timestamp')} AS d, "
    "sum(CAST(json_extract_string(args, '$.deposit') AS DECIMAL(38,0))) AS v "
    "FROM fx_actions JOIN fx_outcomes USING (receipt_id) "
    "WHERE receipt_predecessor_account_id <> 'system' "
    "AND action_kind IN ('FUNCTION_CALL', 'TRANSFER') "
    "AND CAST(json_extract_string(args, '$.deposit') AS DECIMAL(38,0)) > 0 "
    "AND status IN ('SUCCESS_VALUE', 'SUCCESS_RECEIPT_ID') GROUP BY 1"
)
_FEES = (
    f"SELECT {_day('block_timestamp')} AS d, "
    "sum(CAST(gas_used AS DECIMAL(20,0)) * CAST(gas_price AS DECIMAL(18,0))) AS v "
    "FROM fx_blocks JOIN fx_chunks ON included_in_block_hash = block_hash GROUP BY 1"
)


def _accounts_by(column: str) -> str:
    return (
        f"SELECT {_day('included_in_block_timestamp')} AS d, count({column}) AS v "
        f"FROM fx_accounts JOIN fx_receipts ON receipt_id = {column} GROUP BY 1"
    )


_CATALOGUE = f"""{LEDGER}
SELECT slug, title, CAST(NULL AS VARCHAR) AS oneliner, CAST(NULL AS VARCHAR) AS website, category,
       CAST(NULL AS VARCHAR) AS status, contract, CAST(NULL AS VARCHAR) AS logo,
       contains(category, 'app') AS is_app, contains(category, 'nft') AS is_nft,
       contains(category, 'guild') AS is_guild, contains(category, 'defi') AS is_defi,
       contains(category, 'dao') AS is_dao
FROM fx_entities"""

# The fixed day and week of the single-period queries.
ONE_DAY = 19732  # 2024-01-10
ONE_DAY_TIMESTAMP = ONE_DAY * 86400 + 45_296
ONE_WEEK = 19730  # Monday, 2024-01-08

ORACLES: dict[str, str] = {
    "daily_accounts_added_per_ecosystem_entity": f"""{LEDGER}
SELECT entity_id, account_id, added_at AS added_at_block_timestamp FROM added""",
    "daily_active_accounts_count": _per_period(
        "active_accounts_count", "INTEGER", _SIGNERS_PER_DAY
    ),
    "daily_active_contracts_count": _per_period(
        "active_contracts_count",
        "INTEGER",
        f"SELECT {_day('receipt_included_in_block_timestamp')} AS d, "
        "count(DISTINCT receipt_receiver_account_id) AS v "
        "FROM fx_actions WHERE action_kind = 'FUNCTION_CALL' GROUP BY 1",
    ),
    "daily_deleted_accounts_count": _per_period(
        "deleted_accounts_count", "INTEGER", _accounts_by("deleted_by_receipt_id")
    ),
    "daily_deposit_amount": _per_period("deposit_amount", "DECIMAL(38,0)", _DEPOSITS),
    "daily_gas_used": _per_period(
        "gas_used",
        "DECIMAL(30,0)",
        f"SELECT {_day('block_timestamp')} AS d, sum(gas_used) AS v "
        "FROM fx_blocks JOIN fx_chunks ON included_in_block_hash = block_hash GROUP BY 1",
    ),
    "daily_ingoing_transactions_per_account_count": _per_key(
        "account_id, v AS ingoing_transactions_count",
        "SELECT d, account_id, count(DISTINCT transaction_hash) AS v FROM reached GROUP BY 1, 2",
    ),
    "daily_new_accounts_count": _per_period(
        "new_accounts_count", "INTEGER", _accounts_by("created_by_receipt_id")
    ),
    "daily_new_accounts_per_ecosystem_entity_count": _per_key(
        "entity_id, v AS new_accounts_count",
        f"SELECT {_day('added_at')} AS d, entity_id, count(*) AS v FROM added GROUP BY 1, 2",
    ),
    "daily_new_contracts_count": _per_period(
        "new_contracts_count",
        "INTEGER",
        f"SELECT {_day('included_in_block_timestamp')} AS d, "
        "count(DISTINCT receiver_account_id) AS v "
        "FROM fx_receipts JOIN fx_actions USING (receipt_id) "
        "WHERE action_kind = 'DEPLOY_CONTRACT' GROUP BY 1",
    ),
    "daily_new_unique_contracts_count": _per_period(
        "new_unique_contracts_count",
        "INTEGER",
        "SELECT d, count(*) AS v FROM (SELECT code, "
        f"min({_day('deployed_at')}) AS d FROM deployed GROUP BY 1) AS firsts GROUP BY 1",
    ),
    "daily_outgoing_transactions_per_account_count": _per_key(
        "account_id, v AS outgoing_transactions_count",
        f"SELECT {_day('block_timestamp')} AS d, signer_account_id AS account_id, count(*) AS v "
        "FROM fx_transactions GROUP BY 1, 2",
    ),
    "daily_receipts_per_contract_count": _per_key(
        "contract_id, v AS receipts_count",
        f"SELECT {_day('receipt_included_in_block_timestamp')} AS d, "
        "receipt_receiver_account_id AS contract_id, count(receipt_id) AS v "
        "FROM fx_actions WHERE action_kind = 'FUNCTION_CALL' GROUP BY 1, 2",
    ),
    "daily_tokens_spent_on_fees": _per_period("tokens_spent_on_fees", "DECIMAL(38,0)", _FEES),
    "daily_transaction_count_by_gas_burnt_ranges": _per_key(
        "CAST(top AS INTEGER) AS top_of_range_in_teragas, v AS transactions_count",
        "SELECT d, (gas // 50000000000000 + 1) * 50 AS top, count(hash) AS v FROM ("
        f"SELECT {_day('included_in_block_timestamp')} AS d, "
        "originated_from_transaction_hash AS hash, CAST(sum(gas_burnt) AS BIGINT) AS gas "
        "FROM fx_receipts JOIN fx_outcomes USING (receipt_id) GROUP BY 1, 2) AS burnt "
        "GROUP BY 1, 2",
    ),
    "daily_transactions_count": _per_period(
        "transactions_count",
        "BIGINT",
        f"SELECT {_day('block_timestamp')} AS d, count(*) AS v FROM fx_transactions GROUP BY 1",
    ),
    "deployed_contracts": f"""{LEDGER}
SELECT code AS contract_code_sha256, account_id AS deployed_to_account_id,
       receipt_id AS deployed_by_receipt_id, deployed_at AS deployed_at_block_timestamp
FROM deployed""",
    "weekly_active_accounts_count": _per_period(
        "active_accounts_count",
        "INTEGER",
        "SELECT d - (d + 3) % 7 AS d, count(DISTINCT signer) AS v FROM ("
        f"SELECT {_day('block_timestamp')} AS d, signer_account_id AS signer "
        "FROM fx_transactions) AS signed GROUP BY 1",
        spine="weeks",
    ),
    "near_ecosystem_entities": _CATALOGUE,
    "ready_days": f"{LEDGER}\nSELECT {DAY} AS collected_for_day FROM days",
    "ready_weeks": f"{LEDGER}\nSELECT {DAY} AS collected_for_week FROM weeks",
    "entity_contract_map": f"{LEDGER}\nSELECT contract_id, entity_id FROM contract_map",
    "daily_deposit_amount_wide": _per_period("deposit_amount", "VARCHAR", _DEPOSITS),
    "daily_tokens_spent_on_fees_wide": _per_period("tokens_spent_on_fees", "VARCHAR", _FEES),
    # Every event writes its user's first time into one table, signups first; a batch repeats
    # keys, and the second batch also meets stored ones.
    "insert_only_merge": """
WITH writes AS (
  SELECT CAST(user_id AS VARCHAR) AS account_id, epoch_us(ts) * 1000 AS added_at,
         CASE event_type WHEN 'signup' THEN 1 ELSE 2 END AS batch, event_id
  FROM events)
SELECT account_id, added_at, CAST(batch AS INTEGER) AS batch
FROM (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY batch, added_at, event_id) AS n
      FROM writes) AS numbered
WHERE n = 1""",
    "single_day_ingoing": f"""{LEDGER}
SELECT {DAY} AS collected_for_day, account_id,
       count(DISTINCT transaction_hash) AS ingoing_transactions_count
FROM reached WHERE d = {ONE_DAY} GROUP BY d, account_id""",
    "single_day_new_unique_contracts": f"""{LEDGER}
SELECT DATE '1970-01-01' + {ONE_DAY} AS collected_for_day,
       CAST(count(*) AS INTEGER) AS new_unique_contracts_count
FROM (SELECT code FROM deployed WHERE {_day('deployed_at')} = {ONE_DAY}
      EXCEPT SELECT code FROM deployed WHERE {_day('deployed_at')} < {ONE_DAY}) AS unseen""",
    "single_week_active_accounts": f"""{LEDGER}
SELECT DATE '1970-01-01' + {ONE_WEEK} AS collected_for_week,
       CAST(count(DISTINCT signer_account_id) AS INTEGER) AS active_accounts_count
FROM fx_transactions
WHERE {_day('block_timestamp')} BETWEEN {ONE_WEEK} AND {ONE_WEEK} + 6""",
}


def _one_day(name: str) -> str:
    return f"SELECT * FROM ({ORACLES[name]}) WHERE collected_for_day = DATE '1970-01-01' + {ONE_DAY}"


ORACLES |= {
    "single_day_deposit_amount": _one_day("daily_deposit_amount"),
    "single_day_gas_ranges": _one_day("daily_transaction_count_by_gas_burnt_ranges"),
    "single_day_new_accounts": _one_day("daily_new_accounts_count"),
    "single_day_gas_used": _one_day("daily_gas_used"),
    # A roll-up gives what its statistic gives.
    **{
        f"rollup_{name}": ORACLES[name]
        for name in (
            "daily_active_accounts_count",
            "daily_active_contracts_count",
            "daily_new_contracts_count",
            "daily_transactions_count",
            "weekly_active_accounts_count",
        )
    },
}

# The same results from a day's ids in shares, and from tables landed in buckets.
ORACLES |= {
    "single_day_deposit_amount_in_shares": ORACLES["single_day_deposit_amount"],
    "single_day_new_accounts_in_shares": ORACLES["single_day_new_accounts"],
    "single_day_gas_ranges_in_shares": ORACLES["single_day_gas_ranges"],
    "landed_deposit_amount": ORACLES["daily_deposit_amount"],
    "landed_deleted_accounts": ORACLES["daily_deleted_accounts_count"],
    "landed_ready_days": ORACLES["ready_days"],
    "landed_gas_used": ORACLES["daily_gas_used"],
    "landed_single_day_gas_ranges": ORACLES["single_day_gas_ranges"],
    # Two statistics of one join: days on which it has rows.
    "shared_gas_and_fees": f"""SELECT * FROM ({ORACLES["daily_gas_used"]})
JOIN ({ORACLES["daily_tokens_spent_on_fees"]}) USING (collected_for_day)""",
    "shared_new_and_deleted_accounts": f"""SELECT * FROM ({ORACLES["daily_new_accounts_count"]})
JOIN ({ORACLES["daily_deleted_accounts_count"]}) USING (collected_for_day)""",
    "stored_deposit_amount_wide": ORACLES["daily_deposit_amount_wide"],
    "stored_tokens_spent_on_fees_wide": ORACLES["daily_tokens_spent_on_fees_wide"],
    "weekly_active_accounts_from_days": ORACLES["weekly_active_accounts_count"],
    "daily_active_contracts_from_sets": ORACLES["daily_active_contracts_count"],
    "stored_accounts_added": ORACLES["daily_accounts_added_per_ecosystem_entity"],
    "two_writers_first_write": ORACLES["insert_only_merge"],
}
