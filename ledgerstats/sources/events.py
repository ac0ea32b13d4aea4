"""The ledger tables as FIXTURES.md derives them from an `events` and a `nation` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstats import files
from ledgerstats.operators.periods import between
from ledgerstats.schemas import TIME_COLUMN
from ledgerstats.sources.base import LedgerSource

_MICRO_NS = 1_000
_HOUR_NS = 3_600_000_000_000

# The stored column has no zone; read as a timestamp it keeps its microseconds since
# the epoch whatever the session's zone is.
_EVENTS = (
    "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, "
    "event_type STRING, value DOUBLE, props STRING"
)

_PREPARED = [
    "event_id",
    "user_id",
    "event_type",
    "unix_micros(ts) * 1000 AS ts_ns",
    "CAST(round(value * 100) AS BIGINT) AS cents",
    "concat('u', user_id) AS account",
]
_K = "CAST(get_json_object(props, '$.k') AS BIGINT)"
# A generated column is computed once per row, however many expressions use it, but
# always; a projected one once per use, and not at all where no result needs it.
_K_PROJECTED, _K_GENERATED = f"{_K} AS k", f"explode(array({_K})) AS k"
_GAS = "cents * 50000000000"
_HOUR = f"CAST(ts_ns div {_HOUR_NS} AS STRING)"

# One action per event, and a second one for every ninth event.
_COPIES = "explode(CASE WHEN event_id % 9 = 0 THEN array(1, 2) ELSE array(1) END) AS copy"
_ACTIONS = [
    "CAST(event_id AS STRING) AS receipt_id",
    """CASE WHEN event_type = 'error' THEN 'DEPLOY_CONTRACT'
            WHEN copy = 2 OR event_type = 'click' THEN 'FUNCTION_CALL'
            WHEN event_type = 'purchase' THEN 'TRANSFER'
            WHEN event_type = 'view' THEN 'ADD_KEY'
            WHEN event_type = 'signup' THEN 'CREATE_ACCOUNT'
            ELSE 'DEPLOY_CONTRACT' END AS action_kind""",
    """CASE WHEN copy = 2 AND event_type = 'error'
              THEN concat('{"code_sha256":"h', (user_id * 100 + k + 7) % 1500, '"}')
            WHEN copy = 2 THEN '{"deposit":"1"}'
            WHEN event_type IN ('click', 'purchase')
              THEN concat('{"deposit":"',
                          CASE WHEN k % 5 = 0 THEN '0'
                               ELSE concat(cents, '0000000000000000000000') END, '"}')
            WHEN event_type = 'view' AND k % 4 = 0
              THEN '{"access_key":{"permission":{"permission_kind":"FULL_ACCESS"}}}'
            WHEN event_type = 'view'
              THEN concat('{"access_key":{"permission":{"permission_kind":"FUNCTION_CALL",',
                          '"permission_details":{"receiver_id":"c', k % 70, '"}}}}')
            WHEN event_type = 'error'
              THEN concat('{"code_sha256":"h', (user_id * 100 + k) % 1500, '"}')
            ELSE '{}' END AS args""",
    "account AS receipt_receiver_account_id",
    """CASE WHEN copy = 1 AND k % 10 = 0 THEN 'system'
            ELSE concat('u', k % 50) END AS receipt_predecessor_account_id""",
    "ts_ns AS receipt_included_in_block_timestamp",
]
_TRANSACTIONS = [
    "CAST(event_id div 4 AS STRING) AS transaction_hash",
    "account AS signer_account_id",
    "ts_ns AS block_timestamp",
]
_RECEIPTS = [
    "CAST(event_id AS STRING) AS receipt_id",
    "account AS receiver_account_id",
    "CAST(event_id div 4 AS STRING) AS originated_from_transaction_hash",
    "ts_ns AS included_in_block_timestamp",
]
_OUTCOMES = [
    "CAST(event_id AS STRING) AS receipt_id",
    "ts_ns + k * 1000000000 AS executed_in_block_timestamp",
    f"CAST({_GAS} AS DECIMAL(20,0)) AS gas_burnt",
    """CASE event_id % 7 WHEN 0 THEN 'FAILURE' WHEN 1 THEN 'UNKNOWN'
                          WHEN 2 THEN 'SUCCESS_RECEIPT_ID' ELSE 'SUCCESS_VALUE' END AS status""",
]
_ACCOUNTS = [
    "CAST(event_id AS STRING) AS created_by_receipt_id",
    "CASE WHEN k % 3 = 0 THEN CAST(event_id + 200 AS STRING) END AS deleted_by_receipt_id",
]
_ENTITIES = [
    """CASE n_nationkey WHEN 0 THEN 'near' WHEN 2 THEN 'u7' WHEN 3 THEN "o'k"
                        ELSE lower(n_name) END AS slug""",
    "n_name AS title",
    "CAST(NULL AS STRING) AS oneliner",
    "CAST(NULL AS STRING) AS website",
    """CASE n_regionkey WHEN 0 THEN 'app nft' WHEN 1 THEN 'defi' WHEN 2 THEN 'dao guild'
                        ELSE 'app' END AS category""",
    "CAST(NULL AS STRING) AS status",
    """CASE WHEN n_nationkey = 2
              THEN 'c2, c27, c50, c51, c53, c54, c55, c57, c58, c59, c61, c62, c63, c65, c66, c67'
            WHEN n_nationkey % 5 = 4 THEN ''
            WHEN n_nationkey % 5 = 3 THEN concat(" 'c", n_nationkey, "'")
            WHEN n_nationkey = 5 THEN 'c5, c1'
            ELSE concat('c', n_nationkey, ', c', n_nationkey + 25) END AS contract""",
    "CAST(NULL AS STRING) AS logo",
    "CAST(n_nationkey AS BIGINT) AS _position",
]


class EventLedger(LedgerSource):
    # Tables whose time is that of the event itself: a period of them is a period of events.
    _EVENT_TIMED = ("blocks", "transactions", "receipts", "action_receipt_actions")

    def __init__(self, spark: SparkSession, directory: str):
        super().__init__(spark)
        self.directory = directory

    def _events(self) -> DataFrame:
        return self.spark.read.schema(_EVENTS).parquet(f"{self.directory}/events.parquet")

    def size_in_bytes(self) -> int:
        return files.size_in_bytes(self.spark, f"{self.directory}/events.parquet")

    def stored(self, name: str) -> DataFrame:
        return self._mapped(name, self._events())

    def between(self, name: str, from_ns: int, to_ns: int) -> DataFrame:
        events = self._events()
        if name in self._EVENT_TIMED:
            step = _HOUR_NS if name == "blocks" else _MICRO_NS  # a block is an hour of events
            first, stop = from_ns // step * step, -(-to_ns // step) * step
            events = events.where(
                f"ts >= timestamp_micros({first // _MICRO_NS}) "
                f"AND ts < timestamp_micros({stop // _MICRO_NS})"
            )
        k = _K_GENERATED if name == "execution_outcomes" else _K_PROJECTED
        return between(self._mapped(name, events, k), TIME_COLUMN[name], from_ns, to_ns)

    def _mapped(self, name: str, events: DataFrame, k: str = _K_PROJECTED) -> DataFrame:
        ev = events.selectExpr(*_PREPARED, k)
        if name == "transactions":
            return ev.where("event_id % 4 = 0").selectExpr(*_TRANSACTIONS)
        if name == "receipts":
            return ev.selectExpr(*_RECEIPTS)
        if name == "action_receipt_actions":
            return ev.selectExpr("*", _COPIES).selectExpr(*_ACTIONS)
        if name == "execution_outcomes":
            return ev.selectExpr(*_OUTCOMES)
        if name == "accounts":
            return ev.where("event_type = 'signup'").selectExpr(*_ACCOUNTS)
        if name == "blocks":
            return ev.groupBy(F.expr(_HOUR).alias("block_hash")).agg(
                F.min("ts_ns").alias("block_timestamp"),
                F.expr("CAST(100000000 + max(k) AS DECIMAL(38,0))").alias("gas_price"),
            )
        if name == "chunks":
            return (
                ev.groupBy(
                    F.expr(_HOUR).alias("included_in_block_hash"), F.expr("user_id % 4")
                )
                .agg(F.expr(f"CAST(sum({_GAS}) AS DECIMAL(20,0))").alias("gas_used"))
                .select("included_in_block_hash", "gas_used")
            )
        raise KeyError(name)

    def entities(self) -> DataFrame:
        nation = self.spark.read.parquet(f"{self.directory}/nation.parquet")
        return nation.selectExpr(*_ENTITIES)
