"""Random small ledgers: every statistic against loops over plain Python rows."""

from __future__ import annotations

import datetime as dt
import json
import random
from collections import Counter, defaultdict
from decimal import Decimal

import pytest

from ledgerstats.functions.calendar import DAY_NS
from ledgerstats.operators.periods import GRACE_NS
from ledgerstats.plans.registry import STATISTICS, compute
from tests.ledgers import MONDAY, LiteralLedger, at, rows

DAYS = 9  # complete days; the first Monday's week is complete, the second is not
KINDS = ["FUNCTION_CALL", "TRANSFER", "ADD_KEY", "DEPLOY_CONTRACT", "STAKE"]
STATUSES = ["SUCCESS_VALUE", "SUCCESS_RECEIPT_ID", "FAILURE", "UNKNOWN"]
ENTITIES = [
    {"slug": "near", "contract": "c0, c1", "category": "app"},
    {"slug": "a1", "contract": "c1, 'c2'", "category": "dao"},
    {"slug": "zoo", "contract": "c2, c3,c4", "category": "nft guild"},
    {"slug": "none", "contract": "", "category": None},
    {"slug": "zoo", "contract": "c9", "category": "app"},
]
OWNERS = {"c0": "near", "c1": "a1", "c2": "a1", "c3,c4": "zoo"}


def random_ledger(seed: int) -> dict[str, list[tuple]]:
    rng = random.Random(seed)
    account = lambda: f"a{rng.randrange(6)}"
    when = lambda: at() + rng.randrange((DAYS + 1) * DAY_NS)

    def args(kind):
        if kind == "ADD_KEY":
            contract = rng.choice([*OWNERS, "c3", "other"])
            permission = {"permission_kind": rng.choice(["FUNCTION_CALL", "FULL_ACCESS"])}
            permission["permission_details"] = {"receiver_id": contract}
            return {"access_key": {"permission": permission}}
        if kind == "DEPLOY_CONTRACT":
            return {"code_sha256": f"h{rng.randrange(12)}"}
        return rng.choice([{}, {"deposit": "0"}, {"deposit": str(rng.randrange(10**26))}])

    ledger = defaultdict(list)
    for i in range(150):
        sent = when()
        if rng.random() < 0.3:  # close to midnight
            sent = (sent // DAY_NS + 1) * DAY_NS - rng.randrange(1, 400 * 10**9)
        ledger["transactions"].append((f"t{i}", account(), sent))
        for j in range(rng.randrange(4)):
            included = sent + rng.choice([0, 1, GRACE_NS // 2, GRACE_NS, 3 * GRACE_NS])
            origin = f"t{i}" if rng.random() < 0.95 else None
            receipt, receiver = f"r{i}-{j}", account()
            ledger["receipts"].append((receipt, receiver, origin, included))
            for _ in range(rng.randrange(4)):
                kind = rng.choice(KINDS)
                caller = rng.choice(["system", account()])
                ledger["action_receipt_actions"].append(
                    (receipt, kind, json.dumps(args(kind)), receiver, caller, included)
                )
            if rng.random() < 0.9:
                executed = included + rng.choice([0, 10**9, DAY_NS, 3 * DAY_NS])
                gas = Decimal(rng.randrange(120) * 10**12)
                ledger["execution_outcomes"].append(
                    (receipt, executed, gas, rng.choice(STATUSES))
                )
    ids = [r[0] for r in ledger["receipts"]] + [None, "unknown"]
    ledger["accounts"] = [(rng.choice(ids), rng.choice(ids)) for _ in range(80)]
    times = [at(), at(DAYS) + GRACE_NS]
    times += [at() + rng.randrange(DAYS * DAY_NS) for _ in range(20)]
    ledger["blocks"] = [(f"b{i}", t, Decimal(rng.randrange(10**9))) for i, t in enumerate(times)]
    ledger["chunks"] = [
        (f"b{rng.randrange(len(times) + 2)}", Decimal(rng.randrange(10**15))) for _ in range(80)
    ]
    return dict(ledger)


def active(ledger, first, stop):
    return len({s for _, s, t in ledger["transactions"] if first <= t < stop})


def one_day(ledger, first: int, stop: int, stored: dict) -> dict[str, list[tuple]]:
    """Results of one day, by the stored rows of the days before where they matter."""
    sent = [(h, s) for h, s, t in ledger["transactions"] if first <= t < stop]
    receipt = {r: (to, t) for r, to, _, t in ledger["receipts"]}
    today = {r for r, (_, t) in receipt.items() if first <= t < stop}
    actions = [a for a in ledger["action_receipt_actions"] if first <= a[5] < stop]
    calls = [a for a in actions if a[1] == "FUNCTION_CALL"]
    price = {b: p for b, t, p in ledger["blocks"] if first <= t < stop}

    reached = {
        (to, h)
        for h, signer in sent
        for _, to, origin, t in ledger["receipts"]
        if origin == h and first <= t < stop + GRACE_NS and to != signer
    }
    succeeded = {
        r for r, t, _, status in ledger["execution_outcomes"]
        if first <= t < stop and status.startswith("SUCCESS")
    }
    deposits = [
        int(json.loads(a[2]).get("deposit", "0"))
        for a in ledger["action_receipt_actions"]
        if a[0] in succeeded and a[4] != "system" and a[1] in ("FUNCTION_CALL", "TRANSFER")
    ]
    burnt: Counter = Counter()
    for r, _, gas, _ in ledger["execution_outcomes"]:
        if r in today:
            origin = next(o for q, _, o, _ in ledger["receipts"] if q == r)
            burnt[origin] += int(gas)
    ranges: Counter = Counter()
    for origin, gas in burnt.items():
        ranges[(gas // (50 * 10**12) + 1) * 50] += origin is not None

    for a in sorted(actions, key=lambda a: a[5]):
        if a[1] == "ADD_KEY":
            permission = json.loads(a[2])["access_key"]["permission"]
            owner = OWNERS.get(permission["permission_details"]["receiver_id"])
            if permission["permission_kind"] == "FUNCTION_CALL" and owner not in (
                None, a[3], "near",
            ):
                stored["added"].setdefault((owner, a[3]), a[5])
    codes = defaultdict(set)
    for a in actions:
        if a[1] == "DEPLOY_CONTRACT":
            codes[a[0]].add(json.loads(a[2])["code_sha256"])
    known = {code for code, _, _, _ in stored["deployed"]}
    deployed = [(min(c), receipt[r][0], r, receipt[r][1]) for r, c in codes.items()]
    stored["deployed"] += deployed
    gained = Counter(owner for (owner, _), t in stored["added"].items() if first <= t < stop)

    return {
        "daily_transactions_count": [(len(sent),)],
        "daily_active_accounts_count": [(active(ledger, first, stop),)],
        "daily_active_contracts_count": [(len({a[3] for a in calls}),)],
        "daily_new_accounts_count": [(sum(c in today for c, _ in ledger["accounts"]),)],
        "daily_deleted_accounts_count": [(sum(d in today for _, d in ledger["accounts"]),)],
        "daily_deposit_amount": [(Decimal(sum(deposits)),)],
        "daily_gas_used": [(sum(g for b, g in ledger["chunks"] if b in price),)],
        "daily_tokens_spent_on_fees": [
            (sum(g * price[b] for b, g in ledger["chunks"] if b in price),)
        ],
        "daily_new_contracts_count": [(len({to for _, to, _, _ in deployed}),)],
        "daily_new_unique_contracts_count": [(len({d[0] for d in deployed} - known),)],
        "daily_outgoing_transactions_per_account_count": Counter(s for _, s in sent).items(),
        "daily_ingoing_transactions_per_account_count": Counter(to for to, _ in reached).items(),
        "daily_receipts_per_contract_count": Counter(a[3] for a in calls).items(),
        "daily_transaction_count_by_gas_burnt_ranges": ranges.items(),
        "daily_new_accounts_per_ecosystem_entity_count": gained.items(),
    }


def expected(ledger) -> dict[str, list[tuple]]:
    stored = {"added": {}, "deployed": []}
    results = defaultdict(list)
    for day in range(DAYS):
        date = dt.date(2024, 1, 1) + dt.timedelta(day)
        for name, found in one_day(ledger, at(day), at(day + 1), stored).items():
            results[name] += [(date, *row) for row in found]
    results["weekly_active_accounts_count"] = [
        (dt.date(2024, 1, 1), active(ledger, at(0), at(7)))
    ]
    results["daily_accounts_added_per_ecosystem_entity"] = [
        (*key, t) for key, t in stored["added"].items()
    ]
    results["deployed_contracts"] = stored["deployed"]
    return {name: sorted(found) for name, found in results.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_statistics_equal_loops_over_rows(spark, seed):
    data = random_ledger(seed)
    ledger = LiteralLedger(spark, entities=ENTITIES, **data)
    wanted = expected(data)
    assert wanted.keys() == STATISTICS.keys() - {"near_ecosystem_entities"}
    for name, found in wanted.items():
        assert found, name
        assert rows(compute(ledger, name)) == found, name


@pytest.mark.parametrize("day", [0, 4])
def test_single_days_equal_loops_over_rows(spark, day):
    data = random_ledger(3)
    ledger = LiteralLedger(spark, entities=ENTITIES, **data)
    date = dt.date(2024, 1, 1) + dt.timedelta(day)
    for name, found in expected(data).items():
        if name.startswith("daily") and "added" not in name:
            single = rows(compute(ledger, name, timestamp=(MONDAY + day) * 86_400 + 1))
            assert single == [row for row in found if row[0] == date], name
