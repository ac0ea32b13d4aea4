"""One period's keys filter a large table in shares, however many keys there are."""

from __future__ import annotations

import pytest

from ledgerstats.operators.shares import joined_by_share, shares_for
from ledgerstats.plans.registry import compute
from ledgerstats.session import SETTINGS
from ledgerstats.sources import EventLedger
from tests.ledgers import MONDAY
from tests.test_scale import NO_BROADCAST, settings

SMALL = "/root/testdata/sf0.01"
BLOOM = "spark.sql.optimizer.runtime.bloomFilter."
AT_ONCE = {f"{BLOOM}applicationSideScanSizeThreshold": "0"}
#: A filter of at most so many keys, with eight bits for each.
KEYS = 64
SMALL_FILTER = {
    f"{BLOOM}{name}": str(value)
    for name, value in {
        "maxNumItems": KEYS, "expectedNumItems": KEYS, "numBits": 8 * KEYS, "maxNumBits": 8 * KEYS,
    }.items()
}
TIMESTAMP = (MONDAY + 3) * 86_400


def nodes(plan):
    yield plan
    for i in range(plan.children().size()):
        yield from nodes(plan.children().apply(i))


def passed(df) -> tuple[int, int]:
    """Filters by a Bloom filter in the plan, and the rows that pass them when it runs."""
    df.collect()
    found = [
        node.metrics().apply("numOutputRows").value()
        for node in nodes(df._jdf.queryExecution().executedPlan())
        if node.nodeName() == "Filter" and "might_contain" in node.toString().split("\n")[0]
    ]
    return len(found), sum(found)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """One day's ids and a table of all time, whose other days' ids are forty times as many."""
    root = str(tmp_path_factory.mktemp("shares"))
    ids = spark.range(40_000).selectExpr("concat('receipt-', id) AS receipt_id", "id % 41 AS day")
    ids.write.parquet(f"{root}/day")
    ids.selectExpr("receipt_id", "day AS other").write.parquet(f"{root}/whole")
    return spark.read.parquet(f"{root}/day").filter("day = 3"), spark.read.parquet(f"{root}/whole")


def joined(spark, tables, shares, **conf):
    with settings(spark, **NO_BROADCAST, **AT_ONCE, **conf,
                  **{"spark.sql.adaptive.enabled": "false"}):
        day, whole = tables
        df = joined_by_share(day, whole.groupBy("receipt_id").count(), "receipt_id", shares)
        return (*passed(df), df.count())


def test_more_keys_than_a_filter_holds_drop_the_same_share_of_rows(spark, tables):
    day = tables[0].count()
    filters, by_large, n = joined(spark, tables, 1)
    assert filters == 1 and n == day and by_large < 1.1 * day
    # One small filter is saturated and lets nearly all rows by.
    _, by_one, n = joined(spark, tables, 1, **SMALL_FILTER)
    assert n == day and by_one > 0.9 * 40_000
    with settings(spark, **SMALL_FILTER):
        shares = shares_for(tables[0])
    assert shares == -(-day // KEYS)
    filters, by_shares, n = joined(spark, tables, shares, **SMALL_FILTER)
    assert filters == shares and n == day
    assert by_shares < 1.2 * day + 0.05 * 40_000


@pytest.mark.parametrize(
    "name",
    [
        "daily_deposit_amount",
        "daily_new_accounts_count",
        "daily_deleted_accounts_count",
        "daily_gas_used",
        "daily_tokens_spent_on_fees",
        "daily_transaction_count_by_gas_burnt_ranges",
    ],
)
def test_shares_do_not_change_results(spark, name):
    ledger = EventLedger(spark, SMALL)
    expected = compute(ledger, name, TIMESTAMP).collect()
    # A share has one twentieth of the keys or fewer, and blocks are 24 a day.
    small = 4 if "gas_used" in name or "fees" in name else 20
    with settings(spark, **{f"{BLOOM}maxNumItems": str(small)}):
        df = compute(ledger, name, TIMESTAMP)
        assert df._jdf.queryExecution().optimizedPlan().toString().count("Union") == 1
        assert sorted(df.collect()) == sorted(expected)


def test_all_periods_and_small_days_are_joined_whole(spark):
    ledger = EventLedger(spark, SMALL)
    for timestamp, limit in ((None, "20"), (TIMESTAMP, SETTINGS[f"{BLOOM}maxNumItems"])):
        with settings(spark, **{f"{BLOOM}maxNumItems": limit}):
            plan = compute(ledger, "daily_new_accounts_count", timestamp)._jdf.queryExecution()
            assert "Union" not in plan.optimizedPlan().toString()


def test_a_filter_is_built_however_large_the_day_is_estimated(spark, tables):
    creation = f"{BLOOM}creationSideThreshold"
    most = "spark.sql.optimizer.runtimeFilter.number.threshold"
    small = {**SMALL_FILTER, creation: "1KB", most: "2"}
    filters, _, n = joined(spark, tables, 16, **small)
    assert filters == 16 and n == tables[0].count()
