"""Distinct counts from stored sets: days, weeks, several writers."""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from ledgerstats.distinct import NUMBERS, SETS, DistinctSets, days_of
from ledgerstats.operators.periods import Period, all_periods
from ledgerstats.plans.registry import compute
from ledgerstats.sources import EventLedger
from tests.ledgers import MONDAY, rows
from tests.test_scale import plan

SMALL = "/root/testdata/sf0.01"


def ids_of(ledger, period):
    rows_ = ledger.between("transactions", period.from_ns, period.to_ns)
    return rows_.select(period.of("block_timestamp"), F.col("signer_account_id").alias("id"))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The signers of each day, added in pieces of a week or so, one of them twice."""
    ledger = EventLedger(spark, SMALL)
    days = all_periods(ledger.extent(), "day")
    sets = DistinctSets.at(spark, str(tmp_path_factory.mktemp("sets")), fanout=2)
    for first in [*range(days.first, days.stop, 8), days.first + 8]:
        part = Period("day", first, min(first + 8, days.stop))
        sets.add(ids_of(ledger, part), part)
    return ledger, sets


@pytest.mark.parametrize("unit", ["day", "week"])
def test_counts_of_stored_sets_are_the_direct_ones(stored, unit):
    ledger, sets = stored
    name = {"day": "daily_active_accounts_count", "week": "weekly_active_accounts_count"}[unit]
    period = all_periods(ledger.extent(), unit)
    found, expected = sets.counts(period, "active_accounts_count"), compute(ledger, name)
    assert found.dtypes == expected.dtypes and rows(found) == rows(expected)
    assert "events.parquet" not in plan(found)


def test_any_range_of_days_is_a_union(stored):
    ledger, sets = stored
    weeks = Period("week", MONDAY + 7, MONDAY + 21)
    assert rows(sets.counts(weeks, "n")) == [
        (dt.date(2024, 1, 8 + 7 * i), ids_of(ledger, days_of(Period("week", w, w + 7)))
         .select("id").distinct().count())
        for i, w in enumerate((MONDAY + 7, MONDAY + 14))
    ]


def test_numbers_are_dense_and_stay(stored):
    _, sets = stored
    numbers = sorted(r.number for r in sets.store.read(NUMBERS).collect())
    assert numbers == list(range(1, len(numbers) + 1))
    assert sets.store.read(SETS).select("day", "bucket").distinct().count() == (
        sets.store.read(SETS).count()
    )
    assert sets.number(sets.store.read(NUMBERS).select("id")).rows == 0


def frame(spark, numbers, day=MONDAY):
    return spark.createDataFrame([(day, f"a{i}") for i in numbers], "period long, id string")


def test_two_writers_give_no_number_twice(spark, tmp_path):
    root, second = str(tmp_path), DistinctSets.at(spark, str(tmp_path))
    todo = ["written"]

    def interfere(step):
        if todo and step == todo[0]:
            todo.clear()
            second.number(frame(spark, range(40, 70)).select("id"))

    first = DistinctSets.at(spark, root, before_commit=interfere)
    done = first.number(frame(spark, range(50)).select("id"))
    assert (done.rows, done.retries) == (40, 1)
    numbers = {r.id: r.number for r in first.store.read(NUMBERS).collect()}
    assert sorted(numbers.values()) == list(range(1, 71))
    # Who commits first has the lowest numbers.
    assert {numbers[f"a{i}"] for i in range(40, 70)} == set(range(1, 31))

    def write(i):
        sets = DistinctSets.at(spark, root, fanout=3)
        day = Period("day", MONDAY + i, MONDAY + i + 1)
        sets.add(frame(spark, range(i * 25, i * 25 + 60), day.first), day)

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(write, range(3)))
    numbers = [r.number for r in first.store.read(NUMBERS).collect()]
    assert sorted(numbers) == list(range(1, 111))
    week = Period("week", MONDAY, MONDAY + 7)
    assert [r[1] for r in rows(first.counts(week, "n"))] == [110]
    days = Period("day", MONDAY, MONDAY + 4)
    assert [r[1] for r in rows(first.counts(days, "n"))] == [60, 60, 60, 0]


def test_sets_span_buckets_and_skip_nulls(spark, tmp_path):
    sets = DistinctSets.at(spark, str(tmp_path))
    ids = spark.range(100_000).select(
        F.lit(MONDAY).cast("long").alias("period"),
        F.when(F.col("id") % 10 > 0, F.concat(F.lit("account"), F.col("id") % 70_000)).alias("id"),
    )
    day = Period("day", MONDAY, MONDAY + 1)
    sets.add(ids, day)
    assert sets.store.read(SETS).count() == 2
    assert [r[1] for r in rows(sets.counts(day, "n"))] == [63_000]
    sets.add(frame(spark, [], MONDAY + 1), Period("day", MONDAY + 1, MONDAY + 2))
    assert [r[1] for r in rows(sets.counts(Period("day", MONDAY, MONDAY + 2), "n"))] == [63_000, 0]
