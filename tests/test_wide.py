"""Sums past 38 digits: stored, read, compared and added."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerstats.functions.wide import WIDE, from_digits, plus, summed, to_digits
from ledgerstats.logged import LoggedStore
from ledgerstats.run import StatisticsFailed, run
from ledgerstats.schemas import DERIVED_TABLES
from ledgerstats.store import Store
from tests.ledgers import MONDAY, LiteralLedger, at, rows

DEPOSITS, FEES = "daily_deposit_amount_wide", "daily_tokens_spent_on_fees_wide"
LIMIT = 10**50


@pytest.fixture(scope="module")
def numbers():
    draw = random.Random(9)
    found = [0, 1, 10**38 - 1, 10**38, 10**38 + 1, 10**45, LIMIT - 1]
    return found + [draw.randrange(10 ** draw.randint(1, 50)) for _ in range(60)]


def table(spark, numbers):
    text = spark.createDataFrame([(str(x),) for x in numbers], "d string")
    return text.select(from_digits(F.col("d")).alias("x"), "d")


def test_numbers_are_kept_in_order(spark, numbers):
    df = table(spark, numbers)
    assert df.schema["x"].dataType == WIDE
    found = df.orderBy("x").select(to_digits(F.col("x")).alias("t")).collect()
    assert [int(r.t) for r in found] == sorted(numbers)
    least, most = df.agg(F.min("x").alias("a"), F.max("x").alias("b")).select(
        to_digits(F.col("a")), to_digits(F.col("b"))
    ).first()
    assert (int(least), int(most)) == (min(numbers), max(numbers))
    pairs = df.alias("l").join(df.alias("r"), F.col("l.x") < F.col("r.x")).count()
    assert pairs == sum(a < b for a in numbers for b in numbers)


def test_numbers_are_added(spark, numbers):
    halves = [x // 2 for x in numbers]
    pairs = [(str(a), str(b)) for a, b in zip(halves, reversed(halves))]
    df = spark.createDataFrame(pairs, "a string, b string")
    total = to_digits(plus(from_digits(F.col("a")), from_digits(F.col("b"))))
    for row in df.select("a", "b", total.alias("t")).collect():
        assert int(row.t) == int(row.a) + int(row.b)
    over = spark.createDataFrame([(str(LIMIT - 1), "1")], "a string, b string")
    with pytest.raises(Exception, match="more than fifty digits"):
        over.select(plus(from_digits(F.col("a")), from_digits(F.col("b")))).collect()


def test_columns_are_summed(spark, numbers):
    small = [x // 100 for x in numbers]
    df = table(spark, small).withColumn("k", F.length("d") % 2)
    sums = summed(df, ["k"], "x").select("k", to_digits(F.col("x")).alias("t")).collect()
    assert len(sums) == 2
    for k, total in sums:
        assert int(total) == sum(x for x in small if len(str(x)) % 2 == k)


@pytest.mark.parametrize("text", ["", "-1", "1.5", "x", "1" * 51])
def test_what_is_no_such_number_raises(spark, text):
    df = spark.createDataFrame([(text,)], "d string")
    with pytest.raises(Exception, match="not a whole number of 50 digits"):
        df.select(from_digits(F.col("d"))).collect()
    assert spark.range(1).select(from_digits(F.lit(None).cast("string"))).first()[0] is None


def wide_ledger(spark):
    """One day with deposits of 45 digits together, and fees of as many."""
    deposit = 10**37 * 5
    actions = [
        (f"r{i}", "TRANSFER", f'{{"deposit":"{deposit}"}}', "x", "p", at()) for i in range(20)
    ]
    actions.append(("big", "TRANSFER", '{"deposit":"' + "9" * 45 + '"}', "x", "p", at()))
    outcomes = [(a[0], at(), Decimal(1), "SUCCESS_VALUE") for a in actions]
    return LiteralLedger(
        spark,
        days=2,
        action_receipt_actions=actions,
        execution_outcomes=outcomes,
        blocks=[("a", at(), Decimal(10**30)), ("b", at(2, 600), Decimal(1))],
        chunks=[("a", Decimal(10**15)), ("a", Decimal(7))],
    )


@pytest.mark.parametrize("kind", [Store, LoggedStore])
def test_sums_of_45_digits_are_stored_and_read(spark, tmp_path, kind):
    expected = {
        DEPOSITS: 20 * 10**37 * 5 + (10**45 - 1),
        FEES: (10**15 + 7) * 10**30,
    }
    ledger, store = wide_ledger(spark), kind(spark, str(tmp_path))
    with pytest.raises(StatisticsFailed):
        run(ledger, store, ["daily_deposit_amount", "daily_tokens_spent_on_fees"], rebuild=True)
    run(ledger, store, [DEPOSITS, FEES], timestamp=MONDAY * 86_400)
    run(ledger, store, [DEPOSITS, FEES], timestamp=(MONDAY + 1) * 86_400)
    run(ledger, store, [DEPOSITS, FEES], timestamp=MONDAY * 86_400)
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    for name, value in expected.items():
        column = DERIVED_TABLES[name].columns[-1]
        found = rows(store.read(name).withColumn(column, to_digits(F.col(column))))
        assert found == [(days[0], str(value)), (days[1], "0")]
        most = store.read(name).orderBy(F.col(column).desc()).first()[0]
        assert most == days[0]
    run(ledger, store, [DEPOSITS, FEES], rebuild=True)
    assert store.read(FEES).count() == 2
