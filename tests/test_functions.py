"""Calendar arithmetic and wide sums against plain Python, on generated values."""

from __future__ import annotations

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerstats.functions.calendar import DAY_NS, as_date, period_of, period_start
from ledgerstats.functions.contracts import category_flags, identifier
from ledgerstats.functions.widesum import limbs_of, product_limbs, sum_limbs, with_digits

EPOCH = dt.date(1970, 1, 1)
SPARK = settings(max_examples=5, deadline=None)
WIDE = st.integers(0, 10**45 - 1)


@given(st.integers(0, 60_000))
def test_weeks_start_on_monday(day):
    first = period_start(day, "week")
    assert first <= day < first + 7
    assert (EPOCH + dt.timedelta(first)).weekday() == 0
    assert period_start(day, "day") == day


@SPARK
@given(st.lists(st.integers(0, 80_000 * DAY_NS), min_size=20, max_size=60))
def test_columns_agree_with_the_driver(spark, times):
    df = spark.createDataFrame([(t,) for t in times], "t bigint").select(
        "t", period_of("t").alias("day"), period_of("t", "week").alias("week")
    )
    for t, day, week, date in df.select("*", as_date("week")).collect():
        assert day == t // DAY_NS
        assert week == period_start(t // DAY_NS, "week")
        assert date == EPOCH + dt.timedelta(week)


@SPARK
@given(st.lists(st.tuples(st.integers(0, 5), WIDE), min_size=30, max_size=120))
def test_wide_sums(spark, rows):
    df = spark.createDataFrame([(g, str(v)) for g, v in rows], "g int, v string")
    sums = df.groupBy("g").agg(*sum_limbs(limbs_of(F.col("v"), 5)))
    found = {r.g: r.total for r in with_digits(sums, 5, "total").collect()}
    assert found == {g: str(sum(v for h, v in rows if h == g)) for g in {g for g, _ in rows}}


@SPARK
@given(st.lists(st.tuples(st.integers(0, 10**30), st.integers(0, 10**38)), min_size=30))
def test_wide_sums_of_products(spark, rows):
    df = spark.createDataFrame([(str(a), str(b)) for a, b in rows], "a string, b string")
    limbs = product_limbs(limbs_of(F.col("a"), 4), limbs_of(F.col("b"), 4))
    (found,) = with_digits(df.agg(*sum_limbs(limbs)), len(limbs), "total").collect()
    assert found.total == str(sum(a * b for a, b in rows))


def test_text_of_numbers(spark):
    df = spark.createDataFrame([("007",), (" 5 ",), (None,)], "v string")
    (found,) = with_digits(df.agg(*sum_limbs(limbs_of(F.col("v"), 2))), 2, "total").collect()
    assert found.total == "12"


def test_identifiers_and_flags(spark):
    df = spark.createDataFrame([(" 'a'b' ", "defi dapp")], "i string, c string")
    (row,) = df.select(identifier(F.col("i")).alias("i"), *category_flags(F.col("c"))).collect()
    assert row.i == "ab"
    assert (row.is_app, row.is_nft, row.is_defi) == (True, False, True)
