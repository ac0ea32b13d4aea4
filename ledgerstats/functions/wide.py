"""Whole numbers of up to fifty digits as a column that is stored, compared and added.

A number is a struct of its first twelve and its last 38 digits. Structs are compared field by
field, so order, minimum, maximum and equality are those of the numbers. Sums go through limbs
(`widesum`), with partial aggregation.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstats.functions.widesum import LIMB_DIGITS, limbs_of, sum_limbs, with_digits

# Fixed value: the digits of a numeric(50,0).
DIGITS = 50
LOW_DIGITS = 38
HIGH, LOW = T.DecimalType(DIGITS - LOW_DIGITS, 0), T.DecimalType(LOW_DIGITS, 0)
WIDE = T.StructType([T.StructField("high", HIGH), T.StructField("low", LOW)])
_LIMBS = -(-DIGITS // LIMB_DIGITS)


def wide(high: Column, low: Column) -> Column:
    return F.struct(high.cast(HIGH).alias("high"), low.cast(LOW).alias("low"))


def zero() -> Column:
    return wide(F.lit(0), F.lit(0))


def from_digits(digits: Column) -> Column:
    """A number from its decimal digits; other text, or more than fifty of them, raises."""
    fits = digits.rlike(f"^[0-9]{{1,{DIGITS}}}$")
    error = F.raise_error(F.concat(F.lit("not a whole number of 50 digits: "), digits))
    padded = F.lpad(F.when(fits, digits).otherwise(error), DIGITS, "0")
    high = F.substring(padded, 1, DIGITS - LOW_DIGITS)
    low = F.substring(padded, DIGITS - LOW_DIGITS + 1, LOW_DIGITS)
    return F.when(digits.isNotNull(), wide(high, low))


def to_digits(number: Column) -> Column:
    """The digits of a number, without leading zeros."""
    low = F.lpad(number["low"].cast("string"), LOW_DIGITS, "0")
    whole = F.concat(number["high"].cast("string"), low)
    return F.regexp_replace(whole, "^0+(?=[0-9])", "")


def plus(a: Column, b: Column) -> Column:
    """The sum of two numbers; one past fifty digits raises."""
    most = F.lit(Decimal(10**LOW_DIGITS - 1))
    room = (most - b["low"]).cast(LOW)  # that the low digits of a may fill
    carries = a["low"] > room
    low = F.when(carries, a["low"] - room - 1).otherwise(a["low"] + F.when(~carries, b["low"]))
    high = a["high"] + b["high"] + F.when(carries, 1).otherwise(0)
    fits = high < F.lit(10 ** (DIGITS - LOW_DIGITS))
    return wide(F.when(fits, high).otherwise(F.raise_error(F.lit("more than fifty digits"))), low)


def summed(rows: DataFrame, by: list[str], number: str) -> DataFrame:
    """The sums of a column of numbers by other columns."""
    sums = rows.groupBy(*by).agg(*sum_limbs(limbs_of(to_digits(F.col(number)), _LIMBS)))
    totals = with_digits(sums, _LIMBS, number)
    return totals.select(*by, from_digits(F.col(number)).alias(number))
