"""Exact sums of non-negative integers that may pass the 38 digits of a decimal.

A number is cut into limbs of twelve digits, lowest first. Each limb is summed on
its own with the built-in `sum`, so partial aggregation stays; the carries are
resolved once per result row and give the digits as text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMB_DIGITS = 12

_SUMMAND = "decimal(28,0)"
_TOTAL = "decimal(38,0)"
_LEADING_ZEROS = "^0+(?=[0-9])"


def limbs_of(digits: Column, count: int) -> list[Column]:
    """Limbs of a column of decimal digits; other text, or too long a number, raises."""
    width = count * LIMB_DIGITS
    number = F.regexp_replace(F.trim(digits), _LEADING_ZEROS, "")
    checked = F.when(
        number.isNull() | number.rlike(f"^[0-9]{{1,{width}}}$"), number
    ).otherwise(F.raise_error(F.concat(F.lit("not a whole number in range: "), digits)))
    padded = F.lpad(checked, width, "0")
    return [
        F.substring(padded, width - LIMB_DIGITS * (i + 1) + 1, LIMB_DIGITS).cast("decimal(12,0)")
        for i in range(count)
    ]


def product_limbs(left: list[Column], right: list[Column]) -> list[Column]:
    """Limbs of a product, carries not resolved."""
    return [
        reduce(
            Column.__add__,
            [left[i] * right[k - i] for i in range(len(left)) if 0 <= k - i < len(right)],
        )
        for k in range(len(left) + len(right) - 1)
    ]


def sum_limbs(limbs: list[Column]) -> list[Column]:
    """One aggregate per limb, named for `with_digits`; room for 10**12 rows."""
    return [F.sum(limb.cast(_SUMMAND)).alias(f"_limb{i}") for i, limb in enumerate(limbs)]


def with_digits(sums: DataFrame, count: int, name: str) -> DataFrame:
    """Replace the `count` columns of `sum_limbs` by one text column of digits."""
    base = F.lit(10**LIMB_DIGITS).cast("decimal(13,0)")
    df = sums
    for i in range(count):
        total = F.col(f"_limb{i}").cast(_TOTAL)
        if i:
            total = (total + F.col("_carry")).cast(_TOTAL)
        df = df.withColumn("_total", total)
        df = df.withColumn(f"_limb{i}", (F.col("_total") % base).cast(_TOTAL))
        df = df.withColumn("_carry", ((F.col("_total") - F.col(f"_limb{i}")) / base).cast(_TOTAL))
    written = [F.lpad(F.col(f"_limb{i}").cast("string"), LIMB_DIGITS, "0") for i in range(count)]
    digits = F.concat(F.col("_carry").cast("string"), *reversed(written))
    return df.withColumn(name, F.regexp_replace(digits, _LEADING_ZEROS, "")).drop(
        "_total", "_carry", *[f"_limb{i}" for i in range(count)]
    )
