"""Calendar arithmetic: nanosecond columns and epoch seconds to UTC day numbers and back.

A period is named by the day number (days since 1970-01-01) of its first day.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND_NS = 1_000_000_000
DAY_SECONDS = 86_400
DAY_NS = DAY_SECONDS * SECOND_NS

PERIOD_DAYS = {"day": 1, "week": 7}


def period_start(day_number: int, unit: str) -> int:
    """First day number of the day or Monday-based week that holds `day_number`."""
    if unit == "week":
        return day_number - (day_number + 3) % 7  # day 0 was a Thursday
    return day_number


def period_of(time_ns: str, unit: str = "day") -> Column:
    """The period of a nanosecond column, as a day number."""
    day = f"({time_ns} div {DAY_NS})"
    if unit == "week":
        return F.expr(f"{day} - pmod({day} + 3, 7)")
    return F.expr(day)


def as_date(day_number: Column | str) -> Column:
    return F.date_from_unix_date(F.col(day_number).cast("int"))
