"""Calendar arithmetic on whole epoch days.

Dates travel through the engine as integer days, so that window ranges,
offsets and comparisons stay plain integer expressions.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000
# More days than lie between any two dates.
BEYOND_CALENDAR = 10_000_000


def day_of(date: Column | str) -> Column:
    """Epoch day of a date or timestamp column."""
    column = F.col(date) if isinstance(date, str) else date
    return F.unix_date(column.cast("date"))


def date_of(day: Column | str) -> Column:
    """Date of an epoch-day column."""
    return F.date_from_unix_date(day)


def gestation_start_micros(day: Column, gest_days: Column) -> Column:
    """First day of a pregnancy that is ``gest_days`` old on ``day``, in microseconds.

    Gestation may be fractional (weeks such as 10 1/7 times 7), so it is
    rounded to the microsecond before it is taken off the date. What is longer
    than the calendar, in either direction, is cut to more than the calendar.
    """
    most = F.lit(BEYOND_CALENDAR).cast("decimal(24,12)")
    gest_days = F.when(gest_days.isNotNull(), F.greatest(F.least(gest_days, most), -most)).cast("decimal(24,12)")
    gest_micros = F.round(gest_days * F.lit(MICROS_PER_DAY).cast("decimal(12,0)"), 0).cast("long")
    return (day + 1) * F.lit(MICROS_PER_DAY) - gest_micros


def floor_day(micros: Column) -> Column:
    return F.floor(_days(micros)).cast("int")


def ceil_day(micros: Column) -> Column:
    return F.ceil(_days(micros)).cast("int")


def _days(micros: Column) -> Column:
    exact = F.lit(MICROS_PER_DAY).cast("decimal(12,0)")
    return micros.cast("decimal(20,0)") / exact


def lookup(key: str, values: Mapping[str, int]) -> Column:
    """Value of a small fixed mapping for the column ``key``; NULL when absent."""
    cases = " ".join(f"WHEN '{name}' THEN {int(value)}" for name, value in values.items())
    return F.expr(f"CASE {key} {cases} END")
