"""Month columns; a month is the DATE of its first day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_diff(a: Column, b: Column) -> Column:
    """Whole calendar months from b to a; null if either is."""
    return (F.year(a) - F.year(b)) * 12 + F.month(a) - F.month(b)


def month_start(c: Column) -> Column:
    return F.trunc(c, "MM")


def to_date(c: Column) -> Column:
    """A date from text or time, null where it is none."""
    return F.try_to_timestamp(c.cast("string")).cast("date")


def to_number(c: Column) -> Column:
    """A finite or infinite double, null where the text is none or NaN."""
    number = c.try_cast("double")
    return F.when(~F.isnan(number), number)


def weekdays(month: Column) -> Column:
    """Mondays to Fridays of the month."""
    return F.size(F.filter(F.sequence(month, F.last_day(month)), lambda d: F.weekday(d) < 5))


def cyclic(value: Column, period: int) -> tuple[Column, Column]:
    angle = F.lit(2.0) * F.pi() * (value - 1) / period
    return F.sin(angle), F.cos(angle)


def calendar_parts(month: Column) -> dict[str, Column]:
    return {"month_num": F.month(month), "quarter": F.quarter(month), "year": F.year(month), "days_in_month": F.dayofmonth(F.last_day(month))}


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is zero."""
    return a / F.nullif(b.cast("double"), F.lit(0.0))
