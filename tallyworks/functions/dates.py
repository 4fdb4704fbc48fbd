"""Calendar expressions. None of them reads the clock: the date is always an input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Season of each calendar month.
SEASONS = {
    "Winter": (12, 1, 2),
    "Spring": (3, 4, 5),
    "Summer": (6, 7, 8),
    "Fall": (9, 10, 11),
}


def season(date: Column) -> Column:
    month = F.month(date)
    branches = iter(SEASONS.items())
    name, months = next(branches)
    out = F.when(month.isin(*months), name)
    for name, months in branches:
        out = out.when(month.isin(*months), name)
    return out


def half_of_year(date: Column) -> Column:
    return F.when(F.month(date) <= 6, 1).otherwise(2)


def fiscal_period(date: Column, first_day: int = 21) -> Column:
    """Struct (label, first, last) of the month that runs from ``first_day`` to the day before
    it in the next month. The label is the calendar month in which the period ends."""
    begins_here = F.dayofmonth(date) >= first_day
    opening_month = F.when(begins_here, F.trunc(date, "month")).otherwise(
        F.add_months(F.trunc(date, "month"), -1)
    )
    closing_month = F.add_months(opening_month, 1)
    return F.struct(
        F.date_format(closing_month, "yyyy-MM").alias("label"),
        F.date_add(opening_month, first_day - 1).alias("first"),
        F.date_add(closing_month, first_day - 2).alias("last"),
    )


def weekday_gap(start: Column, end: Column, floor_zero: bool = False) -> Column:
    """Days from ``start`` to ``end`` without the weekend days between them. Weeks are counted
    by their Mondays, so the gap is right across New Year. One more day is taken off when the
    end is a Saturday, or else when the start is a Sunday."""
    weeks = F.floor(
        F.datediff(F.to_date(F.date_trunc("week", end)), F.to_date(F.date_trunc("week", start)))
        / 7
    )
    correction = (
        F.when(F.dayofweek(end) == 7, 1).when(F.dayofweek(start) == 1, 1).otherwise(0)
    )
    gap = (F.datediff(end, start) - weeks * 2 - correction).cast("int")
    return F.greatest(gap, F.lit(0)) if floor_zero else gap


def assemble_timestamp(date: Column, loose_time: Column) -> Column:
    """Date plus a time written as ``8H30``, ``8h30`` or ``8:30``. A missing or unreadable time
    counts as midnight."""
    clock = F.regexp_replace(F.trim(loose_time), "[Hh]", ":")
    clock = F.when(F.endswith(clock, F.lit(":")), F.concat(clock, F.lit("00"))).otherwise(clock)
    day = F.date_format(date, "yyyy-MM-dd")
    text = F.concat(day, F.lit(" "), clock)
    return F.coalesce(
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd H:m:s")).cast("timestamp_ntz"),
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd H:m")).cast("timestamp_ntz"),
        date.cast("timestamp_ntz"),
    )
