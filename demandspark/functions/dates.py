"""Calendar columns of a date, as native expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# US public holidays, numbered in alphabetical order; 0 means none (fixed values).
HOLIDAY_NAMES = (
    "Christmas Day", "Christmas Day (observed)", "Columbus Day", "Independence Day",
    "Independence Day (observed)", "Juneteenth National Independence Day",
    "Juneteenth National Independence Day (observed)", "Labor Day", "Martin Luther King Jr. Day",
    "Memorial Day", "New Year's Day", "New Year's Day (observed)", "Thanksgiving Day",
    "Veterans Day", "Veterans Day (observed)", "Washington's Birthday",
)
# (name, month, day, first year)
FIXED_HOLIDAYS = (
    ("New Year's Day", 1, 1, 1),
    ("Juneteenth National Independence Day", 6, 19, 2021),
    ("Independence Day", 7, 4, 1),
    ("Veterans Day", 11, 11, 1),
    ("Christmas Day", 12, 25, 1),
)
# (name, month, weekday with Monday = 0, first and last possible day of the month)
FLOATING_HOLIDAYS = (
    ("Martin Luther King Jr. Day", 1, 0, 15, 21),
    ("Washington's Birthday", 2, 0, 15, 21),
    ("Memorial Day", 5, 0, 25, 31),
    ("Labor Day", 9, 0, 1, 7),
    ("Columbus Day", 10, 0, 8, 14),
    ("Thanksgiving Day", 11, 3, 22, 28),
)


def calendar_columns(ds: Column) -> dict[str, Column]:
    """Day of week (Monday = 0), month, day, day of year, ISO week, weekend flag."""
    return {
        "dayofweek": F.weekday(ds),
        "month": F.month(ds),
        "day": F.dayofmonth(ds),
        "dayofyear": F.dayofyear(ds),
        "weekofyear": F.weekofyear(ds),
        "is_weekend": (F.weekday(ds) >= 5).cast("int"),
    }


def _is_fixed(ds: Column, month: int, day: int, since: int) -> Column:
    return (F.month(ds) == month) & (F.dayofmonth(ds) == day) & (F.year(ds) >= since)


def holiday_code(ds: Column) -> Column:
    """Number of the US public holiday on a date, 0 if none.

    A rule per holiday instead of a joined calendar table: no join, and no range of years to
    keep. Fixed dates on a Saturday are also observed the Friday before, on a Sunday the
    Monday after.
    """
    number = {name: i + 1 for i, name in enumerate(HOLIDAY_NAMES)}
    rules = [(_is_fixed(ds, m, d, y), number[n]) for n, m, d, y in FIXED_HOLIDAYS]
    rules += [((F.month(ds) == m) & (F.weekday(ds) == wd) & F.dayofmonth(ds).between(lo, hi), number[n])
              for n, m, wd, lo, hi in FLOATING_HOLIDAYS]
    for name, month, day, since in FIXED_HOLIDAYS:
        friday_before = (F.weekday(ds) == 4) & _is_fixed(F.date_add(ds, 1), month, day, since)
        monday_after = (F.weekday(ds) == 0) & _is_fixed(F.date_sub(ds, 1), month, day, since)
        rules.append((friday_before | monday_after, number[f"{name} (observed)"]))
    first, *rest = rules
    chain = reduce(lambda acc, rule: acc.when(rule[0], F.lit(rule[1])), rest, F.when(first[0], F.lit(first[1])))
    return chain.otherwise(F.lit(0))
