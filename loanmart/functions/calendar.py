"""Calendar arithmetic as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def year_boundaries_between(end: Column | str, start: Column | str) -> Column:
    """Number of year boundaries crossed from start to end (not completed birthdays)."""
    return (F.year(_col(end)) - F.year(_col(start))).cast("bigint")


def sunday_week_of_year(d: Column | str) -> Column:
    """Week number 0-53 where weeks start on Sunday and days before the
    first Sunday of the year are week 0 (strftime %U; not ISO weeks)."""
    d = _col(d)
    return F.floor((F.dayofyear(d) + F.lit(7) - F.dayofweek(d)) / F.lit(7)).cast("bigint")


def week_start_monday(d: Column | str) -> Column:
    return F.trunc(_col(d), "week")


def quarter_end(d: Column | str) -> Column:
    return F.date_sub(F.add_months(F.trunc(_col(d), "quarter"), 3), 1)


def year_end(d: Column | str) -> Column:
    return F.make_date(F.year(_col(d)), F.lit(12), F.lit(31))


def easter_sunday(year: Column | str) -> Column:
    """Gregorian Easter Sunday for a year column (anonymous Gregorian algorithm).

    All terms are non-negative, so integer division is floor division.
    """
    y = _col(year).cast("int")

    def div(a, b):
        return F.floor(a / F.lit(b)).cast("int")

    a = y % 19
    b = div(y, 100)
    c = y % 100
    d = div(b, 4)
    e = b % 4
    f = div(b + 8, 25)
    g = div(b - f + 1, 3)
    h = (19 * a + b - d - g + 15) % 30
    i = div(c, 4)
    k = c % 4
    l_ = (32 + 2 * e + 2 * i - h - k) % 7
    m = div(a + 11 * h + 22 * l_, 451)
    n = h + l_ - 7 * m + 114
    month = div(n, 31)
    day = n % 31 + 1
    return F.make_date(y, month, day)
