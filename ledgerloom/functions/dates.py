"""Column expressions for the compact date formats of the raw files and for months.

Dates are put together with arithmetic and ``make_date``, which stays in generated code and costs a
fraction of parsing text with a pattern.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_CENTURY = 1900


def _date(year: Column, month: Column, day: Column) -> Column:
    """Date from its parts, NULL if there is no such day."""
    is_month = month.between(1, 12)
    last_day = F.dayofmonth(F.last_day(F.make_date(year, F.when(is_month, month), F.lit(1))))
    return F.when(is_month & day.between(1, last_day), F.make_date(year, month, day))


def _parts(number: Column) -> tuple[Column, Column, Column]:
    """Year, month digits and day digits of a YYMMDD integer; NULL for one of more than six digits."""
    number = F.when(number.between(0, 999_999), number).cast("int")
    year = _CENTURY + F.floor(number / 10_000).cast("int")
    return year, F.floor(number / 100).cast("int") % 100, number % 100


def parse_yymmdd(number: Column) -> Column:
    """Date from a YYMMDD integer of the 1900s; leading zeros may be lost, a malformed one is NULL."""
    return _date(*_parts(number))


def parse_yymmdd_prefix(text: Column) -> Column:
    """Date from the first six characters of a ``YYMMDD hh:mm:ss`` text."""
    prefix = F.substring(text, 1, 6)
    return parse_yymmdd(F.when(F.length(F.trim(prefix)) == 6, prefix.try_cast("int")))


def birth_gender(number: Column) -> Column:
    """F where the month digits carry the 50 added for women, else M."""
    _, month, _ = _parts(number)
    return F.when(month > 50, "F").otherwise("M")


def birth_date(number: Column) -> Column:
    """Date of birth from YYMMDD with or without the added 50; NULL for a day that does not exist."""
    year, month, day = _parts(number)
    return _date(year, F.when(month > 50, month - 50).otherwise(month), day)


def birth_age(number: Column, in_year: int) -> Column:
    """Years between the year of birth and a reference year; needs the year digits only."""
    return F.lit(in_year) - _parts(number)[0]


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def month_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


class Calendar:
    """The months from ``first`` to ``last`` (days like ``1993-01-01``), numbered from 1.

    Month numbers are integers, so grouping, comparing and generating them is cheap; the text
    ``yyyy-MM`` comes out of one constant array.
    """

    def __init__(self, first: str, last: str):
        self.first, self.last = dt.date.fromisoformat(first), dt.date.fromisoformat(last)
        self._base = self.first.year * 12 + self.first.month - 1
        self.months = self.last.year * 12 + self.last.month - self._base

    def number(self, day: Column) -> Column:
        """Month number of a day; below 1 or above ``months`` outside the calendar."""
        return F.year(day) * 12 + F.month(day) - self._base

    def texts(self) -> Column:
        names = [divmod(self._base + i, 12) for i in range(self.months)]
        return F.array(*[F.lit(f"{year:04d}-{month + 1:02d}") for year, month in names])
