"""Dates, months and time keys as column expressions.

Month arithmetic runs on a month index (``12 * year + month - 1``), an integer that orders and
subtracts like a date but needs no calendar lookups.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from waterline.config import OPEN_YEAR


DATE_FORMS = ("yyyy-M-d", "M/d/yyyy", "yyyy/M/d", "yyyyMMdd", "d-MMM-yyyy")
SHORT_YEAR_FORMS = ("M/d/yy", "d-MMM-yy")


def parse_date(text: Column) -> Column:
    """A date in one of the known forms, with or without a time behind it; else NULL."""
    head = F.regexp_extract(F.trim(text), r"^(\d+-\d+-\d+(?=T)|\S+)", 1)
    day = F.coalesce(*[F.try_to_timestamp(head, F.lit(form)) for form in DATE_FORMS]).cast("date")
    short = F.coalesce(*[F.try_to_timestamp(head, F.lit(form)) for form in SHORT_YEAR_FORMS]).cast("date")
    # years 69 to 99 are of the last century
    return F.coalesce(day, F.when(F.year(short) >= 2069, F.add_months(short, -1200)).otherwise(short))


def open_as_null(end: Column) -> Column:
    """End dates in the open-ended sentinel year or later become NULL."""
    return F.when(F.year(end) < OPEN_YEAR, end)


def open_as_date(end: Column, last: dt.date) -> Column:
    """End dates in the open-ended sentinel year or later become ``last``."""
    return F.when(F.year(end) >= OPEN_YEAR, F.lit(last)).otherwise(end)


def effective_end(end: Column, as_of: dt.date) -> Column:
    """Open contracts run to the analysis date; dated ones, future included, keep their end."""
    return F.when(end.isNull() | (F.year(end) >= OPEN_YEAR), F.lit(as_of)).otherwise(end)


def month_index(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day) - 1


def month_start(index: Column) -> Column:
    """First day of an indexed month."""
    return F.make_date(F.floor(index / 12).cast("int"), F.pmod(index, F.lit(12)) + 1, F.lit(1))


def month_label(index: Column) -> Column:
    return F.date_format(month_start(index), "yyyy-MM")


def days_in_month(index: Column) -> Column:
    return F.dayofmonth(F.last_day(month_start(index)))


def label_index(label: Column) -> Column:
    """Month index of a ``yyyy-MM`` label."""
    return F.substring(label, 1, 4).cast("int") * 12 + F.substring(label, 6, 2).cast("int") - 1


def week_key(day: Column) -> Column:
    """The Sunday on or before the day."""
    return F.date_sub(day, F.dayofweek(day) - 1).cast("string")


def month_key(day: Column) -> Column:
    return F.substring(day.cast("string"), 1, 7)


def quarter_key(day: Column) -> Column:
    return F.concat(F.year(day).cast("string"), F.lit("Q"), F.quarter(day).cast("string"))


def year_key(day: Column) -> Column:
    return F.year(day).cast("string")


TIME_KEYS = {
    "week_key": week_key,
    "month_key": month_key,
    "quarter_key": quarter_key,
    "year_key": year_key,
}
