"""Dates: strict and guarded parsing, ISO text, whole years."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from entityfold.functions.text import stripped, trimmed

# Day zero of the serial dates that workbooks store.
SHEET_DAY_ZERO = "1899-12-30"


def _parsed(text: Column, pattern: str) -> Column:
    """The date of a text that must be one; fails the job otherwise, in ANSI mode or not."""
    bad = F.raise_error(F.concat(F.lit("not a date: "), text)).cast("date")
    return F.when(text.isNotNull(), F.coalesce(F.try_to_date(text, pattern), bad))


def strict_date(c: Column) -> Column:
    """Day/month/year text as a date; blank is null, a bad value fails the job."""
    return _parsed(trimmed(c), "d/M/yyyy")


def guarded_date(c: Column) -> Column:
    """Day/month/year text as a date; null unless it has the shape 00/00/0000.

    A value of that shape which is no calendar day (31/02/2020) still fails the job.
    """
    text = F.trim(c)
    return _parsed(F.when(text.rlike(r"^[0-9]{2}/[0-9]{2}/[0-9]{4}\z"), text), "dd/MM/yyyy")


def compact_date(c: Column) -> Column:
    """Eight digits, year first, as a date; null unless there are eight digits."""
    text = stripped(c)
    return _parsed(F.when(text.rlike(r"^[0-9]{8}\z"), text), "yyyyMMdd")


def compact_iso(c: Column) -> Column:
    """An eight-digit number as ISO text, cut by position with no calendar check."""
    text = c.cast("string")
    cut = F.concat_ws(
        "-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2)
    )
    return F.when(text.rlike(r"^[0-9]{8}\z"), cut)


def iso(c: Column) -> Column:
    """A date as ISO text."""
    return F.date_format(c, "yyyy-MM-dd")


def first_ten(c: Column) -> Column:
    """The date part of a timestamp text; null when the text is shorter than a date."""
    return F.when(F.length(c) >= 10, F.substring(c, 1, 10))


def sheet_date(c: Column) -> Column:
    """A workbook cell as a date: a serial number, or one of the usual written forms, else null."""
    text = stripped(c)
    serial = F.when(
        text.rlike(r"^[0-9]{1,6}([.][0-9]+)?\z"),
        F.date_add(F.lit(SHEET_DAY_ZERO).cast("date"), F.floor(text.cast("double")).cast("int")),
    )
    written = [
        F.try_to_date(F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"), F.substring(text, 1, 10))),
        F.try_to_date(text, "d-MMM-yyyy"),
        F.try_to_date(text, "d MMM yyyy"),
        F.try_to_date(text, "d MMMM yyyy"),
        F.try_to_date(text, "M/d/yyyy"),
    ]
    return F.coalesce(serial, *written)


def age_years(start: Column, as_of: date) -> Column:
    """Whole calendar years from a date to a fixed day, never below zero, null without a date.

    Compares month and day, so 29 February to 28 February of the next year is zero.
    """
    before = (F.month(start) * 100 + F.dayofmonth(start)) > F.lit(as_of.month * 100 + as_of.day)
    years = F.lit(as_of.year) - F.year(start) - before.cast("int")
    return F.when(start.isNotNull(), F.greatest(years, F.lit(0)))
