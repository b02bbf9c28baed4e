"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_month_name_date(year: Column | str, month_name: Column | str, day: Column | str) -> Column:
    """Date from a year, a full English month name and a day of month (``2016``, ``July``, ``3``).

    ``concat`` (not ``concat_ws``) so that a missing part gives a null date instead of a parse error.
    """
    parts = [(F.col(p) if isinstance(p, str) else p).cast("string") for p in (year, month_name, day)]
    return F.to_date(F.concat(parts[0], F.lit(" "), parts[1], F.lit(" "), parts[2]), "yyyy MMMM d")


def month_floor(d: Column | str) -> Column:
    """First day of the month, as a DATE."""
    return F.trunc(F.col(d) if isinstance(d, str) else d, "month")


def weekday_name(d: Column | str) -> Column:
    """Full English weekday name (``Monday``). Spark's ``dayname`` gives ``Mon``, so format instead."""
    return F.date_format(F.col(d) if isinstance(d, str) else d, "EEEE")


def weekday_number(d: Column | str) -> Column:
    """Weekday with Monday = 0 ... Sunday = 6."""
    return F.weekday(F.col(d) if isinstance(d, str) else d)


def month_label(d: Column | str) -> Column:
    """``MM-Mon`` label, e.g. ``07-Jul``: sorts by month number and still reads as a name."""
    return F.date_format(F.col(d) if isinstance(d, str) else d, "MM-MMM")


def week_start(d: Column | str) -> Column:
    """Monday that starts the Monday-to-Sunday week holding ``d`` (2017-01-01 -> 2016-12-26)."""
    return F.date_trunc("week", F.col(d) if isinstance(d, str) else d).cast("date")
