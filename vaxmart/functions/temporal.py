"""Calendar and week arithmetic.

Weeks start on Monday everywhere in this module, matching ``trunc(d, 'week')``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def week_start(d: str | Column) -> Column:
    """Monday of the week of ``d``, as a date."""
    return F.trunc(_col(d).cast("date"), "week")


def weeks_between(start: str | Column, end: str | Column) -> Column:
    """Number of Monday week boundaries crossed going from ``start`` to ``end``.

    Sunday -> next Monday is 1; Monday -> the following Sunday is 0. Both
    truncated dates are Mondays, so the day difference divides exactly by 7.
    """
    return (F.datediff(week_start(end), week_start(start)) / F.lit(7)).cast("int")


def year_month(d: str | Column) -> Column:
    """Month bucket text: the date with its day replaced by 01 (yyyy-MM-dd)."""
    return F.date_format(F.trunc(_col(d).cast("date"), "month"), "yyyy-MM-dd")


def is_month_end(d: str | Column) -> Column:
    date = _col(d).cast("date")
    return F.last_day(date) == date


def load_mode(d: str | Column) -> Column:
    """'replace' on the last day of a month (full reload), else 'append'."""
    return F.when(is_month_end(d), F.lit("replace")).otherwise(F.lit("append"))


def load_mode_for(run_date: dt.date) -> str:
    """Driver-side twin of :func:`load_mode` for choosing a write mode."""
    next_day = run_date + dt.timedelta(days=1)
    return "replace" if next_day.month != run_date.month else "append"


def calendar_fields(d: str | Column) -> dict[str, Column]:
    """day, ISO week, month, year and weekday (0 = Sunday) of ``d``."""
    date = _col(d).cast("date")
    return {
        "day": F.dayofmonth(date),
        "week": F.weekofyear(date),
        "month": F.month(date),
        "year": F.year(date),
        "weekday": (F.dayofweek(date) - 1).cast("int"),
    }
