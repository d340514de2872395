"""Scalar expressions. Missing is always NULL, never NaN; division by zero is NULL."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The marker of a suppressed reading in the footfall files.
SUPPRESSED = "IDE"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(d: str | dt.date) -> Column:
    return F.lit(str(d)).cast("date")


def nan_to_null(c: Column | str) -> Column:
    return F.when(~F.isnan(_c(c)), _c(c))


def unmask(c: Column | str, marker: str = SUPPRESSED) -> Column:
    """Text measure to double: the marker becomes NULL, any other junk raises."""
    return F.nullif(F.trim(_c(c)), F.lit(marker)).cast("double")


def hour_of_band(c: Column | str) -> Column:
    """Leading hour of a band such as ``"07-09"``."""
    return F.substring(_c(c), 1, 2).cast("int")


def file_name_of(path: Column | str) -> Column:
    return F.substring_index(_c(path), "/", -1)


def folder_date(path: Column | str) -> Column:
    """Date at the end of the drop folder in ``.../<folder>DD_MM_YYYY/files/<file>``."""
    folder = F.substring_index(F.substring_index(_c(path), "/", -3), "/", 1)
    return F.to_date(F.right(folder, F.lit(10)), "dd_MM_yyyy")


def repair_name(c: Column | str) -> Column:
    """Replace each character outside ASCII by an apostrophe."""
    return F.regexp_replace(_c(c), "[^\\x00-\\x7f]", "'")


def month_of(c: Column | str) -> Column:
    return F.trunc(_c(c), "month").cast("date")


def ordinal_day(c: Column | str) -> Column:
    """Day number that counts 0001-01-01 as 1."""
    return F.datediff(_c(c), as_date("0001-01-01")) + 1


def days_since(c: Column | str, t0: str | dt.date) -> Column:
    return F.datediff(_c(c), as_date(t0))


def weeks_since(c: Column | str, t0: str | dt.date) -> Column:
    return days_since(c, t0) / F.lit(7.0)


def day_span(start: str | dt.date, end: str | dt.date) -> Column:
    """Every day from ``start`` to ``end``, both included, as an array."""
    return F.sequence(as_date(start), as_date(end), F.expr("interval 1 day"))


def month_span(start: str | dt.date, end: str | dt.date) -> Column:
    """First days of the months that *end* on or before the first of ``end``'s month.

    ``2021-03`` to ``2022-03`` therefore gives twelve months, the last one 2022-02.
    """
    first, last = F.trunc(as_date(start), "month"), F.trunc(as_date(end), "month")
    months = F.sequence(first, last, F.expr("interval 1 month"))
    return F.filter(months, lambda m: F.last_day(m) <= last)


def month_window(start: str, end: str) -> tuple[dt.date, dt.date]:
    """``month_span`` as its first and last day, for filters that reach the scan."""
    first = dt.date.fromisoformat(f"{start[:7]}-01")
    last = dt.date.fromisoformat(f"{end[:7]}-01") - dt.timedelta(days=1)
    return first, last


def ratio(top: Column | str, bottom: Column | str) -> Column:
    return F.try_divide(_c(top).cast("double"), _c(bottom).cast("double"))


def safe_log(c: Column | str) -> Column:
    """Natural log; zero and negative arguments give NULL."""
    return F.log(_c(c).cast("double"))


def cap(c: Column | str, upper: float) -> Column:
    """Upper limit that keeps NULL (``least`` would turn NULL into the limit)."""
    return F.when(_c(c) > upper, F.lit(float(upper))).otherwise(_c(c))


def row_mean(cols: Sequence[Column | str]) -> Column:
    """Mean across columns over the non-null ones; NULL when all are null."""
    return F.try_divide(row_sum(cols), row_count(cols).cast("double"))


def row_sum(cols: Sequence[Column | str]) -> Column:
    total = F.lit(0.0)
    for c in cols:
        total = total + F.coalesce(_c(c), F.lit(0.0))
    return total


def row_count(cols: Sequence[Column | str]) -> Column:
    n = F.lit(0)
    for c in cols:
        n = n + _c(c).isNotNull().cast("int")
    return n


def within(c: Column | str, start: str | dt.date, end: str | dt.date) -> Column:
    """Both ends included, at day resolution, in a form that reaches the file scan."""
    after = dt.date.fromisoformat(str(end)) + dt.timedelta(days=1)
    return (_c(c) >= as_date(start)) & (_c(c) < as_date(after))
