"""Half-open time periods held as two columns, ``[start, end)``; NULL end = still open."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, functions as F

Moment = "str | date | datetime | Column"


def moment(value) -> Column:
    """A literal instant; all instants are UTC wall-clock (TIMESTAMP_NTZ)."""
    if isinstance(value, Column):
        return value
    if isinstance(value, (date, datetime)):
        value = value.isoformat(sep=" ") if isinstance(value, datetime) else value.isoformat()
    return F.lit(value).cast("timestamp_ntz")


def make_period(start: Column, end: Column) -> tuple[Column, Column]:
    """Checked constructor: a period that ends at or before its start fails the job."""
    bad = end.isNotNull() & (end <= start)
    checked = F.when(bad, F.raise_error(F.lit("period must end after it starts"))).otherwise(end)
    return start, checked.cast("timestamp_ntz")


def is_open(end: Column) -> Column:
    return end.isNull()


def overlaps(start: Column, end: Column, lo, hi) -> Column:
    """Does ``[start, end)`` share an instant with ``[lo, hi)``?"""
    lo, hi = moment(lo), moment(hi)
    return (start < hi) & (end.isNull() | (end > lo)) & (lo < hi)


def contains(start: Column, end: Column, at) -> Column:
    at = moment(at)
    return (start <= at) & (end.isNull() | (at < end))


def shift(at, *, days: int = 0, months: int = 0, years: int = 0, hours: int = 0) -> Column:
    """``at`` moved by a calendar interval (negative values look back)."""
    base = moment(at)
    if months or years:
        base = base + F.make_ym_interval(F.lit(years), F.lit(months))
    if days or hours:
        base = base + F.make_dt_interval(days=F.lit(days), hours=F.lit(hours))
    return base


def seconds_between(start: Column, end: Column) -> Column:
    """Exact elapsed seconds to the microsecond, independent of the session zone."""
    return (end - start).cast("interval second").cast("decimal(20,6)")


def micros_between(start: Column, end: Column) -> Column:
    return (seconds_between(start, end) * F.lit(1000000)).cast("bigint")


def rental_days(start: Column, end: Column) -> Column:
    """Started days, at least one."""
    return F.greatest(F.ceil(seconds_between(start, end) / F.lit(86400)), F.lit(1)).cast("bigint")


def whole_days(start: Column, end: Column) -> Column:
    """Completed days (callers pass start <= end)."""
    return F.floor(seconds_between(start, end) / F.lit(86400)).cast("bigint")


def dow_number(at: Column) -> Column:
    """Day of week with Sunday = 0."""
    return F.dayofweek(at) - F.lit(1)


def dow_name(at: Column) -> Column:
    """Full English day name, blank-padded to nine characters."""
    return F.rpad(F.date_format(at, "EEEE"), 9, " ")


def month_text(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM")


def month_start(at: Column) -> Column:
    return F.date_trunc("month", at).cast("timestamp_ntz")


def last_day(at: Column) -> Column:
    return F.last_day(at)
