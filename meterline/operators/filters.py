"""Row predicates. Time ranges stay in range form, which reaches the file scan."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _moment(value: str | date | datetime) -> Column:
    if isinstance(value, date) and not isinstance(value, datetime):
        value = datetime(value.year, value.month, value.day)
    return F.lit(value).cast("timestamp")


def _day(value: str | date) -> date:
    """The day itself; a time of day is cut off."""
    if isinstance(value, datetime):
        return value.date()
    return date.fromisoformat(value) if isinstance(value, str) else value


def in_range(ts: str, start, end) -> Column:
    """Half-open: start included, end excluded."""
    return (F.col(ts) >= _moment(start)) & (F.col(ts) < _moment(end))


def since(ts: str, start) -> Column:
    return F.col(ts) >= _moment(start)


def on_day(ts: str, day: str | date) -> Column:
    """Same rows as ``to_date(ts) = day``."""
    first = _day(day)
    return in_range(ts, first, first + timedelta(days=1))


def between_days(ts: str, first: str | date, last: str | date) -> Column:
    """Both days included."""
    return in_range(ts, _day(first), _day(last) + timedelta(days=1))


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def same_text(column: str, text: str) -> Column:
    """Equality that ignores letter case."""
    return F.lower(column) == text.lower()


def dev_sample(df: DataFrame, ts: str, target: str, start, end) -> DataFrame:
    """Cut to a date range on the development target, all rows on any other."""
    return df.filter(in_range(ts, start, end)) if target == "dev" else df


def file_like(pattern: str, column: str = "file_name") -> Column:
    """LIKE on the file name; ``_`` matches any one character."""
    return F.col(column).like(pattern)
