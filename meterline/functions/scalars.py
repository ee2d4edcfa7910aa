"""Scalar expressions; each says what exactly it counts or accepts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trunc_to(ts: str | Column, unit: str) -> Column:
    return F.date_trunc(unit, _col(ts))


def day_of(ts: str | Column) -> Column:
    return F.to_date(_col(ts))


def to_seconds(ts: str | Column) -> Column:
    return F.unix_timestamp(_col(ts))


def minutes_between(start: str | Column, end: str | Column) -> Column:
    """Minute boundaries crossed: 00:00:59 to 00:01:01 is 1."""
    whole = lambda c: F.unix_timestamp(F.date_trunc("minute", _col(c)))
    return ((whole(end) - whole(start)) / 60).cast("bigint")


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """Whole seconds elapsed."""
    return F.timestamp_diff("SECOND", _col(start), _col(end))


def year_of(ts: str | Column) -> Column:
    return F.year(_col(ts))


def parse_ts(c: str | Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Null when the text does not fit the pattern."""
    return F.try_to_timestamp(_col(c), F.lit(fmt))


def from_millis(c: str | Column) -> Column:
    return F.timestamp_millis(_col(c))


def to_millis(ts: str | Column) -> Column:
    return F.unix_millis(_col(ts))


def format_ts(ts: str | Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(_col(ts), fmt)


def concat_key(*parts: str | Column) -> Column:
    """Joined with ``|``; null as soon as one part is null."""
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        if i:
            pieces.append(F.lit("|"))
        pieces.append(_col(part).cast("string"))
    return F.concat(*pieces)


def finite_or_null(c: str | Column) -> Column:
    """NaN and infinities become null."""
    col = _col(c)
    return F.when(~F.isnan(col) & (F.abs(col) != F.lit(float("inf"))), col)


def lenient_double(c: str | Column) -> Column:
    """A number that may come as text. Missing and NaN are null: NaN would count as large."""
    return finite_or_null(_col(c).cast("string").try_cast("double"))
