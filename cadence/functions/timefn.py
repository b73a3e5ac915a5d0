"""Time handling: local time to UTC, calendar attributes, closed windows, spans.

All times are ``timestamp_ntz`` (wall-clock, no zone) as in the warehouse; a
window ``[lo, hi]`` is closed on both ends.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_ntz(value) -> Column:
    """A typed ``timestamp_ntz`` literal from a string / date / datetime / Column.

    Bounds are typed, never compared as strings: a date column compared with the
    string '2014-06-02 12:00:00' would otherwise be cast down to a date.
    """
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, _dt.datetime):
        value = value.isoformat(sep=" ")
    elif isinstance(value, _dt.date):
        value = value.isoformat() + " 00:00:00"
    return F.lit(str(value)).cast("timestamp_ntz")


def between_ts(c, lo, hi) -> Column:
    """Closed window ``lo <= c <= hi`` on a timestamp column (pushes down to Parquet)."""
    return _col(c).between(to_ntz(lo), to_ntz(hi))


@dataclass(frozen=True)
class Span:
    """A calendar span: months (month-end clamped, like SQL intervals) plus days."""

    months: int = 0
    days: int = 0

    @staticmethod
    def weeks(n: int) -> "Span":
        return Span(days=7 * n)

    def max_days(self) -> int:
        """Upper bound of the span in days (31 per month)."""
        return self.months * 31 + self.days


YEAR = Span(months=12)
QUARTER = Span(months=3)


def shift_back(c, span: Span) -> Column:
    """``c - span`` for a timestamp/date column; months clamp to month end."""
    out = _col(c)
    if span.months:
        out = out - F.make_ym_interval(F.lit(0), F.lit(span.months))
    if span.days:
        out = out - F.make_dt_interval(F.lit(span.days))
    return out


def shift_forward(c, span: Span) -> Column:
    out = _col(c)
    if span.months:
        out = out + F.make_ym_interval(F.lit(0), F.lit(span.months))
    if span.days:
        out = out + F.make_dt_interval(F.lit(span.days))
    return out


def hours_offset(hours) -> Column:
    """A day-time interval of ``hours`` (int or integer Column)."""
    h = F.lit(hours) if isinstance(hours, int) else _col(hours)
    return F.make_dt_interval(F.lit(0), h)


def add_offset(local, offset) -> Column:
    """Local time plus an offset interval; a NULL offset gives a NULL result."""
    return _col(local) + _col(offset)


def to_utc(local, offset=None, tz: str | None = None) -> Column:
    """UTC wall-clock time of a local timestamp.

    * ``offset`` column (day-time interval) when the source gives one,
    * else ``tz`` (a zone id, so each event gets the offset of its own instant,
      right across a daylight-saving change; a local time that a clock change skips
      counts from before the change, of one that comes twice the first is taken),
    * else the local time is taken as UTC.
    """
    if offset is not None:
        return add_offset(local, offset)
    if tz is not None:
        return F.convert_timezone(F.lit(tz), F.lit("UTC"), _col(local))
    return _col(local)


def utc_date(ts) -> Column:
    return F.to_date(_col(ts))


def date_key(d) -> Column:
    """Integer calendar key ``yyyyMMdd``."""
    d = _col(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def mysql_week(d) -> Column:
    """Week number with Sunday-start weeks, 0-53 (week 1 starts at the first Sunday).

    Not ISO ``weekofyear``: days before the first Sunday of the year are week 0.
    """
    d = _col(d)
    return F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / 7).cast("int")


def calendar_attributes(d) -> list[Column]:
    """dayOfWeek (1 = Sunday), weekOfYear (Sunday weeks), monthOfYear, year."""
    d = _col(d)
    return [
        F.dayofweek(d).alias("dayOfWeek"),
        mysql_week(d).alias("weekOfYear"),
        F.month(d).alias("monthOfYear"),
        F.year(d).alias("year"),
    ]


def ymd_month_name(d) -> Column:
    """Date as ``2014/June/2`` (year / full month name / day without padding)."""
    return F.date_format(_col(d), "yyyy/MMMM/d")


def offset_column(local, tz: str | None = None, offset=None) -> Column:
    """The source's UTC offset for each row, as a day-time interval.

    * ``offset``: a fixed offset (``datetime.timedelta`` or interval Column), as a
      source reports it at extract time,
    * ``tz``: the offset of each row's own instant in that zone (right across a
      daylight-saving change),
    * neither: zero, so local time is taken as UTC (never NULL, which would lose
      the row at the calendar join).
    """
    if offset is not None:
        if isinstance(offset, Column):
            return offset
        secs = int(offset.total_seconds()) if hasattr(offset, "total_seconds") else int(offset) * 3600
        return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(secs).cast("decimal(18,6)"))
    if tz is not None:
        loc = _col(local)
        return F.convert_timezone(F.lit(tz), F.lit("UTC"), loc) - loc
    return F.make_dt_interval(F.lit(0))


def date_key_between(c, lo, hi, pad_days: int = 0) -> Column:
    """``yyyyMMdd`` key column between the dates of ``lo`` and ``hi`` (widened by
    ``pad_days``): a partition filter matching a time window."""
    lo_d = _dt.datetime.fromisoformat(str(lo)).date() - _dt.timedelta(days=pad_days)
    hi_d = _dt.datetime.fromisoformat(str(hi)).date() + _dt.timedelta(days=pad_days)
    k = lambda x: x.year * 10000 + x.month * 100 + x.day
    return _col(c).between(F.lit(k(lo_d)), F.lit(k(hi_d)))
