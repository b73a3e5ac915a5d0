"""Weekly hop over a trailing calendar window: "as seen each Monday".

For every Monday ``D`` (a date, compared as ``D 00:00``) a fact at time ``u``
counts when ``D - span <= u <= D`` (both ends closed, months clamp to month end).
Instead of a theta join Mondays x facts (a nested loop), each fact is exploded to
the few Mondays it counts for, so the work is a narrow explode followed by an
ordinary hash aggregation on the group key.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.functions.timefn import Span, shift_back, shift_forward, to_ntz
from cadence.operators.joins import broadcast_bounded

AS_OF = "as_of"


def _as_datetime(v) -> _dt.datetime:
    if isinstance(v, _dt.datetime):
        return v
    if isinstance(v, _dt.date):
        return _dt.datetime(v.year, v.month, v.day)
    return _dt.datetime.fromisoformat(str(v))


def monday_bounds(lo, hi) -> tuple[_dt.date, _dt.date, int]:
    """First and last Monday ``D`` with ``lo <= D 00:00 <= hi`` and their count.

    Typed bounds: a ``lo`` of Monday 12:00 excludes that Monday.
    """
    lo_t, hi_t = _as_datetime(lo), _as_datetime(hi)
    first = lo_t.date()
    if lo_t.time() != _dt.time(0):
        first += _dt.timedelta(days=1)
    first += _dt.timedelta(days=(7 - first.weekday()) % 7)
    last = hi_t.date() - _dt.timedelta(days=hi_t.date().weekday())
    n = max(0, (last - first).days // 7 + 1)
    return first, last, n


@dataclass
class Mondays:
    """The list of reporting Mondays, with the bound used to size its broadcast."""

    df: DataFrame | None   # column ``as_of`` (date); None = every Monday in range
    first: _dt.date
    last: _dt.date
    max_rows: int

    @property
    def empty(self) -> bool:
        return self.max_rows == 0


def every_monday(lo, hi) -> Mondays:
    """All Mondays in ``[lo, hi]`` (no table needed; generated inside the explode)."""
    first, last, n = monday_bounds(lo, hi)
    return Mondays(None, first, last, n)


def monday_frame(spark: SparkSession, lo, hi) -> DataFrame:
    """All Mondays in ``[lo, hi]`` as a DataFrame (``spark.range`` over week numbers)."""
    first, _, n = monday_bounds(lo, hi)
    return spark.range(n).select(
        F.date_add(F.lit(first), (F.col("id") * 7).cast("int")).alias(AS_OF))


def calendar_mondays(calendar: DataFrame, lo, hi, date_col: str = "utc_date_only") -> Mondays:
    """Mondays present in the calendar dimension within ``[lo, hi]``.

    The calendar holds only dates on which facts occurred, so a week without any
    activity has no reporting Monday (as in a calendar-driven run).
    """
    first, last, n = monday_bounds(lo, hi)
    d = F.col(date_col)
    df = (calendar.where((F.dayofweek(d) == 2) & d.between(F.lit(first), F.lit(last)))
          .select(d.alias(AS_OF)).distinct())
    return Mondays(df, first, last, n)


def first_monday_at_or_after(u: Column) -> Column:
    """Earliest Monday ``D`` with ``D 00:00 >= u``."""
    d = F.to_date(u)
    at_midnight = u == d.cast("timestamp_ntz")
    return F.next_day(F.date_sub(d, F.when(at_midnight, 1).otherwise(0)), "Mon")


def last_monday_counting(u: Column, span: Span) -> Column:
    """Latest Monday ``D`` with ``D - span <= u``.

    ``D - span`` (a midnight) is at most ``u`` exactly when its date is at most
    ``date(u)``; the latest date ``X`` with ``X - span <= date(u)`` is ``date(u) +
    span``, except that a month-end ``date(u)`` also takes every later day of the
    target month (they all clamp back onto it). The answer is the Monday on or
    before ``X``.
    """
    if span.months and span.days:
        raise ValueError("a span in months or in days, not both")
    d = F.to_date(u)
    if span.months:
        moved = F.add_months(d, span.months)
        x = F.when(d == F.last_day(d), F.last_day(moved)).otherwise(moved)
    else:
        x = F.date_add(d, span.days)
    return F.date_sub(F.next_day(x, "Mon"), 7)


def relevant_rows(ts: Column, mondays: Mondays, span: Span) -> Column:
    """Facts that count for at least one Monday of the list (pushed to the scan)."""
    lo = shift_back(to_ntz(mondays.first), span)
    return ts.between(lo, to_ntz(mondays.last))


def hop_explode(df: DataFrame, ts: str, mondays: Mondays, span: Span,
                as_of: str = AS_OF) -> DataFrame:
    """One output row per (input row, Monday it counts for); adds column ``as_of``.

    Candidates run from the first Monday at/after ``u`` to ``date(u + span) + 9``
    days (month-end clamping can put a Monday up to 3 days past ``u + span``); the
    exact closed predicate then keeps the right ones. Rows count for at most
    ``span/7 + 2`` Mondays, so the fan-out is bounded by the span, not the data.
    """
    u = F.col(ts)
    start = F.greatest(first_monday_at_or_after(u), F.lit(mondays.first))
    stop = F.least(F.date_add(F.to_date(shift_forward(u, span)), 9), F.lit(mondays.last))
    cands = F.when(start <= stop, F.sequence(start, stop, F.expr("INTERVAL 7 DAYS"))) \
        .otherwise(F.array().cast("array<date>"))
    out = (df.where(relevant_rows(u, mondays, span))
           .withColumn(as_of, F.explode(cands)))
    d_ts = F.col(as_of).cast("timestamp_ntz")
    out = out.where((shift_back(d_ts, span) <= u) & (u <= d_ts))
    if mondays.df is not None:
        listed = broadcast_bounded(mondays.df.withColumnRenamed(AS_OF, as_of),
                                   known_rows=mondays.max_rows)
        out = out.join(listed, as_of, "left_semi")
    return out


def day_bucket_cols(ts: str) -> list[Column]:
    """Bucket keys under which every fact counts for exactly the same Mondays.

    Facts at exactly midnight differ from later facts of the same day (a Monday
    00:00 fact counts for that Monday), so a bucket is (date, at-midnight).
    """
    u = F.col(ts)
    d = F.to_date(u)
    return [d.alias("_bucket_day"), (u == d.cast("timestamp_ntz")).alias("_bucket_midnight")]
