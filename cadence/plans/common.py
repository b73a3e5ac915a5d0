"""Steps shared by the topic jobs: contributor and calendar dimensions, and the
conversion-fact sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import datetime as _dt

from cadence.functions.timefn import Span, add_offset, between_ts, date_key, date_key_between
from cadence.operators.dedup import anti_join_keys
from cadence.operators.dims import calendar, number_members
from cadence.operators.joins import dealt
from cadence.plans.conversions import FACT_KEY
from cadence.sources.sinks import Warehouse

CONTRIBUTOR = "contributor"
CALENDAR = "utc_date_only"
CONTRIBUTOR_FACTS = "contributor_facts"


def raw_in_window(raw: DataFrame, lo, hi) -> DataFrame:
    """Raw rows whose *local* time is inside ``[lo, hi]``."""
    return raw.where(between_ts("local_datetime", lo, hi))


def utc_of_raw() -> F.Column:
    return add_offset("local_datetime", "tz_offset")


def update_contributors(wh: Warehouse, emails: Sequence[DataFrame]) -> DataFrame:
    """Add unseen e-mails (a column ``email`` in each frame) to the contributor dim."""
    members = None
    for df in emails:
        e = df.select(F.col("email")).where(F.col("email").isNotNull())
        members = e if members is None else members.unionByName(e)
    return insert_members(wh, CONTRIBUTOR, members.distinct(), ["email"], "contributor_key")


def insert_members(wh: Warehouse, name: str, members: DataFrame, natural: Sequence[str], key_col: str, **more) -> DataFrame:
    """Store the natural keys of ``members`` that the dim lacks, each under a surrogate key of its
    own; ``more`` are further columns. Returns the dim."""
    stored = wh.read(name)
    fresh = members.select(*natural)
    if stored is not None:
        fresh = anti_join_keys(fresh, dealt(stored), natural)
    with number_members(fresh, natural, key_col, stored) as keyed:
        wh.insert_new(name, keyed.withColumns(more), natural)
    return wh.table(name)


def update_calendar(wh: Warehouse, raw_window: DataFrame) -> DataFrame:
    """Add the UTC dates of the window's raw facts to the calendar dim."""
    cal = calendar(raw_window.select(F.to_date(utc_of_raw()).alias("utc_date_only")))
    wh.insert_new(CALENDAR, cal, ["utc_date_only"])
    return wh.table(CALENDAR)


def store_conversions(wh: Warehouse, rows: DataFrame, replace: bool = False, within: tuple | None = None) -> None:
    """Write ``contributor_facts`` rows: insert-if-absent, or replace by key. ``within``: a range of
    date keys that holds all rows, where the caller knows one."""
    if replace:
        wh.upsert(CONTRIBUTOR_FACTS, rows, FACT_KEY, partition_by=["utc_date_key"])
    else:
        wh.insert_new(CONTRIBUTOR_FACTS, rows, FACT_KEY, partition_by=["utc_date_key"], within=within)


def key_range(lo, hi, span: Span | None = None, pad_days: int = 0) -> tuple[int, int]:
    """The ``yyyyMMdd`` keys of the UTC dates in ``[lo - span, hi]``, widened by ``pad_days``."""
    pad = pad_days + (span.max_days() if span is not None else 0)
    ends = (_dt.datetime.fromisoformat(str(lo)) - _dt.timedelta(days=pad), _dt.datetime.fromisoformat(str(hi)) + _dt.timedelta(days=pad_days))
    return tuple(t.year * 10000 + t.month * 100 + t.day for t in ends)


def load_keys(lo, hi) -> tuple[int, int]:
    """Date keys that a load of the local window ``[lo, hi]`` can give: an offset is less than a day."""
    return key_range(lo, hi, pad_days=1)


def stored_between(wh: Warehouse, name: str, lo, hi, span: Span | None = None) -> DataFrame:
    """Stored rows of the UTC dates in ``[lo - span, hi]`` (a superset of the rows a time
    predicate keeps); no other partition is listed."""
    return in_partitions(wh.table(name, between=key_range(lo, hi, span)), lo, hi, span)


def in_partitions(df: DataFrame, lo, hi, span: Span | None = None, col: str = "utc_date_key") -> DataFrame:
    """Filter on the ``yyyyMMdd`` key for UTC times in ``[lo - span, hi]``."""
    pad = span.max_days() if span is not None else 0
    lo_t = _dt.datetime.fromisoformat(str(lo)) - _dt.timedelta(days=pad)
    return df.where(date_key_between(col, lo_t, hi))


#: Raw tables are partitioned by the date of the local time, which is part of every raw key.
LOCAL_DATE = "local_date_key"


def insert_raw(wh: Warehouse, name: str, rows: DataFrame, key: Sequence[str], lo, hi) -> DataFrame:
    """Store the extracted rows of the local window ``[lo, hi]`` that are new, and return all stored
    rows of the window. Only the window's dates are listed and compared."""
    rows = rows.withColumn(LOCAL_DATE, date_key(F.to_date("local_datetime")))
    wh.insert_new(name, rows, key, partition_by=[LOCAL_DATE], within=key_range(lo, hi), existing_filter=between_ts("local_datetime", lo, hi))
    return raw_in_window(wh.table(name, between=key_range(lo, hi)), lo, hi)
