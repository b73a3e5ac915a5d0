"""Weekly snapshot job: ``contributor_active`` for the Mondays of a window, with
``is_new`` recomputed where it can change.

A weekly run reads the facts of the weeks that changed since the last run, not those of
the whole trailing span: ``contributor_weeks`` holds what a week's facts say to a snapshot."""

from __future__ import annotations

import datetime as _dt
import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.functions.timefn import YEAR, Span, shift_back
from cadence.operators.hop import Mondays, calendar_mondays, first_monday_at_or_after
from cadence.operators.dedup import anti_join_keys
from cadence.operators.joins import broadcast_bounded, dealt
from cadence.operators.keys import semi_join_keys
from cadence.plans.common import CALENDAR, CONTRIBUTOR_FACTS, stored_between
from cadence.plans.snapshot import SNAPSHOT_KEY, active_snapshot, flag_new
from cadence.sources.sinks import Warehouse

ACTIVE = "contributor_active"
WEEKS = "contributor_weeks"
WEEKS_SEEN = "contributor_weeks_seen"
WEEK_KEY = ["contributor_key", "conversion_key", "team_key", "source_key"]


def _key(day: _dt.date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def weekly_activity(facts: DataFrame) -> DataFrame:
    """One row per (contributor, conversion, team, source, week) with the latest time of its facts.

    A fact's week is the first Monday it counts for. Facts of one key and week count for
    Mondays from there on, the latest one for the longest: to a snapshot of any span the row is all of them.
    """
    week = first_monday_at_or_after(F.col("utc_datetime")).alias("week")
    return facts.select(*WEEK_KEY, "utc_datetime", week).groupBy(*WEEK_KEY, "week").agg(F.max("utc_datetime").alias("utc_datetime"))


def _stale_weeks(wh: Warehouse, mondays: Mondays, span: Span, batches: dict) -> dict[_dt.date, str]:
    """Weeks that count for ``mondays`` and whose facts are not those ``contributor_weeks`` was made of,
    with a digest of the batches that they consist of now."""
    stored = wh.read(WEEKS_SEEN)
    seen = {r["week"]: r["digest"] for r in stored.collect()} if stored is not None else {}  # a row a week
    first = mondays.first - _dt.timedelta(days=span.max_days() + 7)
    week, stale = mondays.last, {}
    while week >= first:
        # the facts of a week are on its seven days and, at midnight, on the Monday itself
        own = [(k, batches.get(k, [])) for k in (_key(week - _dt.timedelta(days=i)) for i in range(8))]
        digest = hashlib.sha256(repr(own).encode()).hexdigest() if any(b for _, b in own) else ""
        if seen.get(week, "") != digest:
            stale[week] = digest
        week -= _dt.timedelta(days=7)
    return stale


def refresh_weeks(wh: Warehouse, mondays: Mondays, span: Span = YEAR) -> list[_dt.date]:
    """Bring ``contributor_weeks`` up to date for what counts at ``mondays``: weeks with late, new,
    replaced or withdrawn facts are read again, all others left. Returns those weeks."""
    stale = _stale_weeks(wh, mondays, span, wh.batches(CONTRIBUTOR_FACTS) or {})
    if not stale:
        return []
    ends = _key(min(stale) - _dt.timedelta(days=7)), _key(max(stale))
    days = {_key(w - _dt.timedelta(days=i)) for w in stale for i in range(8)}
    facts = wh.table(CONTRIBUTOR_FACTS, between=ends).where(F.col("utc_date_key").isin(sorted(days)))
    rows = weekly_activity(facts).where(F.col("week").isin(sorted(stale)))
    wh.overwrite_partitions(WEEKS, rows, ["week"], clear=sorted(stale))
    wh.upsert(WEEKS_SEEN, wh.spark.createDataFrame(sorted(stale.items()), "week date, digest string"), ["week"])
    return sorted(stale)


def _activity(wh: Warehouse, mondays: Mondays, span: Span) -> DataFrame:
    """Facts that count for ``mondays``: a row a key and week, or the facts themselves where a plain folder holds them."""
    if wh.batches(CONTRIBUTOR_FACTS) is None:
        return stored_between(wh, CONTRIBUTOR_FACTS, mondays.first, mondays.last, span)
    refresh_weeks(wh, mondays, span)
    return wh.table(WEEKS, between=(mondays.first - _dt.timedelta(days=span.max_days() + 7), mondays.last))


def snapshot_window(wh: Warehouse, lo, hi, conversion_dim: DataFrame, team_dim: DataFrame, source_dim: DataFrame,
                    span: Span = YEAR) -> DataFrame | None:
    """Snapshot rows (with ``is_new``) for the calendar Mondays in ``[lo, hi]``, and stored
    rows of later Mondays whose flag they change, with all rows of these Mondays.

    New rows are added insert-if-absent to the stored snapshot; ``is_new`` is then
    derived from all stored rows in the trailing span of each date. A late Monday can
    change later flags too, so the flags do not depend on the order in which windows are run.
    """
    mondays = calendar_mondays(wh.table(CALENDAR), lo, hi)
    if mondays.empty:
        return None
    new = active_snapshot(_activity(wh, mondays, span), conversion_dim, team_dim, source_dim, mondays, span)
    # up to the last date whose trailing span still holds the window's last Monday
    ends = mondays.first - _dt.timedelta(days=span.max_days()), mondays.last + _dt.timedelta(days=span.max_days())
    history = wh.read(ACTIVE, between=ends)
    if history is None:
        return flag_new(new, span)
    reached = shift_back(F.col("c_date"), span) <= F.lit(mondays.last)
    history = history.where((F.col("c_date") >= shift_back(F.lit(mondays.first), span)) & reached)
    # ``new`` has one row a key already: no need to sort all its rows for the first of each
    rows = history.unionByName(anti_join_keys(new.withColumn("is_new", F.lit(None).cast("int")), dealt(history), SNAPSHOT_KEY))
    flagged = flag_new(rows.withColumnRenamed("is_new", "_was"), span)
    flagged = flagged.where(F.col("c_date") >= F.lit(mondays.first))
    changed = flagged.where(~F.col("_was").eqNullSafe(F.col("is_new"))).select("c_date").distinct()
    # at most a date a week, but millions of rows a date
    weeks = (ends[1] - mondays.first).days // 7 + 1
    return semi_join_keys(flagged, broadcast_bounded(changed, known_rows=weeks), ["c_date"]).drop("_was")


def run(wh: Warehouse, lo, hi, conversion_dim: DataFrame, team_dim: DataFrame, source_dim: DataFrame,
        span: Span = YEAR) -> list[str]:
    """Store the snapshot of the window's Mondays. Returns the partitions rewritten: the window's
    own where they are new, and later ones only where a flag changes."""
    out = snapshot_window(wh, lo, hi, conversion_dim, team_dim, source_dim, span)
    return [] if out is None else wh.overwrite_partitions(ACTIVE, out.select(*SNAPSHOT_KEY, "is_new"), ["c_date"])
