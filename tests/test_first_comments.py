"""The first-comment mark and its conversions for sources off UTC, late comments and any order of loads."""

import datetime as dt
import itertools
import os

import pytest
from pyspark.sql import functions as F
from source_rows import NAMES, bug_sources, conversion_dim, source_dim, team_dim

from cadence.plans import bugs
from cadence.plans import names as N
from cadence.sources.readers import Sources
from cadence.sources.sinks import Warehouse
from dates import ts

HOUR = dt.timedelta(hours=1)


def sources(spark, comments, activity=()):
    src = Sources(spark, frames=bug_sources(spark))
    src.frames["longdescs"] = spark.createDataFrame([(b, w, ts(t)) for b, w, t in comments], "bug_id long, who long, bug_when timestamp_ntz")
    src.frames["bugs_activity"] = spark.createDataFrame(
        [(b, w, ts(t), 1, "ASSIGNED", "NEW", None) for b, w, t in activity],
        "bug_id long, who long, bug_when timestamp_ntz, fieldid long, added string, removed string, attach_id long")
    return src


def load(spark, wh, src, windows, offset):
    for lo, hi in windows:
        bugs.run(wh, src, f"{lo} 00:00:00", f"{hi} 00:00:00", conversion_dim(spark), source_dim(spark), team_dim(spark), offset=offset,
                 triage_thresholds_list=(50,))


def marks(wh):
    return sorted((r.bug_id, r.fields, str(r.utc_datetime)) for r in wh.table(bugs.FACTS).where("comment_num = 0").collect())


def stored(spark, wh, *names):
    rows = wh.table("contributor_facts").join(conversion_dim(spark), "conversion_key").join(wh.table("contributor"), "contributor_key")
    return sorted((r.conversion_desc, r.email, r.canonical[-3:], str(r.utc_datetime)) for r in rows.collect() if not names or r.conversion_desc in names)


def test_first_comment_before_the_windows_utc_start(spark, scratch):
    """A source two hours ahead of UTC: its first day's earliest comment is on the day before in UTC."""
    wh = Warehouse(spark, scratch)
    src = sources(spark, [(101, 1, "2021-03-07 00:30:00"), (101, 2, "2021-03-08 11:00:00")])
    load(spark, wh, src, [("2021-03-07", "2021-03-09")], -2 * HOUR)
    assert marks(wh) == [(101, "comment", "2021-03-06 22:30:00")]
    assert stored(spark, wh, N.FILING_A_BUG) == [(N.FILING_A_BUG, "ann@x", "101", "2021-03-06 22:30:00")]
    assert [x[1] for x in stored(spark, wh, N.COMMENT_ONE)] == ["ann@x", "bob@x"]


@pytest.mark.parametrize("hours", [-2, 0, 8])
def test_any_order_of_loads_gives_the_same_conversions(spark, scratch, hours):
    comments = [(100, 1, "2021-03-07 00:30:00"), (100, 2, "2021-03-08 11:00:00"), (100, 3, "2021-03-09 00:10:00"),
                (101, 3, "2021-03-08 23:50:00"), (101, 1, "2021-03-09 12:00:00")]
    activity = [(100, 2, "2021-03-07 00:30:00"), (100, 3, "2021-03-08 11:00:00"), (101, 2, "2021-03-09 12:00:00")]
    src = sources(spark, comments, activity)
    days = [("2021-03-07", "2021-03-08"), ("2021-03-08", "2021-03-09"), ("2021-03-09", "2021-03-10")]
    results = []
    for k, order in enumerate([(0, 1, 2), (2, 1, 0), (1, 2, 0, 1)]):
        wh = Warehouse(spark, os.path.join(scratch, str(k)))
        load(spark, wh, src, [days[i] for i in order], hours * HOUR)
        results.append((marks(wh), stored(spark, wh)))
    assert results[0] == results[1] == results[2]
    utc = [str(ts(t) + hours * HOUR) for t in ("2021-03-07 00:30:00", "2021-03-08 23:50:00")]
    assert results[0][0] == [(100, "bug_status", utc[0]), (100, "comment", utc[0]), (101, "comment", utc[1])]
    filed = sorted([(N.FILING_A_BUG, e, b, t) for e, b, t in (("ann@x", "100", utc[0]), ("bob@x", "100", utc[0]), ("cy@x", "101", utc[1]))]
                   + [(NAMES.file_featured_bug, e, "100", utc[0]) for e in ("ann@x", "bob@x")])
    assert [x for x in results[0][1] if x[0] in (N.FILING_A_BUG, NAMES.file_featured_bug)] == filed


def test_withdrawal_leaves_other_conversions_of_the_day(spark, scratch):
    wh = Warehouse(spark, scratch)
    new = [(100, 1, "2021-03-08 10:00:00"), (101, 2, "2021-03-08 10:00:00")]
    load(spark, wh, sources(spark, new), [("2021-03-08", "2021-03-09")], 0 * HOUR)
    before = stored(spark, wh)
    src = sources(spark, [*new, (100, 3, "2021-03-07 09:00:00")])
    for _ in range(2):
        load(spark, wh, src, [("2021-03-07", "2021-03-08")], 0 * HOUR)
        now = stored(spark, wh)
        gone = {x for x in before if x[2] == "100" and x[0] in (N.FILING_A_BUG, NAMES.file_featured_bug)}
        assert len(gone) == 2 and set(before) - set(now) == gone
        assert {x[:3] for x in set(now) - set(before)} == {(d, "cy@x", "100") for d in (N.FILING_A_BUG, NAMES.file_featured_bug, N.COMMENT_ONE)}
    # loading the later day again does not bring the withdrawn ones back
    load(spark, wh, src, [("2021-03-08", "2021-03-09")], 0 * HOUR)
    assert stored(spark, wh) == now


def test_a_load_lost_before_its_marks_is_done_again(spark, scratch, monkeypatch):
    comments = [(100, 1, "2021-03-08 10:00:00")]
    wh = Warehouse(spark, scratch)
    load(spark, wh, sources(spark, comments), [("2021-03-08", "2021-03-09")], 0 * HOUR)
    src = sources(spark, [*comments, (100, 3, "2021-03-07 09:00:00")])
    for step in ("restate_facts", "conversions"):
        with monkeypatch.context() as m:
            m.setattr(bugs, step, lambda *a, **k: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                load(spark, wh, src, [("2021-03-07", "2021-03-08")], 0 * HOUR)
    load(spark, wh, src, [("2021-03-07", "2021-03-08")], 0 * HOUR)
    assert marks(wh) == [(100, "comment", "2021-03-07 09:00:00")]
    assert [x[1] for x in stored(spark, wh, N.FILING_A_BUG)] == ["cy@x"]


def test_marks_are_rebuilt_from_facts_stored_without_them(spark, scratch):
    wh = Warehouse(spark, scratch)
    comments = [(100, 1, "2021-03-07 10:00:00"), (100, 2, "2021-03-08 10:00:00")]
    load(spark, wh, sources(spark, comments), [("2021-03-07", "2021-03-08")], 0 * HOUR)
    wh._entry_of = wh._entry
    wh._entry = lambda name: None if name == bugs.FIRST_COMMENT else wh._entry_of(name)
    wh._plain = lambda name, plain=wh._plain: None if name == bugs.FIRST_COMMENT else plain(name)
    marks_now = bugs.first_comments(wh, wh.table(bugs.FACTS)).collect()
    assert [(r.bug_id, str(r._old), str(r._first)) for r in marks_now if r.bug_id == 100] == [(100, "2021-03-07 10:00:00", "2021-03-07 10:00:00")]
