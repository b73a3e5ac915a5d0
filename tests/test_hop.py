import datetime as dt
import random

from cadence.functions.timefn import QUARTER, YEAR, Span
from cadence.operators.hop import (calendar_mondays, every_monday, hop_explode, monday_bounds, monday_frame)
from dates import d, ts


def brute(facts, mondays, span):
    """Theta join written directly: Monday D counts u when D - span <= u <= D."""
    def minus(day, span):
        y, m = day.year, day.month - span.months
        while m <= 0:
            m += 12
            y -= 1
        last = [31, 29 if (y % 4 == 0 and (y % 100 != 0 or y % 400 == 0)) else 28, 31, 30, 31, 30, 31, 31, 30, 31,
                30, 31][m - 1]
        out = dt.datetime(y, m, min(day.day, last))
        return out - dt.timedelta(days=span.days)
    res = set()
    for i, u in facts:
        for m in mondays:
            dd = dt.datetime(m.year, m.month, m.day)
            if minus(dd, span) <= u <= dd:
                res.add((i, m))
    return res


def test_monday_bounds_typed():
    first, last, n = monday_bounds("2014-06-02 12:00:00", "2014-06-30 00:00:00")
    assert first == d("2014-06-09") and last == d("2014-06-30") and n == 4
    first, _, _ = monday_bounds("2014-06-02 00:00:00", "2014-06-30 00:00:00")
    assert first == d("2014-06-02")


def test_monday_midnight_edges(spark):
    facts = spark.createDataFrame([(1, ts("2014-06-02 00:00:00")), (2, ts("2014-06-02 00:00:01")),
                                   (3, ts("2014-06-01 23:59:59"))], "i int, u timestamp_ntz")
    out = hop_explode(facts, "u", every_monday("2014-06-01 00:00:00", "2014-06-10 00:00:00"), Span(days=7))
    got = sorted((r.i, r.as_of) for r in out.collect())
    assert got == [(1, d("2014-06-02")), (1, d("2014-06-09")), (2, d("2014-06-09")), (3, d("2014-06-02"))]


def test_trailing_edges_month_clamp(spark):
    # 2016-02-29 - 1 year = 2015-02-28; 2014-05-31 - 3 months = 2014-02-28 (not Mondays themselves,
    # so check through brute force on Mondays around them)
    rows = [(1, ts("2015-02-28 00:00:00")), (2, ts("2015-02-27 23:59:59")), (3, ts("2014-02-28 00:00:00")),
            (4, ts("2015-02-23 00:00:00")), (5, ts("2016-02-22 00:00:00"))]
    facts = spark.createDataFrame(rows, "i int, u timestamp_ntz")
    for span in (YEAR, QUARTER, Span.weeks(8)):
        mondays = every_monday("2014-01-01 00:00:00", "2016-12-31 00:00:00")
        got = {(r.i, r.as_of) for r in hop_explode(facts, "u", mondays, span).collect()}
        all_m = [r.as_of for r in monday_frame(spark, "2014-01-01 00:00:00", "2016-12-31 00:00:00").collect()]
        assert got == brute(rows, all_m, span)


def test_random_against_theta_join(spark):
    rnd = random.Random(7)
    base = dt.datetime(2013, 1, 1)
    rows = []
    for i in range(400):
        u = base + dt.timedelta(days=rnd.randrange(0, 1100))
        if rnd.random() < 0.5:
            u += dt.timedelta(seconds=rnd.randrange(0, 86400))
        rows.append((i, u))
    facts = spark.createDataFrame(rows, "i int, u timestamp_ntz")
    cal = spark.createDataFrame([(r[1].date(),) for r in rows], "utc_date_only date")
    for span in (YEAR, QUARTER, Span.weeks(4)):
        mondays = calendar_mondays(cal, "2013-06-01 00:00:00", "2015-06-01 00:00:00")
        listed = [r.as_of for r in mondays.df.collect()]
        got = {(r.i, r.as_of) for r in hop_explode(facts, "u", mondays, span).collect()}
        assert got == brute(rows, listed, span)


def test_trailing_distinct_runs_match_brute_force(spark):
    from cadence.operators.windows import trailing_distinct
    rnd = random.Random(11)
    base = dt.datetime(2013, 1, 1)
    rows = []
    for i in range(600):
        u = base + dt.timedelta(days=rnd.randrange(0, 1100))
        if rnd.random() < 0.5:
            u += dt.timedelta(seconds=rnd.randrange(0, 86400))
        rows.append((i, rnd.randrange(8), u))
    # month ends, leap day and Monday midnights
    for u in ["2014-02-28 00:00:00", "2014-05-31 13:00:00", "2016-02-29 00:00:00", "2015-02-28 10:00:00",
              "2014-06-02 00:00:00", "2014-01-31 00:00:00", "2014-08-31 23:59:59"]:
        rows.append((len(rows), 3, ts(u)))
    facts = spark.createDataFrame(rows, "i int, c int, u timestamp_ntz")
    cal = spark.createDataFrame([(r[2].date(),) for r in rows], "utc_date_only date")
    for span in (YEAR, QUARTER, Span(months=1), Span.weeks(8)):
        for mondays in (every_monday("2013-06-01 00:00:00", "2016-06-01 00:00:00"),
                        calendar_mondays(cal, "2013-06-01 00:00:00", "2016-06-01 00:00:00")):
            listed = ([r.as_of for r in mondays.df.collect()] if mondays.df is not None else
                      [r.as_of for r in monday_frame(spark, "2013-06-01 00:00:00", "2016-06-01 00:00:00").collect()])
            want = {(c, m) for (i, m) in brute([(i, u) for i, c, u in rows], listed, span)
                    for c in [rows[i][1]]}
            got = [(r.c, r.as_of) for r in trailing_distinct(facts, ["c"], "u", mondays, span).collect()]
            assert len(got) == len(set(got))          # no duplicates from overlapping runs
            assert set(got) == want
