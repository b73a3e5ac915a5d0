from pyspark.sql import functions as F

from cadence.functions.timefn import QUARTER, YEAR
from cadence.operators.aggregates import group_ordered_list
from cadence.operators.hop import every_monday
from cadence.operators.windows import first_event_flag, first_time_flag, threshold_rollup, trailing_distinct
from dates import d, ts

MON = "2014-06-30 00:00:00"


def _facts(spark, rows):
    return spark.createDataFrame(rows, "c long, k string, canonical string, t timestamp_ntz")


def test_threshold_one_bug_versus_many_bugs(spark):
    # person 1: 10 actions on one bug; person 2: one action on each of 10 bugs
    rows = [(1, "x", "bug/1", ts(f"2014-06-{10 + i:02d} 10:00:00")) for i in range(10)]
    rows += [(2, "x", f"bug/{i}", ts(f"2014-06-{10 + i:02d} 10:00:00")) for i in range(10)]
    facts = _facts(spark, rows)
    m = every_monday(MON, MON)
    as_written = threshold_rollup(facts, ["c", "k", "canonical"], "t", m, QUARTER, [10], canon="canonical",
                                  concat="repeat").collect()
    assert [(r.c, r.cnt) for r in as_written] == [(1, 10)]
    assert as_written[0].canonical == ",".join(["bug/1"] * 10)
    assert as_written[0].utc_datetime == ts("2014-06-19 10:00:00")
    distinct = threshold_rollup(facts, ["c", "k"], "t", m, QUARTER, [10], canon="canonical", concat="list",
                                distinct_of="canonical").collect()
    assert [(r.c, r.cnt) for r in distinct] == [(2, 10)]


def test_threshold_exact_n_and_nested(spark):
    rows = [(1, "x", f"b{i}", ts(f"2014-06-{10 + i:02d} 10:00:00")) for i in range(5)]   # exactly 5
    rows += [(2, "x", f"b{i}", ts(f"2014-06-{10 + i:02d} 10:00:00")) for i in range(4)]  # 4 = N - 1
    rows += [(3, "x", f"b{i}", ts(f"2014-05-{1 + i:02d} 10:00:00")) for i in range(30)]  # 30 meets both
    out = threshold_rollup(_facts(spark, rows), ["c"], "t", every_monday(MON, MON), YEAR, [5, 25],
                           canon="canonical", concat="list").collect()
    got = sorted((r.c, r.threshold) for r in out)
    assert got == [(1, 5), (3, 5), (3, 25)]


def test_threshold_concat_order_null_and_cut(spark):
    rows = [(1, "x", "bbb", ts("2014-06-10 10:00:00")), (1, "x", "aaa", ts("2014-06-10 10:00:00")),  # tie in time
            (1, "x", None, ts("2014-06-09 00:00:00")), (1, "x", "ccc", ts("2014-06-01 00:00:00"))]
    facts = _facts(spark, rows)
    full = threshold_rollup(facts, ["c"], "t", every_monday(MON, MON), YEAR, [1], canon="canonical",
                            concat="list").first()
    assert full.canonical == "ccc,aaa,bbb" and full.cnt == 4
    cut = threshold_rollup(facts, ["c"], "t", every_monday(MON, MON), YEAR, [1], canon="canonical",
                           concat="list", max_len=5).first()
    assert cut.canonical == "ccc,a"
    only_null = threshold_rollup(_facts(spark, [(1, "x", None, ts("2014-06-10 10:00:00"))]), ["c"], "t",
                                 every_monday(MON, MON), YEAR, [1], canon="canonical", concat="list").first()
    assert only_null.canonical is None


def test_group_ordered_list_cut(spark):
    rows = [(1, "x", f"v{i:03d}", ts(f"2014-06-01 00:{i:02d}:00")) for i in range(50)]
    g = group_ordered_list(_facts(spark, rows), "c", "t", "canonical", max_len=20,
                           extra=[F.count(F.lit(1)).alias("n")]).first()
    assert g.canonical == "v000,v001,v002,v003," and g.n == 50


def test_first_event_flag_all_facts_at_first_time(spark):
    rows = [(10, "comment", ts("2014-06-01 10:00:00"), None), (10, "bug_status", ts("2014-06-01 10:00:00"), None),
            (10, "comment", ts("2014-06-05 10:00:00"), None), (11, "bug_status", ts("2014-06-05 10:00:00"), None),
            (12, "comment", ts("2014-05-01 10:00:00"), None)]
    facts = spark.createDataFrame(rows, "bug long, fields string, t timestamp_ntz, comment_num int")
    out = first_event_flag(facts, "bug", "t", F.col("fields") == "comment", "2014-06-01 00:00:00",
                           "2014-06-30 00:00:00")
    got = sorted((r.bug, r.fields, str(r.t), r.comment_num) for r in out.collect())
    assert got == [(10, "bug_status", "2014-06-01 10:00:00", 0), (10, "comment", "2014-06-01 10:00:00", 0),
                   (10, "comment", "2014-06-05 10:00:00", None), (11, "bug_status", "2014-06-05 10:00:00", None),
                   (12, "comment", "2014-05-01 10:00:00", None)]   # bug 12 not commented in the window


def test_first_time_flag_two_teams_and_gap(spark):
    rows = [(1, d("2014-06-02"), "A"), (1, d("2014-06-02"), "B"),     # two teams on the first Monday
            (2, d("2013-01-07"), "A"), (2, d("2014-06-02"), "A"),     # gap over a year, active again
            (3, d("2014-05-26"), "A"), (3, d("2014-06-02"), "A")]
    snap = spark.createDataFrame(rows, "contributor_key long, c_date date, team_name string")
    got = {(r.contributor_key, r.c_date, r.team_name): r.is_new
           for r in first_time_flag(snap, "contributor_key", "c_date", YEAR).collect()}
    assert got[(1, d("2014-06-02"), "A")] == 0 and got[(1, d("2014-06-02"), "B")] == 0
    assert got[(2, d("2013-01-07"), "A")] == 1 and got[(2, d("2014-06-02"), "A")] == 1
    assert got[(3, d("2014-05-26"), "A")] == 1 and got[(3, d("2014-06-02"), "A")] == 0


def test_trailing_distinct_one_monday_equals_filter(spark):
    rows = [(1, "x", "a", ts("2013-06-30 00:00:00")), (1, "x", "a", ts("2013-06-29 23:59:59")),
            (2, "y", "a", ts("2014-06-30 00:00:00")), (3, "y", "a", ts("2014-06-30 00:00:01"))]
    snap = trailing_distinct(_facts(spark, rows), ["c", "k"], "t", every_monday(MON, MON), YEAR)
    assert sorted((r.c, r.k) for r in snap.collect()) == [(1, "x"), (2, "y")]


def test_threshold_runs_equal_explode_path(spark):
    import random
    from cadence.operators import windows as W
    from cadence.operators.hop import calendar_mondays
    from cadence.functions.timefn import Span
    rnd = random.Random(5)
    rows = []
    for i in range(900):
        day = rnd.randrange(0, 700)
        t = ts("2013-01-01 00:00:00") + __import__("datetime").timedelta(days=day,
                                                                          seconds=rnd.choice([0, rnd.randrange(86400)]))
        rows.append((rnd.randrange(5), "x", f"b{rnd.randrange(3)}", t))
    facts = _facts(spark, rows)
    cal = spark.createDataFrame([(r[3].date(),) for r in rows], "utc_date_only date")
    for span in (QUARTER, YEAR, Span.weeks(4)):
        for m in (every_monday("2013-03-01 00:00:00", "2014-10-01 00:00:00"),
                  calendar_mondays(cal, "2013-03-01 00:00:00", "2014-10-01 00:00:00")):
            fast = W.threshold_rollup(facts, ["c", "k", "canonical"], "t", m, span, [2, 4, 9], canon="canonical",
                                      concat="repeat")
            slow = W.threshold_rollup(facts, ["c", "k", "canonical"], "t", m, span, [2, 4, 9], canon="canonical",
                                      concat="repeat", method="explode")
            cols = ["c", "k", "canonical", "as_of", "cnt", "utc_datetime", "threshold"]
            a = sorted(tuple(r) for r in fast.select(*cols).collect())
            b = sorted(tuple(r) for r in slow.select(*cols).collect())
            assert a == b and len(a) > 0


def test_list_thresholds_prefiltered_equal_explode(spark):
    import datetime as _dt
    import random
    from cadence.operators import windows as W
    from cadence.functions.timefn import Span
    rnd = random.Random(9)
    rows = []
    for i in range(700):
        c = rnd.choice([0, 0, 0, 1, 2, 3, 4, 5, 6, 7])          # contributor 0 is hot
        t = ts("2013-01-01 00:00:00") + _dt.timedelta(days=rnd.randrange(0, 600),
                                                      seconds=rnd.choice([0, rnd.randrange(86400)]))
        rows.append((c, "x", rnd.choice([f"v{i:04d}", None]), t))
    facts = _facts(spark, rows)
    for span, cut in ((YEAR, 60), (QUARTER, None), (Span.weeks(6), 25)):
        m = every_monday("2013-02-01 00:00:00", "2014-08-01 00:00:00")
        a = W.threshold_rollup(facts, ["c"], "t", m, span, [3, 12], canon="canonical", concat="list", max_len=cut)
        b = W.threshold_rollup(facts, ["c"], "t", m, span, [3, 12], canon="canonical", concat="list", max_len=cut,
                               method="explode")
        cols = ["c", "as_of", "cnt", "utc_datetime", "canonical", "threshold"]
        ra = sorted(tuple(r) for r in a.select(*cols).collect())
        rb = sorted(tuple(r) for r in b.select(*cols).collect())
        assert ra == rb and len(ra) > 0
