"""The weekly job from its state: what it reads and rewrites, late, replaced and withdrawn facts."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from cadence.functions.timefn import YEAR, date_key
from cadence.operators.hop import every_monday
from cadence.plans import aggregate
from cadence.plans.snapshot import SNAPSHOT_KEY, active_snapshot, flag_new
from cadence.sources.sinks import Warehouse
from dates import d, ts

SCHEMA = "contributor_key long, conversion_key long, team_key long, source_key long, canonical string, utc_datetime timestamp_ntz"
KEY = ["contributor_key", "conversion_key", "canonical", "utc_datetime"]
MONDAYS = [d("2014-06-02") + dt.timedelta(days=7 * i) for i in range(6)]


def dims(spark):
    t = spark.createDataFrame
    return (t([(1, "active"), (2, "casual"), (3, "active")], "conversion_key long, contributor_level string"),
            t([(1, "t"), (2, "u")], "team_key long, team_name string"), t([(1, "s")], "source_key long, source_name string"))


def rows(n, seed):
    r = random.Random(seed)
    out = []
    for i in range(n):
        day = dt.datetime(2013, 5, 20) + dt.timedelta(days=r.randrange(430), seconds=r.choice([0, r.randrange(86400)]))
        out.append((r.randrange(12), r.randrange(1, 4), r.randrange(1, 3), 1, f"c{i}", day))
    return out


def warehouse(spark, root):
    wh = Warehouse(spark, root)
    wh.insert_new("utc_date_only", spark.createDataFrame([(m,) for m in MONDAYS], "utc_date_only date"), ["utc_date_only"])
    return wh


def store(wh, facts):
    wh.insert_new("contributor_facts", facts.withColumn("utc_date_key", date_key(F.to_date("utc_datetime"))), KEY, partition_by=["utc_date_key"])


def expected(spark, facts):
    new = active_snapshot(facts, *dims(spark), every_monday(f"{MONDAYS[0]} 00:00:00", f"{MONDAYS[-1]} 00:00:00"))
    return sorted(map(tuple, flag_new(new, YEAR).select(*SNAPSHOT_KEY, "is_new").collect()))


def got(wh):
    return sorted(map(tuple, wh.table(aggregate.ACTIVE).select(*SNAPSHOT_KEY, "is_new").collect()))


def week(wh, spark, m):
    return aggregate.run(wh, f"{m} 00:00:00", f"{m} 00:00:00", *dims(spark))


def test_weekly_runs_in_and_out_of_order(spark, scratch):
    facts = spark.createDataFrame(rows(160, 1), SCHEMA)
    want = expected(spark, facts)
    for k, order in enumerate((MONDAYS, MONDAYS[::-1], [MONDAYS[i] for i in (3, 0, 5, 1, 4, 2)])):
        wh = warehouse(spark, os.path.join(scratch, str(k)))
        store(wh, facts)
        for m in order:
            week(wh, spark, m)
        assert got(wh) == want
    assert aggregate.refresh_weeks(wh, every_monday(f"{MONDAYS[0]} 00:00:00", f"{MONDAYS[-1]} 00:00:00")) == []


def test_a_week_reads_the_weeks_that_changed(spark, scratch, monkeypatch):
    wh = warehouse(spark, scratch)
    early = [r for r in rows(160, 2) if r[5] < dt.datetime(2014, 6, 30)]
    store(wh, spark.createDataFrame(early, SCHEMA))
    for m in MONDAYS[:5]:
        week(wh, spark, m)
    listed = []
    plain = Warehouse._rows
    monkeypatch.setattr(Warehouse, "_rows", lambda self, name, entry, parts: listed.extend(parts if name == "contributor_facts" else []) or plain(self, name, entry, parts))
    late = [(50, 1, 1, 1, "x", ts("2014-07-01 10:00:00"))]
    store(wh, spark.createDataFrame(late, SCHEMA))
    listed.clear()
    assert week(wh, spark, MONDAYS[5]) == [f"c_date={MONDAYS[5]}"]
    assert set(listed) == {"utc_date_key=20140701"}
    # a late fact of an old week: that week alone is read, and the Mondays it counts for are written once more
    store(wh, spark.createDataFrame([(51, 1, 1, 1, "y", ts("2013-09-04 10:00:00"))], SCHEMA))
    listed.clear()
    aggregate.run(wh, f"{MONDAYS[0]} 00:00:00", f"{MONDAYS[-1]} 00:00:00", *dims(spark))
    assert all("utc_date_key=20130901" < p < "utc_date_key=20130910" for p in listed) and "utc_date_key=20130904" in listed
    assert got(wh) == expected(spark, spark.createDataFrame(early + late + [(51, 1, 1, 1, "y", ts("2013-09-04 10:00:00"))], SCHEMA))


def test_withdrawn_and_replaced_facts_change_the_state(spark, scratch):
    wh = warehouse(spark, scratch)
    store(wh, spark.createDataFrame([(1, 1, 1, 1, "a", ts("2014-05-28 10:00:00")), (2, 1, 1, 1, "b", ts("2014-05-29 00:00:00"))], SCHEMA))
    mondays = every_monday("2014-06-02 00:00:00", "2014-06-02 00:00:00")
    week_of = lambda: sorted((r.contributor_key, r.team_key, r.week) for r in wh.table(aggregate.WEEKS).collect())
    assert aggregate.refresh_weeks(wh, mondays) == [MONDAYS[0]] and week_of() == [(1, 1, MONDAYS[0]), (2, 1, MONDAYS[0])]
    gone = spark.createDataFrame([("a", 20140528)], "canonical string, utc_date_key int")
    wh.exchange("contributor_facts", wh.table("contributor_facts").limit(0), gone, KEY, ["canonical"], ["utc_date_key"])
    assert aggregate.refresh_weeks(wh, mondays) == [MONDAYS[0]] and week_of() == [(2, 1, MONDAYS[0])]
    moved = spark.createDataFrame([(2, 1, 2, 1, "b", ts("2014-05-29 00:00:00"))], SCHEMA).withColumn("utc_date_key", F.lit(20140529))
    wh.upsert("contributor_facts", moved, KEY, partition_by=["utc_date_key"])
    assert aggregate.refresh_weeks(wh, mondays) == [MONDAYS[0]] and week_of() == [(2, 2, MONDAYS[0])]
    gone = spark.createDataFrame([("b", 20140529)], "canonical string, utc_date_key int")
    wh.exchange("contributor_facts", wh.table("contributor_facts").limit(0), gone, KEY, ["canonical"], ["utc_date_key"])
    assert aggregate.refresh_weeks(wh, mondays) == [MONDAYS[0]] and week_of() == []


def test_a_late_monday_rewrites_only_what_it_changes(spark, scratch):
    wh = warehouse(spark, scratch)
    # contributor 1 is seen from the second Monday on; 2 from the first one, loaded last
    store(wh, spark.createDataFrame([(1, 1, 1, 1, "a", ts("2014-06-05 10:00:00")), (2, 1, 1, 1, "b", ts("2014-05-30 10:00:00"))], SCHEMA))
    for m in MONDAYS[1:]:
        week(wh, spark, m)
    assert [x for x in got(wh) if x[4]] == [(1, MONDAYS[1], "t", "s", 1), (2, MONDAYS[1], "t", "s", 1)]
    # the first Monday makes 2 new there and no longer on the second; the other Mondays stay as they are
    assert sorted(week(wh, spark, MONDAYS[0])) == [f"c_date={m}" for m in MONDAYS[:2]]
    assert [x for x in got(wh) if x[4]] == [(1, MONDAYS[1], "t", "s", 1), (2, MONDAYS[0], "t", "s", 1)]
    assert week(wh, spark, MONDAYS[0]) == [] and week(wh, spark, MONDAYS[3]) == []
