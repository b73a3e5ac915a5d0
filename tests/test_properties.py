"""Properties from the test strategy: window splitting, idempotence, nesting,
and the skew guards being planned."""

import random

from pyspark.sql import functions as F

import __spark_entry__ as E
from cadence.functions.timefn import QUARTER
from cadence.operators.dedup import pick_per_key
from cadence.operators.hop import every_monday
from cadence.operators.windows import threshold_rollup
from cadence.plans import bugs
from cadence.sources.readers import Sources
from cadence.sources.sinks import Warehouse
from dates import ts
from source_rows import bug_sources

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_split_window_gives_same_raw_facts(spark, scratch):
    src = Sources(spark, frames=bug_sources(spark))
    whole = Warehouse(spark, scratch + "/whole")
    whole.insert_new(bugs.RAW, bugs.raw_facts(src, "2014-06-01 00:00:00", "2014-06-04 00:00:00"), bugs.RAW_KEY)
    parts = Warehouse(spark, scratch + "/parts")
    # adjacent windows share their end point; the key dedup absorbs the overlap
    for lo, hi in [("2014-06-01 00:00:00", "2014-06-01 11:00:00"), ("2014-06-01 11:00:00", "2014-06-04 00:00:00")]:
        parts.insert_new(bugs.RAW, bugs.raw_facts(src, lo, hi), bugs.RAW_KEY)
    cols = bugs.RAW_KEY
    a = sorted(tuple(r) for r in whole.table(bugs.RAW).select(*cols).collect())
    b = sorted(tuple(r) for r in parts.table(bugs.RAW).select(*cols).collect())
    assert a == b and len(a) == 9


def test_is_new_at_most_once_per_contributor_and_date(spark):
    df = E.queries()["active_is_new"](spark, SF)
    per = df.groupBy("contributor_key", "c_date").agg(F.sum("is_new").alias("n"), F.count("*").alias("rows"))
    assert per.where((F.col("n") > 1) | ((F.col("n") == 1) & (F.col("rows") > 1))).count() == 0
    # a contributor is new at most once within any trailing year: check consecutive new dates
    news = sorted((r.contributor_key, r.c_date) for r in df.where(F.col("is_new") == 1).collect())
    for (c1, d1), (c2, d2) in zip(news, news[1:]):
        if c1 == c2:
            assert (d2 - d1).days > 365


def test_higher_threshold_rows_are_subset(spark):
    rnd = random.Random(3)
    rows = [(rnd.randrange(6), "x", f"b{rnd.randrange(4)}", ts(f"2014-0{rnd.randrange(3, 7)}-{rnd.randrange(1, 28):02d} "
                                                          f"{rnd.randrange(24):02d}:00:00")) for _ in range(300)]
    facts = spark.createDataFrame(rows, "c long, k string, canonical string, t timestamp_ntz")
    out = threshold_rollup(facts, ["c", "k", "canonical"], "t", every_monday("2014-05-01 00:00:00",
                                                                            "2014-06-30 00:00:00"),
                           QUARTER, [3, 6], canon="canonical", concat="repeat").collect()
    low = {(r.c, r.canonical, r.as_of) for r in out if r.threshold == 3}
    high = {(r.c, r.canonical, r.as_of) for r in out if r.threshold == 6}
    assert high and high <= low


def test_partial_top_k_planned_for_dedup_and_salted_heads_for_capped_lists(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], "k long, v string, o int")
    plan = _plan(pick_per_key(df, ["k"], ["o"]))
    assert "WindowGroupLimit" in plan and "Partial" in plan
    # whatever the session's settings: values are spread over salts before a group's head is cut
    plan = _plan(E.queries()["edits_year"](spark, SF))
    assert "_salt" in plan


def test_hop_join_to_monday_list_is_broadcast(spark):
    plan = _plan(E.queries()["triage_quarter"](spark, SF))
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
