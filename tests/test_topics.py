"""End-to-end runs of the topic jobs and the weekly snapshot on hand-written rows."""

from pyspark.sql import functions as F

from cadence.plans import aggregate, bugs, hosting, names as N, reports, support
from cadence.sources.readers import Sources
from cadence.sources.sinks import Warehouse
from dates import d, ts
from source_rows import (NAMES, bug_sources, conversion_dim, hosting_sources, report_sources, source_dim,
                         support_sources, team_dim)

LO, HI = "2014-06-01 00:00:00", "2014-06-02 00:00:00"


def facts_by_name(spark, wh):
    conv = conversion_dim(spark)
    cf = wh.table("contributor_facts").join(conv, "conversion_key")
    contributor = wh.table("contributor")
    return cf.join(contributor, "contributor_key")


def test_bug_topic(spark, scratch):
    wh = Warehouse(spark, scratch)
    src = Sources(spark, frames=bug_sources(spark))
    args = (conversion_dim(spark), source_dim(spark), team_dim(spark))
    bugs.run(wh, src, LO, HI, *args, triage_thresholds_list=(1, 2))
    bugs.run(wh, src, LO, HI, *args, triage_thresholds_list=(1, 2))        # re-run: nothing changes
    raw = wh.table(bugs.RAW)
    assert raw.count() == 4 + 2 + 2       # activity in window, comments, accounts
    facts = wh.table(bugs.FACTS)
    assert facts.count() == 8
    flagged = sorted((r.bug_id, r.fields) for r in facts.where(F.col("comment_num") == 0).collect())
    # every fact at the first comment's time is flagged, the status change included
    assert flagged == [(100, "bug_status"), (100, "comment")]
    # the component name "DOM" exists once; unknown status / product stay NULL, component 0 when unknown
    acc = facts.where(F.col("fields") == NAMES.bug_account_action).collect()
    assert {(r.product_key, r.component_key, r.status_key) for r in acc} == {(None, 0, None)}
    got = facts_by_name(spark, wh)
    rows = sorted((r.conversion_desc, r.email, r.team_key) for r in got.collect()
                  if not r.conversion_desc.startswith("Help triage"))
    assert rows == sorted([
        (NAMES.file_featured_bug, "ann@x", 0), (NAMES.file_featured_bug, "bob@x", 0),
        (N.FILING_A_BUG, "ann@x", 0), (N.FILING_A_BUG, "bob@x", 0),
        (N.COMMENT_ONE, "ann@x", 0), (N.COMMENT_ONE, "bob@x", 0),
        (N.CHANGE_STATUS, "bob@x", 0),
        (NAMES.bug_account_action, "ann@x", 0), (NAMES.bug_account_action, "cy@x", 0),
        (N.SUBMITTING_PATCH, "bob@x", 0), (N.SUBMITTING_PATCH, "cy@x", 0), (N.SUBMITTING_PATCH, "cy@x", 0),
        # review+ only; review- and review? do not count
        (N.PATCH_APPROVED, "bob@x", 0),
    ])
    # no Monday in a Sunday-only window: no triage rows
    assert got.where(F.col("conversion_desc").startswith("Help triage")).count() == 0


def test_bug_triage_threshold(spark, scratch):
    wh = Warehouse(spark, scratch)
    src = Sources(spark, frames=bug_sources(spark))
    args = (conversion_dim(spark), source_dim(spark), team_dim(spark))
    # a window that reaches Monday 2014-06-02 00:00 (a calendar date via the Monday facts below)
    extra = spark.createDataFrame([(100, 1, ts("2014-06-02 00:00:00"))], "bug_id long, who long, bug_when timestamp_ntz")
    src.frames["longdescs"] = src["longdescs"].unionByName(extra)
    bugs.run(wh, src, LO, "2014-06-02 00:00:00", *args, triage_thresholds_list=(1, 2))
    tri = facts_by_name(spark, wh).where(F.col("conversion_desc").startswith("Help triage")).collect()
    got = sorted((r.conversion_desc, r.email, r.canonical) for r in tri)
    url = NAMES.bug_url + "100"
    # ann commented bug 100 twice (06-01 10:00 and Monday 00:00) -> reaches 2; bob once each kind
    assert (NAMES.triage(2), "ann@x", url + "," + url) in got
    assert (NAMES.triage(1), "bob@x", url) in got
    assert all(r[0] != NAMES.triage(2) or r[1] == "ann@x" for r in got)


def test_hosting_topic(spark, scratch):
    wh = Warehouse(spark, scratch)
    src = Sources(spark, frames=hosting_sources(spark))
    mapping = spark.createDataFrame([("Mobile", "mobile-app"), ("Ghost", "other-repo")], "team_name string, repo_name string")
    for _ in range(2):
        hosting.run(wh, src, LO, HI, conversion_dim(spark), source_dim(spark), team_dim(spark), mapping)
    raw = wh.table(hosting.RAW).collect()
    assert len(raw) == 2 and {len(r.extra_commit_msg) for r in raw} == {255, 3}
    assert {r.extra_github_username for r in raw} == {"dev", "dev@x"}
    got = sorted((r.conversion_desc, r.team_key) for r in facts_by_name(spark, wh).collect())
    # the team named in the mapping but missing from the team dim gives NULL
    assert got == [(N.PATCH_MERGED, None), (N.SUBMITTING_PATCH, 3)]


def test_reports_topic(spark, scratch):
    wh = Warehouse(spark, scratch)
    src = Sources(spark, frames=report_sources(spark))
    for _ in range(2):
        reports.run(wh, src, LO, HI, conversion_dim(spark), source_dim(spark), team_dim(spark))
    raw = wh.table(reports.RAW).collect()
    # report 1 reaches both profiles sharing its mentor
    assert sorted(r.email for r in raw) == ["ann@x", "bo@x"]
    assert {r.canonical for r in raw} == {"https://reports.example.org/u/ann/r/2014/June/1/1/",
                                          "https://reports.example.org/u/bo/r/2014/June/1/1/"}
    assert {(r.activity, r.campaign, r.contribution_area) for r in raw} == {("Talk", "Summer", "Coding")}
    got = sorted((r.conversion_desc, r.email, r.team_key) for r in facts_by_name(spark, wh).collect())
    assert got == [(N.ONE_IN_4_WEEKS, "ann@x", 4), (N.ONE_IN_4_WEEKS, "bo@x", 4),
                   (N.ONE_IN_8_WEEKS, "ann@x", 4), (N.ONE_IN_8_WEEKS, "bo@x", 4)]


def test_four_in_four_weeks(spark):
    rows = [(1, "r1", ts("2014-05-10 10:00:00")), (1, "r2", ts("2014-05-11 10:00:00")),
            (1, "r3", ts("2014-05-12 10:00:00")), (1, "r4", ts("2014-06-01 10:00:00")),
            (2, "s1", ts("2014-05-10 10:00:00")), (2, "s2", ts("2014-05-11 10:00:00")),
            (2, "s3", ts("2014-05-12 10:00:00")),
            (3, "t0", ts("2014-04-01 10:00:00")), (3, "t1", ts("2014-05-10 10:00:00")),
            (3, "t2", ts("2014-05-11 10:00:00")), (3, "t3", ts("2014-05-12 10:00:00"))]
    facts = spark.createDataFrame(rows, "contributor_key long, canonical string, utc_datetime timestamp_ntz") \
        .withColumn("utc_date_key", F.lit(20140601)).withColumn("source_key", F.lit(3).cast("long"))
    out = reports.four_in_four_weeks(facts, conversion_dim(spark), team_dim(spark), LO, HI).collect()
    assert [(r.contributor_key, r.canonical) for r in out] == [(1, "r1,r2,r3,r4")]


def test_support_topic(spark, scratch):
    wh = Warehouse(spark, scratch)
    src = Sources(spark, frames=support_sources(spark))
    for _ in range(2):
        support.run(wh, src, LO, HI, conversion_dim(spark), source_dim(spark), team_dim(spark))
    raw = wh.table(support.RAW)
    by_action = {a: n for a, n in raw.groupBy("action").count().collect()}
    # kb: en-US revisions (doc 70: 2 revisions x 2 products x 2 topics); l10n: locale != 'en_US' (de and en-US)
    assert by_action[N.SUPPORT_KB] == 8
    assert by_action[N.SUPPORT_L10N] == 8 + 1
    assert by_action[N.SUPPORT_FORUM_ANSWER] == 2 and by_action[NAMES.support_account_action] == 1
    got = facts_by_name(spark, wh)
    kb = got.where(F.col("conversion_desc") == N.EDIT_ONE_KB).collect()
    # event level: one row per revision (its product x topic copies share the stored key), not one folded row
    assert sorted(r.email for r in kb) == ["ann@x", "bob@x"]
    acct = {r.email: r.canonical for r in got.where(F.col("conversion_desc") == NAMES.support_account_action).collect()}
    # any support action counts as written: cy only answered on the forum
    assert set(acct) == {"ann@x", "bob@x", "cy@x"}
    assert acct["cy@x"] == ("https://support.example.org/questions/50#answer-900,"
                            "https://support.example.org/questions/51#answer-901")


def test_support_account_action_filter(spark, scratch):
    wh = Warehouse(spark, scratch)
    src = Sources(spark, frames=support_sources(spark))
    support.run(wh, src, LO, HI, conversion_dim(spark), source_dim(spark), team_dim(spark),
                account_action=NAMES.support_account_action)
    acct = facts_by_name(spark, wh).where(F.col("conversion_desc") == NAMES.support_account_action).collect()
    assert [r.email for r in acct] == ["ann@x"]


def test_snapshot_job(spark, scratch):
    wh = Warehouse(spark, scratch)
    conv, src_dim, teams = conversion_dim(spark), source_dim(spark), team_dim(spark)
    bsrc = Sources(spark, frames=bug_sources(spark))
    extra = spark.createDataFrame([(100, 3, ts("2014-06-09 00:00:00"))], "bug_id long, who long, bug_when timestamp_ntz")
    bsrc.frames["longdescs"] = bsrc["longdescs"].unionByName(extra)
    bugs.run(wh, bsrc, LO, "2014-06-09 00:00:00", conv, src_dim, teams, triage_thresholds_list=(50,))
    # Mondays given in reverse order give the same flags
    aggregate.run(wh, "2014-06-09 00:00:00", "2014-06-09 00:00:00", conv, teams, src_dim)
    aggregate.run(wh, "2014-06-02 00:00:00", "2014-06-02 00:00:00", conv, teams, src_dim)
    aggregate.run(wh, "2014-06-02 00:00:00", "2014-06-09 00:00:00", conv, teams, src_dim)
    snap = wh.table("contributor_active").join(wh.table("contributor"), "contributor_key")
    got = sorted((r.email, r.c_date, r.is_new) for r in snap.collect())
    assert got == [("ann@x", d("2014-06-09"), 1), ("bob@x", d("2014-06-09"), 1), ("cy@x", d("2014-06-09"), 1)]
