"""Catalog part 4: whole jobs. Each query runs a topic's ``run`` over two overlapping
windows into a warehouse of its own (under the session's checkpoint folder) and
returns the stored conversions under natural names; the oracle states the names as text.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.functions.timefn import date_key
from cadence.operators.dims import calendar
from cadence.operators.hop import every_monday
from cadence.operators.joins import dealt
from cadence.plans import aggregate, bugs, hosting, reports, support
from cadence.plans import catalog_jobs as J
from cadence.plans.registry import ORACLE, register, table
from cadence.session import ensure_checkpoint_dir
from cadence.sources.sinks import Warehouse

W1, W2 = ("1997-01-01 00:00:00", "1997-02-15 00:00:00"), ("1997-02-10 00:00:00", "1997-03-31 00:00:00")


def scratch_warehouse(spark: SparkSession) -> Warehouse:
    return Warehouse(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/warehouses/{uuid.uuid4().hex}")


def _dim(spark: SparkSession, key: str, name: str, values: list[str]) -> DataFrame:
    return spark.createDataFrame([(i + 1, v) for i, v in enumerate(values)], f"{key} long, {name} string")


def _named(wh: Warehouse, conversion: DataFrame, source: DataFrame, team: DataFrame) -> DataFrame:
    """Stored conversions with names for keys."""
    return (wh.table("contributor_facts").join(dealt(wh.table("contributor")), "contributor_key")
            .join(conversion, "conversion_key").join(source, "source_key", "left").join(team, "team_key", "left")
            .select("email", "conversion_desc", "source_name", "team_name", "canonical", "utc_datetime", "cnt", "utc_date_key"))


# ------------------------------------------------------------------ bug tracker

BUG_CONVERSIONS = ["Filing a bug NATION_3", "Creating bug tracker account", "Filing a bug", "Submitting patch",
                   "Having patch be approved", "Change product 1 bug", "Change component 1 bug", "Change status 1 bug",
                   "Comment 1 bug"]


# The job stores one attachment of a key: of the first window that has it, the first by e-mail and patch flag.
_STORED_ATTACHMENTS = f"""att AS (SELECT attach_id AS attachment_key, ispatch FROM attachments
        WHERE modification_time BETWEEN TIMESTAMP '{W1[0]}' AND TIMESTAMP '{W2[1]}'
           OR creation_ts BETWEEN TIMESTAMP '{W1[0]}' AND TIMESTAMP '{W2[1]}'
        QUALIFY row_number() OVER (PARTITION BY attach_id ORDER BY
          CASE WHEN modification_time BETWEEN TIMESTAMP '{W1[0]}' AND TIMESTAMP '{W1[1]}'
                 OR creation_ts BETWEEN TIMESTAMP '{W1[0]}' AND TIMESTAMP '{W1[1]}' THEN 0 ELSE 1 END,
          'user' || submitter_id || '@example.org', ispatch) = 1),
f AS ("""
_BEFORE, _, _REST = ORACLE["bug_job_conversions"].partition("att AS (")


@register("bug_job_run", f"""
WITH found AS ({_BEFORE}{_STORED_ATTACHMENTS}{_REST.partition("f AS (")[2]})
SELECT DISTINCT 'user' || contributor_key || '@example.org' AS email,
       CASE conversion_key WHEN 1 THEN 'Filing a bug NATION_3' WHEN 2 THEN 'Creating bug tracker account'
         WHEN 3 THEN 'Filing a bug' WHEN 4 THEN 'Submitting patch' WHEN 5 THEN 'Having patch be approved'
         WHEN 6 THEN 'Change product 1 bug' WHEN 7 THEN 'Change component 1 bug' WHEN 8 THEN 'Change status 1 bug'
         WHEN 9 THEN 'Comment 1 bug' END AS conversion_desc,
       'bugs' AS source_name, n.n_name AS team_name, canonical, utc_datetime, cnt, utc_date_key
FROM found LEFT JOIN nation n ON n.n_nationkey + 100 = found.team_key AND n.n_regionkey = 1""")
def q_bug_job_run(spark, d):
    wh, src = scratch_warehouse(spark), J.bug_sources(spark, d)
    conversion, source = _dim(spark, "conversion_key", "conversion_desc", BUG_CONVERSIONS), _dim(spark, "source_key", "source_name", ["bugs"])
    team = J._teams(spark, d)
    for lo, hi in (W1, W2):
        bugs.run(wh, src, lo, hi, conversion, source, team, names=J.NAMES)
    return _named(wh, conversion, source, team)


# Offsets (UTC minus local time, in hours) of a source two hours ahead of UTC and of one eight hours behind it.
ZONE_HOURS = (-2, 8)
ZONE_WINDOWS = [("1997-03-01 00:00:00", "1997-03-31 00:00:00"), ("1997-01-01 00:00:00", "1997-02-01 00:00:00"),
                ("1997-02-01 00:00:00", "1997-03-01 00:00:00")]
_FILED = ["Filing a bug NATION_3", "Creating bug tracker account", "Filing a bug", "Change product 1 bug", "Change component 1 bug",
          "Change status 1 bug", "Comment 1 bug"]


def _zone_sql(hours: int) -> str:
    raw = J._RAW_SQL.partition("facts AS (")[0].rstrip().rstrip(",")
    raw = raw.replace("longdescs l", "notes l")
    return f"""
SELECT * FROM (WITH {J._SOURCES_SQL},
notes AS (SELECT l_orderkey AS bug_id, l_suppkey AS who, l_shipdate + to_hours(l_linenumber * 5) AS bug_when FROM lineitem), {raw},
facts AS (SELECT contributor_email AS email, local_datetime + to_hours({hours}) AS utc_datetime, fields, bug_id, product FROM raw),
firsts AS (SELECT bug_id, min(utc_datetime) AS first_ts FROM facts WHERE fields = 'comment' GROUP BY bug_id),
f AS (SELECT facts.*, first_ts IS NOT NULL AS first FROM facts
      LEFT JOIN firsts ON firsts.bug_id = facts.bug_id AND first_ts = utc_datetime),
rows AS (SELECT *, unnest([CASE WHEN first AND product = 'NATION_3' THEN 'Filing a bug NATION_3' END,
    CASE WHEN fields = 'Creating bug tracker account' THEN fields END, CASE WHEN first THEN 'Filing a bug' END,
    CASE WHEN contains(fields, 'product') THEN 'Change product 1 bug' END, CASE WHEN contains(fields, 'component') THEN 'Change component 1 bug' END,
    CASE WHEN contains(fields, 'bug_status') THEN 'Change status 1 bug' END, CASE WHEN fields = 'comment' THEN 'Comment 1 bug' END]) AS conversion_desc FROM f)
SELECT DISTINCT {hours} AS zone_hours, email, conversion_desc, 'https://bugs.example.org/show_bug.cgi?id=' || bug_id AS canonical, utc_datetime, 1 AS cnt,
       CAST(strftime(utc_datetime, '%Y%m%d') AS INTEGER) AS utc_date_key FROM rows WHERE conversion_desc IS NOT NULL)"""


@register("bug_job_zone", "\nUNION ALL ".join(_zone_sql(h) for h in ZONE_HOURS))
def q_bug_job_zone(spark, d):
    """Sources ahead of UTC and behind it, loaded by three windows, the latest first: first comments move twice."""
    out = None
    for hours in ZONE_HOURS:
        wh, src = scratch_warehouse(spark), J.bug_sources(spark, d)
        li = table(spark, d, "lineitem")
        later = F.make_dt_interval(F.lit(0), (F.col("l_linenumber") * 5).cast("int"))
        src.frames["longdescs"] = li.select(F.col("l_orderkey").alias("bug_id"), F.col("l_suppkey").alias("who"), (F.col("l_shipdate") + later).alias("bug_when"))
        src.frames["attachments"] = src["attachments"].where(F.lit(False))
        conversion, source = _dim(spark, "conversion_key", "conversion_desc", _FILED), _dim(spark, "source_key", "source_name", ["bugs"])
        for lo, hi in ZONE_WINDOWS:
            bugs.run(wh, src, lo, hi, conversion, source, J._teams(spark, d), names=J.NAMES, offset=dt.timedelta(hours=hours))
        rows = _named(wh, conversion, source, J._teams(spark, d)).select(
            F.lit(hours).alias("zone_hours"), "email", "conversion_desc", "canonical", "utc_datetime", "cnt", "utc_date_key")
        out = rows if out is None else out.unionByName(rows)
    return out


TRIAGE = ["Change status 1 bug", "Comment 1 bug", "Change product 1 bug", "Change component 1 bug",
          *[f"Help triage {n} bugs per quarter" for n in (10, 25, 50, 100)]]
_TRIAGE_SQL = "\nUNION ALL ".join(f"""
SELECT substr(repeat(canonical || ',', CAST(count(*) AS INTEGER)), 1, CAST(count(*) AS INTEGER) * (length(canonical) + 1) - 1) AS canonical,
       max(utc_datetime) AS utc_datetime, contributor_key, 'Help triage {n} bugs per quarter' AS conversion_desc
FROM f JOIN mondays m ON f.utc_datetime BETWEEN CAST(m.d AS TIMESTAMP) - INTERVAL 3 MONTH AND CAST(m.d AS TIMESTAMP)
GROUP BY contributor_key, single, f.canonical, m.d HAVING count(*) >= {n}""" for n in (10, 25, 50, 100))


@register("triage_job", f"""
WITH f AS (SELECT l_suppkey % 2 AS contributor_key, l_linenumber AS single, l_shipdate AS utc_datetime,
                  'bug-' || (CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_orderkey % 20 END) AS canonical
           FROM lineitem WHERE l_linenumber BETWEEN 1 AND 4),
mondays AS (SELECT CAST(x AS DATE) AS d FROM range(TIMESTAMP '1997-01-06', TIMESTAMP '1997-04-01', INTERVAL 7 DAY) t(x))
{_TRIAGE_SQL}""")
def q_triage_job(spark, d):
    li = table(spark, d, "lineitem").where(F.col("l_linenumber").between(1, 4))
    bug = F.when(F.col("l_orderkey") % 3 == 0, 0).otherwise(F.col("l_orderkey") % 20)
    facts = li.select((F.col("l_suppkey") % 2).alias("contributor_key"), F.col("l_linenumber").cast("long").alias("conversion_key"),
                      F.col("l_shipdate").alias("utc_datetime"), F.concat(F.lit("bug-"), bug).alias("canonical"),
                      F.lit(1).cast("long").alias("source_key"), F.lit(0).cast("long").alias("team_key"))
    conversion = _dim(spark, "conversion_key", "conversion_desc", TRIAGE)
    rows = bugs.triage_thresholds(facts, conversion, every_monday(J.JOB_LO, J.JOB_HI), names=J.NAMES)
    return rows.join(conversion, "conversion_key").select("canonical", "utc_datetime", "contributor_key", "conversion_desc")


_DISTINCT_SQL = "\nUNION ALL ".join(f"""
SELECT string_agg(canonical, ',' ORDER BY t0, canonical) AS canonical, max(t1) AS utc_datetime, contributor_key, 'Help triage {n} bugs per quarter' AS conversion_desc
FROM firsts GROUP BY contributor_key, d HAVING count(*) >= {n}""" for n in (10, 25, 50, 100))


@register("triage_distinct_job", f"""
WITH f AS (SELECT l_suppkey % 40 AS contributor_key, l_shipdate AS utc_datetime, 'bug-' || (l_orderkey % 90) AS canonical
           FROM lineitem WHERE l_linenumber BETWEEN 1 AND 4),
mondays AS (SELECT CAST(x AS DATE) AS d FROM range(TIMESTAMP '1997-01-06', TIMESTAMP '1997-04-01', INTERVAL 7 DAY) t(x)),
firsts AS (SELECT contributor_key, m.d, canonical, min(utc_datetime) AS t0, max(utc_datetime) AS t1
           FROM f JOIN mondays m ON f.utc_datetime BETWEEN CAST(m.d AS TIMESTAMP) - INTERVAL 3 MONTH AND CAST(m.d AS TIMESTAMP) GROUP BY ALL)
{_DISTINCT_SQL}""")
def q_triage_distinct_job(spark, d):
    """N distinct bugs of a contributor in a quarter, by any of the four actions."""
    li = table(spark, d, "lineitem").where(F.col("l_linenumber").between(1, 4))
    facts = li.select((F.col("l_suppkey") % 40).alias("contributor_key"), F.col("l_linenumber").cast("long").alias("conversion_key"),
                      F.col("l_shipdate").alias("utc_datetime"), F.concat(F.lit("bug-"), F.col("l_orderkey") % 90).alias("canonical"),
                      F.lit(1).cast("long").alias("source_key"), F.lit(0).cast("long").alias("team_key"))
    conversion = _dim(spark, "conversion_key", "conversion_desc", TRIAGE)
    rows = bugs.triage_thresholds(facts, conversion, every_monday(J.JOB_LO, J.JOB_HI), names=J.NAMES, distinct_bugs=True)
    return rows.join(conversion, "conversion_key").select("canonical", "utc_datetime", "contributor_key", "conversion_desc")


# ------------------------------------------------------------------ code hosting

_HOST_RAW = f"""
acts AS (
  SELECT CASE WHEN event_type <> 'error' THEN 'user' || user_id || '@example.org' END AS email,
         'https://code.example.org/c/' || event_id AS canonical, ts AS local_datetime,
         'org' || (user_id % 5) AS org, 'repo-' || (user_id % 12) AS repo, user_id, event_id, props,
         CASE WHEN event_type = 'purchase' THEN 'pull-request-opened'
              WHEN event_type = 'click' THEN 'commit-author' ELSE event_type END AS action
  FROM events WHERE ts BETWEEN TIMESTAMP '{J.HOST_LO}' AND TIMESTAMP '{J.HOST_HI}'),
raw AS (SELECT * FROM acts WHERE email IS NOT NULL)"""


@register("hosting_job_facts", f"""
WITH {_HOST_RAW}
SELECT email, local_datetime AS utc_datetime, canonical, action,
       CASE WHEN org = 'org0' THEN 'unknown' ELSE org END AS org, CASE WHEN repo = 'repo-11' THEN 'unknown' ELSE repo END AS repo,
       CAST(strftime(local_datetime, '%Y%m%d') AS INTEGER) AS utc_date_key
FROM raw""")
def q_hosting_job_facts(spark, d):
    """Facts of an organisation and a repository that the dims lack take the unknown member 0."""
    raw = hosting.extract_activity(J.hosting_sources(spark, d), J.HOST_LO, J.HOST_HI)
    people = table(spark, d, "events").select(F.col("user_id").alias("contributor_key")).distinct()
    people = people.select("contributor_key", F.concat(F.lit("user"), "contributor_key", F.lit("@example.org")).alias("email"))
    cal = calendar(raw.select(F.to_date("local_datetime").alias("utc_date_only")))
    org = J._numbered_dim(raw, "extra_github_org", "github_org_key", "github_org_name").where("github_org_name != 'org0'")
    repo = J._numbered_dim(raw, "extra_github_repo", "github_repo_key", "github_repo_name").where("github_repo_name != 'repo-11'")
    unknown = spark.createDataFrame([(0, "unknown")], "k long, n string")
    facts = hosting.conform_facts(raw, people, cal, org, repo).join(people, "contributor_key")
    return facts.join(org.union(unknown), "github_org_key").join(repo.union(unknown), "github_repo_key").select(
        "email", "utc_datetime", "canonical", "action", F.col("github_org_name").alias("org"), F.col("github_repo_name").alias("repo"), "utc_date_key")


@register("hosting_job_run", f"""
WITH {_HOST_RAW}
SELECT email, CASE action WHEN 'pull-request-opened' THEN 'Submitting patch' ELSE 'Having patch be merged' END AS conversion_desc,
       'hosting' AS source_name, CASE WHEN repo IN ('repo-0', 'repo-1') THEN 'Mobile' WHEN repo = 'repo-2' THEN 'Web' END AS team_name,
       canonical, local_datetime AS utc_datetime, 1 AS cnt, CAST(strftime(local_datetime, '%Y%m%d') AS INTEGER) AS utc_date_key
FROM raw WHERE action IN ('pull-request-opened', 'commit-author')""")
def q_hosting_job_run(spark, d):
    wh, src = scratch_warehouse(spark), J.hosting_sources(spark, d)
    conversion = _dim(spark, "conversion_key", "conversion_desc", ["Submitting patch", "Having patch be merged"])
    source, team = _dim(spark, "source_key", "source_name", ["hosting"]), _dim(spark, "team_key", "team_name", ["Mobile", "Web"])
    mapping = spark.createDataFrame(J.HOST_REPO_TEAMS, "team_name string, repo_name string")
    for lo, hi in ((J.HOST_LO, "2024-01-15 00:00:00"), ("2024-01-14 00:00:00", J.HOST_HI)):
        hosting.run(wh, src, lo, hi, conversion, source, team, mapping, J.HOSTING_NAMES)
    return _named(wh, conversion, source, team)


# ------------------------------------------------------------------ field reports

def _four_sql(lo: str, hi: str) -> str:
    return f"""
SELECT u.email, '4 in 4 weeks', string_agg(canonical, ',' ORDER BY utc_datetime, canonical), max(utc_datetime), max_by(utc_date_key, utc_datetime)
FROM f JOIN users u ON u.id = f.contributor_key
WHERE utc_datetime BETWEEN TIMESTAMP '{lo}' - INTERVAL 28 DAY AND TIMESTAMP '{hi}' GROUP BY u.email HAVING count(*) >= 4"""


@register("reports_job_run", "WITH" + J._REPORTS_SQL + f""",
f AS (SELECT DISTINCT * FROM rfacts),
-- the second window does not see reports after its end, nor the first one those after its own
rows AS (
SELECT u.email, '1 in 8 weeks' AS conversion_desc, canonical, utc_datetime, utc_date_key FROM f JOIN users u ON u.id = f.contributor_key
UNION ALL SELECT u.email, '1 in 4 weeks', canonical, utc_datetime, utc_date_key FROM f JOIN users u ON u.id = f.contributor_key
UNION ALL {_four_sql(*W1)}
UNION ALL {_four_sql(*W2)})
SELECT DISTINCT email, conversion_desc, CAST(NULL AS VARCHAR) AS source_name, 'Field reports' AS team_name, canonical, utc_datetime,
       1 AS cnt, utc_date_key FROM rows""")
def q_reports_job_run(spark, d):
    wh, src = scratch_warehouse(spark), J.report_sources(spark, d)
    conversion = _dim(spark, "conversion_key", "conversion_desc", ["1 in 8 weeks", "1 in 4 weeks", "4 in 4 weeks"])
    source, team = _dim(spark, "source_key", "source_name", ["reports"]), _dim(spark, "team_key", "team_name", ["Field reports"])
    for lo, hi in (W1, W2):
        reports.run(wh, src, lo, hi, conversion, source, team, J.REP_NAMES)
    return _named(wh, conversion, source, team)


# ------------------------------------------------------------------ support site

SUPPORT_CONVERSIONS = ["Creating support account", "edit 1 article in KB", "l10n 1 KB article", "edit 5 articles in kb",
                       "l10n 5 KB articles", "4 answers on forum", "10 answers on forum"]


def _account_sql(lo: str, hi: str) -> str:
    return f"""
  SELECT left(string_agg(canonical, ',' ORDER BY utc_datetime, canonical), 65000) AS canonical, min(utc_datetime) AS utc_datetime,
         contributor_key, 'Creating support account' AS conversion_desc
  FROM sfacts WHERE utc_datetime BETWEEN TIMESTAMP '{lo}' AND TIMESTAMP '{hi}' GROUP BY contributor_key"""


def _yearly_sql(rows: str, n: int, name: str) -> str:
    return f"""
  SELECT left(string_agg(x.canonical, ',' ORDER BY x.utc_datetime, x.canonical), 65000), max(x.utc_datetime), x.contributor_key, '{name}'
  FROM {rows} x JOIN mondays m ON x.utc_datetime BETWEEN CAST(m.d AS TIMESTAMP) - INTERVAL 1 YEAR AND CAST(m.d AS TIMESTAMP)
  GROUP BY x.contributor_key, m.d HAVING count(*) >= {n}"""


@register("support_job_run", "WITH" + J._SUPPORT_SOURCES_SQL + "," + J._SUPPORT_FACTS_SQL + f""",
mondays AS (SELECT DISTINCT CAST(utc_datetime AS DATE) AS d FROM sfacts WHERE dayofweek(utc_datetime) = 1
            AND CAST(CAST(utc_datetime AS DATE) AS TIMESTAMP) BETWEEN TIMESTAMP '{W1[0]}' AND TIMESTAMP '{W2[1]}'),
kb AS (SELECT DISTINCT canonical, utc_datetime, contributor_key FROM sfacts WHERE action = 'kb'),
l10n AS (SELECT DISTINCT canonical, utc_datetime, contributor_key FROM sfacts WHERE action = 'localization'),
answers AS (SELECT canonical, utc_datetime, contributor_key FROM (SELECT DISTINCT * FROM sfacts) WHERE action = 'forum answer'),
rows AS ({_account_sql(*W1)} UNION ALL {_account_sql(*W2)}
  UNION ALL SELECT *, 'edit 1 article in KB' FROM kb UNION ALL SELECT *, 'l10n 1 KB article' FROM l10n
  UNION ALL {_yearly_sql("kb", 5, "edit 5 articles in kb")} UNION ALL {_yearly_sql("l10n", 5, "l10n 5 KB articles")}
  UNION ALL {_yearly_sql("answers", 4, "4 answers on forum")} UNION ALL {_yearly_sql("answers", 10, "10 answers on forum")})
SELECT DISTINCT 'user' || contributor_key || '@example.org' AS email, conversion_desc, 'support' AS source_name, 'Support' AS team_name,
       canonical, utc_datetime, 1 AS cnt, CAST(strftime(utc_datetime, '%Y%m%d') AS INTEGER) AS utc_date_key FROM rows""")
def q_support_job_run(spark, d):
    wh, src = scratch_warehouse(spark), J.support_sources(spark, d)
    conversion = _dim(spark, "conversion_key", "conversion_desc", SUPPORT_CONVERSIONS)
    source, team = _dim(spark, "source_key", "source_name", ["support"]), _dim(spark, "team_key", "team_name", ["Support"])
    for lo, hi in (W1, W2):
        support.run(wh, src, lo, hi, conversion, source, team, J.SUPPORT_NAMES)
    return _named(wh, conversion, source, team)


# ------------------------------------------------------------------ weekly snapshot

@register("snapshot_job_run", ORACLE["active_is_new"])
def q_snapshot_job_run(spark, d):
    """The weekly job over two halves of the history, the later half first."""
    from cadence.plans.catalog import HIST_HI, HIST_LO, history_warehouse

    facts, conversion, team, source, cal = history_warehouse(spark, d)
    wh = scratch_warehouse(spark)
    facts.withColumn("utc_date_key", date_key(F.to_date("utc_datetime"))).write.parquet(wh.path("contributor_facts"))
    cal.write.parquet(wh.path("utc_date_only"))
    middle = "1996-12-30 00:00:00"
    for lo, hi in ((middle, HIST_HI), (HIST_LO, middle)):
        aggregate.run(wh, lo, hi, conversion, team, source)
    return wh.table(aggregate.ACTIVE)


@register("snapshot_job_late_facts", ORACLE["active_is_new"])
def q_snapshot_job_late_facts(spark, d):
    """The weekly job over facts that arrive late: the later half of them first, with its snapshot,
    then the earlier half. Only the weeks that changed are read again."""
    from cadence.plans.catalog import HIST_HI, HIST_LO, history_warehouse

    facts, conversion, team, source, cal = history_warehouse(spark, d)
    facts = facts.withColumn("utc_date_key", date_key(F.to_date("utc_datetime")))
    wh = scratch_warehouse(spark)
    wh.insert_new("utc_date_only", cal, ["utc_date_only"])
    middle = "1996-12-30 00:00:00"
    key = ["contributor_key", "conversion_key", "utc_datetime", "o_orderkey"]
    for half, windows in ((F.col("utc_datetime") >= F.lit(middle).cast("timestamp_ntz"), [(middle, HIST_HI)]),
                          (F.col("utc_datetime") < F.lit(middle).cast("timestamp_ntz"), [(HIST_LO, middle), (middle, HIST_HI)])):
        wh.insert_new("contributor_facts", facts.where(half), key, partition_by=["utc_date_key"])
        for lo, hi in windows:
            aggregate.run(wh, lo, hi, conversion, team, source)
    return wh.table(aggregate.ACTIVE)


@register("surrogate_keys", """
SELECT count(*) AS members, count(*) AS keys FROM (
  SELECT DISTINCT n.n_name, CASE WHEN s_suppkey % 2 = 0 THEN s_acctbal END AS a, CASE WHEN s_suppkey % 2 = 1 THEN s_acctbal END AS b
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey)""")
def q_surrogate_keys(spark, d):
    """Distinct members, half with a NULL in one place and half in another, and their distinct keys."""
    even = F.col("s_suppkey") % 2 == 0
    members = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("location_name"), F.when(even, F.col("s_acctbal")).alias("longitude"),
        F.when(~even, F.col("s_acctbal")).alias("latitude")).distinct()
    from cadence.operators.dims import add_members

    keyed = add_members(None, members, ["location_name", "longitude", "latitude"], "location_key")
    return keyed.agg(F.count(F.lit(1)).alias("members"), F.countDistinct("location_key").alias("keys"))


@register("capped_list_nulls", """
SELECT CASE WHEN l_suppkey % 5 <> 0 THEN l_suppkey END AS g,
       left(string_agg(CASE WHEN l_linenumber > 2 THEN l_returnflag || l_orderkey END, ',' ORDER BY l_shipdate, l_returnflag || l_orderkey), 40) AS canonical,
       count(*) AS n
FROM lineitem GROUP BY 1""")
def q_capped_list_nulls(spark, d):
    from cadence.operators.aggregates import group_ordered_list

    li = table(spark, d, "lineitem").select(
        F.when(F.col("l_suppkey") % 5 != 0, F.col("l_suppkey")).alias("g"), "l_shipdate",
        F.when(F.col("l_linenumber") > 2, F.concat("l_returnflag", F.col("l_orderkey").cast("string"))).alias("v"))
    return group_ordered_list(li, "g", "l_shipdate", "v", max_len=40, extra=[F.count(F.lit(1)).alias("n")])


@register("yearly_list_nulls", """
WITH f AS (SELECT CASE WHEN o_custkey % 7 <> 0 THEN o_custkey % 50 END AS g, o_orderdate AS t,
                  CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority || o_orderkey END AS v FROM orders),
mondays AS (SELECT CAST(x AS DATE) AS d FROM range(TIMESTAMP '1997-01-06', TIMESTAMP '1997-04-01', INTERVAL 7 DAY) t(x))
SELECT g, m.d AS as_of, count(*) AS cnt, max(t) AS utc_datetime, left(string_agg(v, ',' ORDER BY t, v), 60) AS canonical
FROM f JOIN mondays m ON f.t BETWEEN CAST(m.d AS TIMESTAMP) - INTERVAL 1 YEAR AND CAST(m.d AS TIMESTAMP)
GROUP BY g, m.d HAVING count(*) >= 4""")
def q_yearly_list_nulls(spark, d):
    from cadence.functions.timefn import YEAR
    from cadence.operators.windows import threshold_rollup

    o = table(spark, d, "orders").select(
        F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey") % 50).alias("g"), F.col("o_orderdate").alias("t"),
        F.when(F.col("o_orderstatus") != "P", F.concat("o_orderpriority", F.col("o_orderkey").cast("string"))).alias("v"))
    return threshold_rollup(o, ["g"], "t", every_monday(J.JOB_LO, J.JOB_HI), YEAR, [4], canon="v", max_len=60).select(
        "g", "as_of", "cnt", "utc_datetime", "canonical")
