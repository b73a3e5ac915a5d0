"""Catalog part 2: first-event flag, rule conversions, trailing windows,
thresholds as seen each Monday, and first-seen aggregation."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadence.functions.text import concat_strict
from cadence.functions.timefn import QUARTER, YEAR, Span, date_key
from cadence.operators.aggregates import group_ordered_list
from cadence.operators.dims import calendar
from cadence.operators.hop import calendar_mondays
from cadence.operators.joins import broadcast_bounded
from cadence.operators.windows import first_event_flag, threshold_rollup, trailing_window
from cadence.plans.conversions import convert
from cadence.plans.registry import NATION_ROWS, register, table
from cadence.sources.readers import windowed

EV_LO, EV_HI = "2024-01-08 00:00:00", "2024-01-21 00:00:00"
SQL_EV = f"TIMESTAMP '{EV_LO}' AND TIMESTAMP '{EV_HI}'"


# ------------------------------------------------------------ first event

FIRST_LO, FIRST_HI = "2024-01-01 00:00:00", "2024-01-03 00:00:00"
SQL_FIRST = f"TIMESTAMP '{FIRST_LO}' AND TIMESTAMP '{FIRST_HI}'"

def _event_facts(spark, d):
    """Events as bug facts: the bug is the ``props`` value, times cut to the hour
    so that several facts share the time of a first comment ('click')."""
    ev = table(spark, d, "events")
    return ev.select("event_id", F.col("user_id").alias("contributor_key"), F.col("props").alias("bug_id"),
                     F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("utc_datetime"),
                     F.col("event_type").alias("fields"))


_FIRST_SQL = f"""
WITH ev AS (SELECT event_id, user_id AS contributor_key, props AS bug_id,
                   date_trunc('hour', ts) AS utc_datetime, event_type AS fields FROM events),
f AS (SELECT bug_id, min(utc_datetime) AS first_ts FROM ev WHERE fields = 'click' GROUP BY bug_id
      HAVING bug_id IN (SELECT bug_id FROM ev WHERE fields = 'click' AND utc_datetime BETWEEN {SQL_FIRST})),
flagged AS (SELECT ev.*, CASE WHEN f.first_ts IS NOT NULL THEN 0 END AS comment_num
            FROM ev LEFT JOIN f ON ev.bug_id = f.bug_id AND ev.utc_datetime = f.first_ts)"""


def _flagged(spark, d):
    return first_event_flag(_event_facts(spark, d), "bug_id", "utc_datetime", F.col("fields") == "click",
                            FIRST_LO, FIRST_HI)


@register("first_event_flag", _FIRST_SQL + "\nSELECT * FROM flagged")
def q_first_event_flag(spark, d):
    return _flagged(spark, d)


def _bug_url(c):
    return concat_strict("https://example.org/show_bug?id=", F.col(c))


@register("file_first_item", _FIRST_SQL + f"""
SELECT 'https://example.org/show_bug?id=' || bug_id AS canonical, utc_datetime, 1 AS cnt,
       CAST(strftime(utc_datetime, '%Y%m%d') AS INTEGER) AS utc_date_key, contributor_key,
       'Filing a bug' AS conversion_desc
FROM flagged WHERE comment_num = 0 AND utc_datetime BETWEEN {SQL_FIRST}""")
def q_file_first_item(spark, d):
    rows = convert(_flagged(spark, d), {"Filing a bug": F.col("comment_num") == 0}, FIRST_LO, FIRST_HI)
    return rows.select(_bug_url("bug_id").alias("canonical"), "utc_datetime", "cnt",
                       date_key(F.to_date("utc_datetime")).alias("utc_date_key"), "contributor_key",
                       "conversion_desc")


@register("file_first_item_segment", _FIRST_SQL + f"""
SELECT 'https://example.org/show_bug?id=' || bug_id AS canonical, utc_datetime, 1 AS cnt,
       CAST(strftime(utc_datetime, '%Y%m%d') AS INTEGER) AS utc_date_key, contributor_key,
       'Filing a bug BUILDING' AS conversion_desc
FROM flagged LEFT JOIN customer c ON c.c_custkey = flagged.contributor_key
WHERE comment_num = 0 AND c.c_mktsegment = 'BUILDING' AND utc_datetime BETWEEN {SQL_FIRST}""")
def q_file_first_item_segment(spark, d):
    cust = table(spark, d, "customer").select(F.col("c_custkey"), F.col("c_mktsegment").alias("product_name"))
    facts = _flagged(spark, d).join(cust, F.col("contributor_key") == F.col("c_custkey"), "left")
    rows = convert(facts, {"Filing a bug BUILDING": (F.col("comment_num") == 0)
                           & (F.col("product_name") == "BUILDING")}, FIRST_LO, FIRST_HI)
    return rows.select(_bug_url("bug_id").alias("canonical"), "utc_datetime", "cnt",
                       date_key(F.to_date("utc_datetime")).alias("utc_date_key"), "contributor_key",
                       "conversion_desc")


# ------------------------------------------------------------ rule table

EVENT_RULES_SQL = [
    ("Creating account", "event_type = 'signup'"),
    ("Submitting patch", "event_type = 'purchase'"),
    ("Change status 1 bug", "regexp_matches(event_type, 'err')"),
    ("Comment 1 bug", "event_type = 'click'"),
    ("edit 1 article in KB", "event_type = 'view' AND value > 5"),
    ("l10n 1 KB article", "regexp_matches(props, '\"k\": 1[0-9]}')"),
]


def event_rules():
    et = F.col("event_type")
    return {
        "Creating account": et == "signup",
        "Submitting patch": et == "purchase",
        "Change status 1 bug": et.rlike("err"),
        "Comment 1 bug": et == "click",
        "edit 1 article in KB": (et == "view") & (F.col("value") > 5),
        "l10n 1 KB article": F.col("props").rlike('"k": 1[0-9]}'),
    }


@register("event_conversions", "\nUNION ALL\n".join(f"""
SELECT 'https://example.org/e/' || event_id AS canonical, ts AS utc_datetime, 1 AS cnt,
       CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS utc_date_key, user_id AS contributor_key,
       '{name}' AS conversion_desc
FROM events WHERE {cond} AND ts BETWEEN {SQL_EV}""" for name, cond in EVENT_RULES_SQL))
def q_event_conversions(spark, d):
    ev = table(spark, d, "events").withColumnRenamed("ts", "utc_datetime")
    rows = convert(ev, event_rules(), EV_LO, EV_HI)
    return rows.select(concat_strict("https://example.org/e/", F.col("event_id")).alias("canonical"),
                       "utc_datetime", "cnt", date_key(F.to_date("utc_datetime")).alias("utc_date_key"),
                       F.col("user_id").alias("contributor_key"), "conversion_desc")


# ------------------------------------------------------------ patches with team

@register("patch_with_team", """
WITH f AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_shipdate, l.l_suppkey, l.l_returnflag, l.l_linestatus,
         CASE WHEN p.p_size > 25 THEN 1 ELSE 0 END AS ispatch, n.n_name AS product_name
  FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey
  JOIN supplier s ON s.s_suppkey = l.l_suppkey JOIN nation n ON n.n_nationkey = s.s_nationkey
  WHERE l.l_shipdate BETWEEN TIMESTAMP '1997-01-01 00:00:00' AND TIMESTAMP '1997-12-31 00:00:00'),
team AS (SELECT n_nationkey + 1 AS team_key, n_name AS team_name FROM nation WHERE n_regionkey = 1),
rows AS (SELECT *, 'Submitting patch' AS conversion_desc FROM f WHERE ispatch = 1
         UNION ALL
         SELECT *, 'Having patch be approved' FROM f
         WHERE ispatch = 1 AND l_returnflag = 'R' AND l_linestatus = 'F')
SELECT 'item/' || l_orderkey || '/' || l_linenumber AS canonical, l_shipdate AS utc_datetime, 1 AS cnt,
       l_suppkey AS contributor_key, conversion_desc, CAST(coalesce(team.team_key, 0) AS BIGINT) AS team_key
FROM rows LEFT JOIN team ON team.team_name = rows.product_name""")
def q_patch_with_team(spark, d):
    li = windowed(table(spark, d, "lineitem"), "l_shipdate", "1997-01-01 00:00:00", "1997-12-31 00:00:00")
    part = table(spark, d, "part").select("p_partkey", F.when(F.col("p_size") > 25, 1).otherwise(0).alias("ispatch"))
    nation = table(spark, d, "nation")
    sup = (table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
           .join(broadcast_bounded(nation.select("n_nationkey", F.col("n_name").alias("product_name")),
                                   known_rows=NATION_ROWS),
                 F.col("s_nationkey") == F.col("n_nationkey")))
    facts = (li.join(part, F.col("p_partkey") == F.col("l_partkey"), "left")
             .join(sup, F.col("s_suppkey") == F.col("l_suppkey")))
    patch = F.col("ispatch") == 1
    rows = convert(facts, {
        "Submitting patch": patch,
        "Having patch be approved": patch & (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"),
    }, ts="l_shipdate")
    team = broadcast_bounded(nation.where(F.col("n_regionkey") == 1)
                             .select((F.col("n_nationkey") + 1).alias("_tk"), F.col("n_name").alias("_tn")),
                             known_rows=NATION_ROWS)
    rows = rows.join(team, F.col("product_name") == F.col("_tn"), "left")
    return rows.select(concat_strict("item/", F.col("l_orderkey"), "/", F.col("l_linenumber")).alias("canonical"),
                       F.col("l_shipdate").alias("utc_datetime"), "cnt", F.col("l_suppkey").alias("contributor_key"),
                       "conversion_desc", F.coalesce(F.col("_tk"), F.lit(0)).cast("long").alias("team_key"))


# ------------------------------------------------------------ item log thresholds

def _item_log(spark, d):
    li = table(spark, d, "lineitem")
    part = table(spark, d, "part").select("p_partkey", "p_type")
    return li.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_suppkey").alias("contributor_key"), F.col("l_returnflag").alias("conversion_key"),
        F.col("p_type").alias("canonical"), F.col("l_shipdate").alias("utc_datetime"),
        "l_orderkey", "l_linenumber", "l_linestatus", "l_quantity")


def _item_mondays(spark, d, lo, hi):
    cal = calendar(table(spark, d, "lineitem").select(F.to_date("l_shipdate").alias("utc_date_only")))
    return calendar_mondays(cal, lo, hi)


def _mondays_sql(lo, hi):
    return f"""cal AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem),
mondays AS (SELECT d FROM cal WHERE dayofweek(d) = 1
            AND CAST(d AS TIMESTAMP) BETWEEN TIMESTAMP '{lo}' AND TIMESTAMP '{hi}')"""


_ITEM_SQL = """item AS (SELECT l.l_suppkey AS contributor_key, l.l_returnflag AS conversion_key,
                   p.p_type AS canonical, l.l_shipdate AS utc_datetime, l.l_orderkey, l.l_linenumber,
                   l.l_linestatus, l.l_quantity
            FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)"""

TRIAGE_LO, TRIAGE_HI = "1998-01-01 00:00:00", "1998-12-31 00:00:00"
TRIAGE_THRESHOLDS = (2, 3, 5)
TRIAGE_KINDS = ("A", "R")   # the single-action conversions a triage counts


@register("triage_quarter", f"""
WITH {_mondays_sql(TRIAGE_LO, TRIAGE_HI)}, {_ITEM_SQL},
g AS (SELECT f.contributor_key, f.conversion_key, f.canonical AS c, m.d AS as_of, count(*) AS cnt,
             max(f.utc_datetime) AS utc_datetime, string_agg(f.canonical, ',') AS canonical
      FROM item f JOIN mondays m
        ON f.utc_datetime BETWEEN CAST(m.d AS TIMESTAMP) - INTERVAL 3 MONTH AND CAST(m.d AS TIMESTAMP)
      WHERE f.conversion_key IN ('A', 'R')
      GROUP BY f.contributor_key, f.conversion_key, f.canonical, m.d)
SELECT contributor_key, conversion_key, canonical, as_of, cnt, utc_datetime, t.threshold
FROM g JOIN (VALUES (2), (3), (5)) t(threshold) ON g.cnt >= t.threshold""")
def q_triage_quarter(spark, d):
    facts = _item_log(spark, d).where(F.col("conversion_key").isin(*TRIAGE_KINDS))
    out = threshold_rollup(facts, ["contributor_key", "conversion_key", "canonical"], "utc_datetime",
                           _item_mondays(spark, d, TRIAGE_LO, TRIAGE_HI), QUARTER, TRIAGE_THRESHOLDS,
                           canon="canonical", concat="repeat")
    return out.select("contributor_key", "conversion_key", "canonical", "as_of", "cnt", "utc_datetime", "threshold")


@register("triage_quarter_distinct", f"""
WITH {_mondays_sql(TRIAGE_LO, TRIAGE_HI)}, {_ITEM_SQL},
w AS (SELECT f.*, m.d AS as_of FROM item f JOIN mondays m
        ON f.utc_datetime BETWEEN CAST(m.d AS TIMESTAMP) - INTERVAL 3 MONTH AND CAST(m.d AS TIMESTAMP)
      WHERE f.conversion_key IN ('A', 'R')),
g AS (SELECT contributor_key, conversion_key, as_of, count(DISTINCT canonical) AS cnt,
             max(utc_datetime) AS utc_datetime FROM w GROUP BY ALL),
firsts AS (SELECT contributor_key, conversion_key, as_of, canonical, min(utc_datetime) AS t0 FROM w GROUP BY ALL),
lists AS (SELECT contributor_key, conversion_key, as_of, string_agg(canonical, ',' ORDER BY t0, canonical) AS canonical
          FROM firsts GROUP BY ALL)
SELECT g.contributor_key, g.conversion_key, lists.canonical, g.as_of, g.cnt, g.utc_datetime, t.threshold
FROM g JOIN lists USING (contributor_key, conversion_key, as_of)
JOIN (VALUES (2), (3), (5)) t(threshold) ON g.cnt >= t.threshold""")
def q_triage_quarter_distinct(spark, d):
    facts = _item_log(spark, d).where(F.col("conversion_key").isin(*TRIAGE_KINDS))
    out = threshold_rollup(facts, ["contributor_key", "conversion_key"], "utc_datetime",
                           _item_mondays(spark, d, TRIAGE_LO, TRIAGE_HI), QUARTER, TRIAGE_THRESHOLDS,
                           canon="canonical", concat="list", distinct_of="canonical")
    return out.select("contributor_key", "conversion_key", "canonical", "as_of", "cnt", "utc_datetime", "threshold")


TRAIL_LO, TRAIL_HI = "1998-03-01 00:00:00", "1998-03-31 00:00:00"


def _trailing_rows(spark, d, weeks, name):
    f = trailing_window(_item_log(spark, d), "utc_datetime", TRAIL_LO, TRAIL_HI, Span.weeks(weeks))
    return f.select(concat_strict("item/", F.col("l_orderkey"), "/", F.col("l_linenumber")).alias("canonical"),
                    "utc_datetime", F.lit(1).alias("cnt"), "contributor_key",
                    F.lit(name).alias("conversion_desc"), F.lit("Field").alias("team_name"))


def _trailing_sql(weeks, name):
    return f"""
SELECT 'item/' || l_orderkey || '/' || l_linenumber AS canonical, l_shipdate AS utc_datetime, 1 AS cnt,
       l_suppkey AS contributor_key, '{name}' AS conversion_desc, 'Field' AS team_name
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
WHERE l_shipdate BETWEEN TIMESTAMP '{TRAIL_LO}' - INTERVAL {weeks * 7} DAY AND TIMESTAMP '{TRAIL_HI}'"""


@register("trailing_8w", _trailing_sql(8, "1 in 8 weeks"))
def q_trailing_8w(spark, d):
    return _trailing_rows(spark, d, 8, "1 in 8 weeks")


@register("trailing_4w", _trailing_sql(4, "1 in 4 weeks"))
def q_trailing_4w(spark, d):
    return _trailing_rows(spark, d, 4, "1 in 4 weeks")


@register("four_in_4w", f"""
WITH r AS ({_trailing_sql(4, "1 in 4 weeks")})
SELECT contributor_key, count(*) AS cnt, max(utc_datetime) AS utc_datetime,
       string_agg(canonical, ',' ORDER BY utc_datetime, canonical) AS canonical,
       '4 in 4 weeks' AS conversion_desc
FROM r GROUP BY contributor_key HAVING count(*) >= 4""")
def q_four_in_4w(spark, d):
    rows = _trailing_rows(spark, d, 4, "1 in 4 weeks")
    g = group_ordered_list(rows, "contributor_key", "utc_datetime", "canonical",
                           extra=[F.count(F.lit(1)).alias("cnt"), F.max("utc_datetime").alias("utc_datetime")])
    return g.where(F.col("cnt") >= 4).withColumn("conversion_desc", F.lit("4 in 4 weeks"))


# ------------------------------------------------------------ first seen

ACCOUNT_CANON_LEN = 200


@register("account_first_seen", f"""
SELECT user_id AS contributor_key,
       left(string_agg('https://example.org/e/' || event_id, ',' ORDER BY ts, 'https://example.org/e/' || event_id),
            {ACCOUNT_CANON_LEN}) AS canonical,
       min(ts) AS utc_datetime, 1 AS cnt, min(CAST(strftime(ts, '%Y%m%d') AS INTEGER)) AS utc_date_key,
       'Creating account' AS conversion_desc
FROM events WHERE ts BETWEEN {SQL_EV} GROUP BY user_id""")
def q_account_first_seen(spark, d):
    ev = windowed(table(spark, d, "events"), "ts", EV_LO, EV_HI).select(
        F.col("user_id").alias("contributor_key"), F.col("ts").alias("utc_datetime"),
        concat_strict("https://example.org/e/", F.col("event_id")).alias("canonical"))
    g = group_ordered_list(ev, "contributor_key", "utc_datetime", "canonical", max_len=ACCOUNT_CANON_LEN,
                           extra=[F.min("utc_datetime").alias("utc_datetime"),
                                  F.min(date_key(F.to_date("utc_datetime"))).alias("utc_date_key")])
    return g.select("contributor_key", "canonical", "utc_datetime", F.lit(1).alias("cnt"), "utc_date_key",
                    F.lit("Creating account").alias("conversion_desc"))


# ------------------------------------------------------------ yearly thresholds

YEAR_LO, YEAR_HI = "1999-01-01 00:00:00", "1999-12-31 00:00:00"
YEAR_CANON_LEN = 120


def _year_sql(where, thresholds):
    vals = ", ".join(f"({t})" for t in thresholds)
    return f"""
WITH {_mondays_sql(YEAR_LO, YEAR_HI)}, {_ITEM_SQL},
f AS (SELECT contributor_key, 'item/' || l_orderkey || '/' || l_linenumber AS canonical, utc_datetime
      FROM item WHERE {where}),
g AS (SELECT f.contributor_key, m.d AS as_of, count(*) AS cnt, max(f.utc_datetime) AS utc_datetime,
             left(string_agg(f.canonical, ',' ORDER BY f.utc_datetime, f.canonical), {YEAR_CANON_LEN}) AS canonical
      FROM f JOIN mondays m
        ON f.utc_datetime BETWEEN CAST(m.d AS TIMESTAMP) - INTERVAL 1 YEAR AND CAST(m.d AS TIMESTAMP)
      GROUP BY f.contributor_key, m.d)
SELECT g.*, t.threshold FROM g JOIN (VALUES {vals}) t(threshold) ON g.cnt >= t.threshold"""


def _year_rollup(spark, d, cond, thresholds):
    f = _item_log(spark, d).where(cond).select(
        "contributor_key", "utc_datetime",
        concat_strict("item/", F.col("l_orderkey"), "/", F.col("l_linenumber")).alias("canonical"))
    out = threshold_rollup(f, ["contributor_key"], "utc_datetime", _item_mondays(spark, d, YEAR_LO, YEAR_HI),
                           YEAR, thresholds, canon="canonical", concat="list", max_len=YEAR_CANON_LEN)
    return out.select("contributor_key", "as_of", "cnt", "utc_datetime", "canonical", "threshold")


@register("edits_year", _year_sql("conversion_key = 'R' AND l_linestatus = 'F'", (5,)))
def q_edits_year(spark, d):
    return _year_rollup(spark, d, (F.col("conversion_key") == "R") & (F.col("l_linestatus") == "F"), (5,))


@register("answers_year", _year_sql("l_quantity > 45", (4, 10)))
def q_answers_year(spark, d):
    return _year_rollup(spark, d, F.col("l_quantity") > 45, (4, 10))
