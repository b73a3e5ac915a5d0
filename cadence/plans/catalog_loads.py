"""Catalog part 1: windowed scans, extracts, dimensions, conform, sinks, lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadence.functions.text import blank_if_null, concat_strict, left_chars, literal_contains, regex_contains
from cadence.functions.timefn import add_offset, between_ts, calendar_attributes, hours_offset, to_utc, ymd_month_name
from cadence.operators.conform import DimJoin, conform
from cadence.operators.dedup import insert_if_absent, replace_by_key
from cadence.operators.dims import calendar, distinct_members, map_attribute
from cadence.operators.hop import calendar_mondays
from cadence.operators.joins import broadcast_bounded, lookup_const, with_const_lookups
from cadence.operators.rules import set_where
from cadence.plans.registry import NATION_ROWS, REGION_ROWS, register, table
from cadence.sources.readers import copy_columns, window_any, windowed

EV_LO, EV_HI = "2024-01-08 00:00:00", "2024-01-21 00:00:00"
SQL_EV = f"TIMESTAMP '{EV_LO}' AND TIMESTAMP '{EV_HI}'"


def user_email(c):
    return concat_strict("user", F.col(c) if isinstance(c, str) else c, "@example.org")


def name_email(c):
    return concat_strict(F.lower(F.regexp_replace(F.col(c), "#", ".")), "@example.org")


def ev_offset():
    """Source offset of an event, in hours, from its user (a stand-in for the
    extract-time offset column)."""
    return hours_offset((F.col("user_id") % 24 - 12).cast("int"))


# ------------------------------------------------------------------ windows

@register("window_scan", f"""
SELECT event_id, ts, user_id, event_type FROM events WHERE ts BETWEEN {SQL_EV}""")
def q_window_scan(spark, d):
    return windowed(table(spark, d, "events"), "ts", EV_LO, EV_HI).select("event_id", "ts", "user_id", "event_type")


@register("window_or_scan", """
SELECT l.l_orderkey, l.l_linenumber, l.l_shipdate, o.o_orderdate
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE l.l_shipdate BETWEEN TIMESTAMP '1997-01-01 00:00:00' AND TIMESTAMP '1997-03-31 00:00:00'
   OR o.o_orderdate BETWEEN TIMESTAMP '1997-01-01 00:00:00' AND TIMESTAMP '1997-03-31 00:00:00'""")
def q_window_or_scan(spark, d):
    lo, hi = "1997-01-01 00:00:00", "1997-03-31 00:00:00"
    li, o = table(spark, d, "lineitem"), table(spark, d, "orders")
    j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return window_any(j, [("l_shipdate", lo, hi), ("o_orderdate", lo, hi)]) \
        .select("l_orderkey", "l_linenumber", "l_shipdate", "o_orderdate")


# ------------------------------------------------------------------ extracts

@register("extract_activity", f"""
SELECT lower(replace(c.c_name, '#', '.')) || '@example.org' AS email,
       'https://example.org/events/' || e.event_id AS canonical,
       e.ts AS local_datetime, e.event_type AS extra_github_org, e.props AS extra_github_repo,
       coalesce(d.source, lower(replace(c.c_name, '#', '.')) || '@example.org') AS extra_github_username,
       left(d.text, 255) AS extra_commit_msg, e.event_id AS extra_commit_id, e.event_type AS action
FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id
LEFT JOIN documents d ON d.doc_id = e.event_id
WHERE c.c_name IS NOT NULL AND e.ts BETWEEN {SQL_EV}""")
def q_extract_activity(spark, d):
    ev = windowed(table(spark, d, "events"), "ts", EV_LO, EV_HI)
    cust = table(spark, d, "customer").select("c_custkey", "c_name")
    docs = table(spark, d, "documents").select("doc_id", "source", "text")
    j = (ev.join(cust, F.col("c_custkey") == F.col("user_id"), "left")
         .join(docs, F.col("doc_id") == F.col("event_id"), "left")
         .where(F.col("c_name").isNotNull()))
    email = name_email("c_name")
    return j.select(email.alias("email"),
                    concat_strict("https://example.org/events/", F.col("event_id")).alias("canonical"),
                    F.col("ts").alias("local_datetime"), F.col("event_type").alias("extra_github_org"),
                    F.col("props").alias("extra_github_repo"),
                    F.coalesce(F.col("source"), email).alias("extra_github_username"),
                    left_chars("text", 255).alias("extra_commit_msg"),
                    F.col("event_id").alias("extra_commit_id"), F.col("event_type").alias("action"))


@register("extract_log_join", """
SELECT c.c_name AS contributor_email, l.l_shipdate AS local_datetime, l.l_returnflag AS fields,
       l.l_orderkey AS bug_id, l.l_linenumber AS attachment_id, o.o_orderstatus AS status,
       p.p_name AS product, n.n_name AS component
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN part p ON l.l_partkey = p.p_partkey
WHERE l.l_shipdate BETWEEN TIMESTAMP '1997-01-01 00:00:00' AND TIMESTAMP '1997-01-31 00:00:00'""")
def q_extract_log_join(spark, d):
    li = windowed(table(spark, d, "lineitem"), "l_shipdate", "1997-01-01 00:00:00", "1997-01-31 00:00:00")
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus")
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = broadcast_bounded(table(spark, d, "nation").select("n_nationkey", "n_name"), known_rows=NATION_ROWS)
    p = table(spark, d, "part").select("p_partkey", "p_name")
    j = (li.join(o, "l_orderkey")                                   # USING (key)
         .join(c, F.col("o_custkey") == F.col("c_custkey"))
         .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
         .join(p, F.col("l_partkey") == F.col("p_partkey")))
    return j.select(F.col("c_name").alias("contributor_email"), F.col("l_shipdate").alias("local_datetime"),
                    F.col("l_returnflag").alias("fields"), F.col("l_orderkey").alias("bug_id"),
                    F.col("l_linenumber").alias("attachment_id"), F.col("o_orderstatus").alias("status"),
                    F.col("p_name").alias("product"), F.col("n_name").alias("component"))


@register("extract_comment_log", """
SELECT cu.c_name AS contributor_email, c.conv_id AS bug_id, c.turn, 'comment' AS fields, o.o_orderstatus AS status,
       r.r_name AS product, n.n_name AS component, length(c.text) AS n_chars
FROM conversations c JOIN orders o ON c.conv_id = o.o_orderkey
JOIN customer cu ON o.o_custkey = cu.c_custkey
JOIN nation n ON cu.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey""")
def q_extract_comment_log(spark, d):
    cv = table(spark, d, "conversations")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = broadcast_bounded(table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey"),
                          known_rows=NATION_ROWS)
    r = broadcast_bounded(table(spark, d, "region").select("r_regionkey", "r_name"), known_rows=REGION_ROWS)
    j = (cv.join(o, F.col("conv_id") == F.col("o_orderkey"))
         .join(c, F.col("o_custkey") == F.col("c_custkey"))
         .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
         .join(r, F.col("n_regionkey") == F.col("r_regionkey")))
    return j.select(F.col("c_name").alias("contributor_email"), F.col("conv_id").alias("bug_id"), "turn",
                    F.lit("comment").alias("fields"), F.col("o_orderstatus").alias("status"),
                    F.col("r_name").alias("product"), F.col("n_name").alias("component"),
                    F.length("text").cast("long").alias("n_chars"))


@register("extract_account_rows", """
SELECT lower(replace(c_name, '#', '.')) || '@example.org' AS email, '' AS extra_locale, '' AS extra_topic,
       '' AS extra_product, 'https://example.org/user/' || c_name AS canonical,
       'Creating account' AS action, 0 AS extra_id
FROM customer""")
def q_extract_account_rows(spark, d):
    c = table(spark, d, "customer")
    return c.select(name_email("c_name").alias("email"), F.lit("").alias("extra_locale"),
                    F.lit("").alias("extra_topic"), F.lit("").alias("extra_product"),
                    concat_strict("https://example.org/user/", F.col("c_name")).alias("canonical"),
                    F.lit("Creating account").alias("action"), F.lit(0).alias("extra_id"))


@register("extract_left_chain_distinct", """
SELECT DISTINCT c.c_name AS email, CAST(o.o_orderdate AS DATE) AS report_date, o.o_orderdate AS local_datetime,
       coalesce(n.n_name, '') AS activity, coalesce(r.r_name, '') AS campaign,
       'https://example.org/u/' || c.c_name || '/r/' || strftime(o.o_orderdate, '%Y/%B/%-d') || '/'
         || o.o_orderkey || '/' AS canonical
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
WHERE c.c_name IS NOT NULL
  AND o.o_orderdate BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1996-12-31 00:00:00'""")
def q_extract_left_chain_distinct(spark, d):
    o = windowed(table(spark, d, "orders"), "o_orderdate", "1996-01-01 00:00:00", "1996-12-31 00:00:00")
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = broadcast_bounded(table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey"),
                          known_rows=NATION_ROWS)
    r = broadcast_bounded(table(spark, d, "region").select("r_regionkey", "r_name"), known_rows=REGION_ROWS)
    li = table(spark, d, "lineitem").select("l_orderkey")
    # The line-item join fans out but contributes no column: DISTINCT removes its
    # duplicates and the optimizer drops the join itself.
    j = (o.join(c, F.col("o_custkey") == F.col("c_custkey"), "left")
         .join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left")
         .join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left")
         .join(li, F.col("l_orderkey") == F.col("o_orderkey"), "left")
         .where(F.col("c_name").isNotNull()))
    canonical = concat_strict("https://example.org/u/", F.col("c_name"), "/r/", ymd_month_name("o_orderdate"),
                              "/", F.col("o_orderkey"), "/")
    return j.select(F.col("c_name").alias("email"), F.to_date("o_orderdate").alias("report_date"),
                    F.col("o_orderdate").alias("local_datetime"), blank_if_null("n_name").alias("activity"),
                    blank_if_null("r_name").alias("campaign"), canonical.alias("canonical")).distinct()


@register("extract_bridge_fanout", """
SELECT d.source || '@example.org' AS email, 'localization' AS action, d.lang AS extra_locale,
       'https://example.org/' || d.lang || '/kb/' || d.doc_id AS canonical,
       coalesce(p.p_name, '') AS extra_product, coalesce(s.s_name, '') AS extra_topic,
       lb.quality AS extra_question, d.doc_id AS extra_id
FROM documents d
LEFT JOIN labels lb ON lb.doc_id = d.doc_id
LEFT JOIN lineitem bp ON bp.l_orderkey = d.doc_id
LEFT JOIN part p ON p.p_partkey = bp.l_partkey
LEFT JOIN lineitem bt ON bt.l_orderkey = d.doc_id
LEFT JOIN supplier s ON s.s_suppkey = bt.l_suppkey
WHERE d.lang != 'en'""")
def q_extract_bridge_fanout(spark, d):
    docs = table(spark, d, "documents").where(F.col("lang") != "en").select("doc_id", "source", "lang")
    lb = table(spark, d, "labels").select(F.col("doc_id").alias("lb_doc"), "quality")
    li = table(spark, d, "lineitem")
    bridge_p = li.select(F.col("l_orderkey").alias("bp_doc"), F.col("l_partkey").alias("bp_part"))
    bridge_t = li.select(F.col("l_orderkey").alias("bt_doc"), F.col("l_suppkey").alias("bt_supp"))
    p = table(spark, d, "part").select("p_partkey", "p_name")
    s = table(spark, d, "supplier").select("s_suppkey", "s_name")
    # document x product x topic: both bridges fan out, and the duplicates are the result
    j = (docs.join(lb, F.col("lb_doc") == F.col("doc_id"), "left")
         .join(bridge_p, F.col("bp_doc") == F.col("doc_id"), "left")
         .join(p, F.col("p_partkey") == F.col("bp_part"), "left")
         .join(bridge_t, F.col("bt_doc") == F.col("doc_id"), "left")
         .join(s, F.col("s_suppkey") == F.col("bt_supp"), "left"))
    return j.select(concat_strict(F.col("source"), "@example.org").alias("email"),
                    F.lit("localization").alias("action"), F.col("lang").alias("extra_locale"),
                    concat_strict("https://example.org/", F.col("lang"), "/kb/", F.col("doc_id")).alias("canonical"),
                    blank_if_null("p_name").alias("extra_product"), blank_if_null("s_name").alias("extra_topic"),
                    F.col("quality").alias("extra_question"), F.col("doc_id").alias("extra_id"))


@register("union_extracts", f"""
SELECT 'user' || user_id || '@example.org' AS contributor_email, ts AS local_datetime, event_type AS fields,
       event_id AS bug_id, CAST(NULL AS VARCHAR) AS status
FROM events WHERE ts BETWEEN {SQL_EV}
UNION ALL
SELECT 'user' || o_custkey || '@example.org', o_orderdate, 'order', o_orderkey, o_orderstatus
FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1996-01-31 00:00:00'""")
def q_union_extracts(spark, d):
    ev = windowed(table(spark, d, "events"), "ts", EV_LO, EV_HI).select(
        user_email("user_id").alias("contributor_email"), F.col("ts").alias("local_datetime"),
        F.col("event_type").alias("fields"), F.col("event_id").alias("bug_id"))
    od = windowed(table(spark, d, "orders"), "o_orderdate", "1996-01-01 00:00:00", "1996-01-31 00:00:00").select(
        user_email("o_custkey").alias("contributor_email"), F.col("o_orderdate").alias("local_datetime"),
        F.lit("order").alias("fields"), F.col("o_orderkey").alias("bug_id"), F.col("o_orderstatus").alias("status"))
    return ev.unionByName(od, allowMissingColumns=True)


# ------------------------------------------------------------------ dimensions

@register("dim_full_copy", """
SELECT p_partkey AS component_key, p_type AS component_name, p_size AS product_key FROM part""")
def q_dim_full_copy(spark, d):
    return copy_columns(table(spark, d, "part"),
                        {"p_partkey": "component_key", "p_type": "component_name", "p_size": "product_key"})


@register("dim_distinct", f"""
SELECT DISTINCT 'user' || user_id || '@example.org' AS email FROM events WHERE ts BETWEEN {SQL_EV}""")
def q_dim_distinct(spark, d):
    ev = table(spark, d, "events").withColumn("email", user_email("user_id"))
    return distinct_members(ev, "email", ts="ts", lo=EV_LO, hi=EV_HI)


@register("dim_distinct_composite", """
SELECT DISTINCT p_brand AS location_name, p_type AS longitude, p_size AS latitude FROM part""")
def q_dim_distinct_composite(spark, d):
    return distinct_members(table(spark, d, "part"), ["p_brand", "p_type", "p_size"],
                            rename={"p_brand": "location_name", "p_type": "longitude", "p_size": "latitude"})


@register("dim_union_two_sources", f"""
SELECT 'user' || user_id || '@example.org' AS email FROM events WHERE ts BETWEEN {SQL_EV}
UNION
SELECT 'user' || o_custkey || '@example.org' FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1996-01-31 00:00:00'""")
def q_dim_union_two_sources(spark, d):
    a = distinct_members(table(spark, d, "events").withColumn("email", user_email("user_id")), "email",
                         ts="ts", lo=EV_LO, hi=EV_HI)
    b = distinct_members(table(spark, d, "orders").withColumn("email", user_email("o_custkey")), "email",
                         ts="o_orderdate", lo="1996-01-01 00:00:00", hi="1996-01-31 00:00:00")
    return a.union(b).distinct()


# Hand-kept (team, name) list for the mapping query; it plays the part of a
# maintained repository -> team sheet.
TEAM_LIST = [
    ("Metalwork", "blue anvil"), ("Metalwork", "cold anvil"), ("Metalwork", "hot anvil"),
    ("Fasteners", "blue bolt"), ("Fasteners", "red bolt"), ("Fasteners", "small bolt"),
    ("Gears", "new gear"), ("Gears", "old gear"), ("Jewelry", "red ring"),
]


def _team_list_sql() -> str:
    return ", ".join(f"('{t}', '{n}')" for t, n in TEAM_LIST)


@register("dim_map_team", f"""
SELECT r.repo_name, m.team_name
FROM (SELECT DISTINCT p_name AS repo_name FROM part) r
LEFT JOIN (VALUES {_team_list_sql()}) m(team_name, name) ON m.name = r.repo_name""")
def q_dim_map_team(spark, d):
    repos = distinct_members(table(spark, d, "part"), "p_name", rename={"p_name": "repo_name"})
    mapping = spark.createDataFrame(TEAM_LIST, "team_name string, name string")
    return map_attribute(repos, mapping, "repo_name", "name", "team_name")


_CAL_SQL = f"""
WITH d AS (SELECT DISTINCT CAST(ts + to_hours(user_id % 24 - 12) AS DATE) AS utc_date_only FROM events
           UNION SELECT CAST(o_orderdate AS DATE) FROM orders)
SELECT CAST(strftime(utc_date_only, '%Y%m%d') AS INTEGER) AS utc_date_key, utc_date_only,
       CAST(dayofweek(utc_date_only) + 1 AS INTEGER) AS dayOfWeek,
       CAST(strftime(utc_date_only, '%U') AS INTEGER) AS weekOfYear,
       CAST(month(utc_date_only) AS INTEGER) AS monthOfYear, CAST(year(utc_date_only) AS INTEGER) AS year
FROM d"""


@register("calendar_utc", _CAL_SQL)
def q_calendar_utc(spark, d):
    ev = table(spark, d, "events")
    dates = ev.select(F.to_date(add_offset("ts", ev_offset())).alias("utc_date_only")).unionByName(
        table(spark, d, "orders").select(F.to_date("o_orderdate").alias("utc_date_only")))
    return calendar(dates)


@register("mondays", """
SELECT DISTINCT CAST(o_orderdate AS DATE) AS as_of FROM orders
WHERE dayofweek(o_orderdate) = 1
  AND o_orderdate BETWEEN TIMESTAMP '1996-01-01 12:00:00' AND TIMESTAMP '1997-12-31 00:00:00'""")
def q_mondays(spark, d):
    cal = calendar(table(spark, d, "orders").select(F.to_date("o_orderdate").alias("utc_date_only")))
    # lower bound Monday 1996-01-01 12:00: that Monday is outside the window
    return calendar_mondays(cal, "1996-01-01 12:00:00", "1997-12-31 00:00:00").df


@register("utc_offset", """
SELECT event_id, ts AS local_datetime, ts + to_hours(user_id % 24 - 12) AS utc_datetime FROM events""")
def q_utc_offset(spark, d):
    ev = table(spark, d, "events")
    return ev.select("event_id", F.col("ts").alias("local_datetime"),
                     to_utc("ts", offset=ev_offset()).alias("utc_datetime"))


@register("utc_zone", """
SELECT o_orderkey, o_orderdate AS local_datetime,
       (o_orderdate AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' AS utc_datetime FROM orders""")
def q_utc_zone(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", F.col("o_orderdate").alias("local_datetime"),
                    to_utc("o_orderdate", tz="America/New_York").alias("utc_datetime"))


@register("utc_zone_hours", """
WITH l AS (SELECT l_orderkey, l_linenumber, l_shipdate + to_minutes(l_linenumber * 30) AS t FROM lineitem),
u AS (SELECT *, (t AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' AS u FROM l)
SELECT l_orderkey, l_linenumber, t AS local_datetime,
       CASE WHEN ((u - INTERVAL 1 HOUR) AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' = t THEN u - INTERVAL 1 HOUR ELSE u END AS utc_datetime
FROM u""")
def q_utc_zone_hours(spark, d):
    """Half hours of the night, clock changes included: an hour that the clock skips counts from before the
    change, of an hour that comes twice the first one is taken."""
    t = F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("l_linenumber") * 30)
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", t.alias("local_datetime"))
    return li.withColumn("utc_datetime", to_utc("local_datetime", tz="America/New_York"))


# ------------------------------------------------------------------ conform

@register("conform_left_default", f"""
WITH raw AS (
  SELECT 'user' || user_id || '@example.org' AS email, ts AS local_datetime,
         to_hours(user_id % 24 - 12) AS off, 'NATION_' || (user_id % 30) AS nation_name,
         CASE WHEN user_id % 2 = 0 THEN 'AMERICA' ELSE 'MOON' END AS region_name,
         event_type AS fields, 'https://example.org/show?id=' || event_id AS canonical
  FROM events WHERE ts BETWEEN {SQL_EV}),
cal AS (SELECT DISTINCT CAST(local_datetime + off AS DATE) AS d FROM raw)
SELECT c.c_custkey AS contributor_key, r.local_datetime + r.off AS utc_datetime,
       CAST(strftime(cal.d, '%Y%m%d') AS INTEGER) AS utc_date_key,
       coalesce(n.n_nationkey + 1, 0) AS nation_key, g.r_regionkey + 1 AS region_key, r.fields, r.canonical
FROM raw r JOIN customer c ON r.email = 'user' || c.c_custkey || '@example.org'
JOIN cal ON CAST(r.local_datetime + r.off AS DATE) = cal.d
LEFT JOIN nation n ON r.nation_name = n.n_name
LEFT JOIN region g ON r.region_name = g.r_name""")
def q_conform_left_default(spark, d):
    ev = windowed(table(spark, d, "events"), "ts", EV_LO, EV_HI)
    raw = ev.select(user_email("user_id").alias("email"), F.col("ts").alias("local_datetime"),
                    ev_offset().alias("tz_offset"),
                    concat_strict("NATION_", F.col("user_id") % 30).alias("nation_name"),
                    F.when(F.col("user_id") % 2 == 0, "AMERICA").otherwise("MOON").alias("region_name"),
                    F.col("event_type").alias("fields"),
                    concat_strict("https://example.org/show?id=", F.col("event_id")).alias("canonical"))
    utc = add_offset("local_datetime", "tz_offset")
    cal = calendar(raw.select(F.to_date(utc).alias("utc_date_only")))
    contributor = table(spark, d, "customer").select(F.col("c_custkey").alias("contributor_key"),
                                                     user_email("c_custkey").alias("email"))
    nation = table(spark, d, "nation").select((F.col("n_nationkey") + 1).alias("nation_key"), "n_name")
    region = table(spark, d, "region").select((F.col("r_regionkey") + 1).alias("region_key"), "r_name")
    return conform(raw, utc, [
        DimJoin(contributor, {"email": "email"}, {"contributor_key": "contributor_key"}, how="inner"),
        DimJoin(nation, {"nation_name": "n_name"}, {"nation_key": "nation_key"}, default={"nation_key": 0}),
        DimJoin(region, {"region_name": "r_name"}, {"region_key": "region_key"}),
    ], calendar=cal, select=["contributor_key", "utc_datetime", "utc_date_key", "nation_key", "region_key",
                             "fields", "canonical"])


@register("conform_composite_key", """
WITH dim AS (SELECT p_brand, p_type, p_size, min(p_partkey) + 1 AS location_key
             FROM part WHERE p_size <= 25 GROUP BY p_brand, p_type, p_size)
SELECT l.l_orderkey, l.l_linenumber, l.l_shipdate AS utc_datetime, coalesce(dim.location_key, 0) AS location_key
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
LEFT JOIN dim ON p.p_brand = dim.p_brand AND p.p_type = dim.p_type AND p.p_size = dim.p_size
WHERE l.l_shipdate BETWEEN TIMESTAMP '1997-01-01 00:00:00' AND TIMESTAMP '1997-03-31 00:00:00'""")
def q_conform_composite_key(spark, d):
    part = table(spark, d, "part")
    raw = (windowed(table(spark, d, "lineitem"), "l_shipdate", "1997-01-01 00:00:00", "1997-03-31 00:00:00")
           .join(part.select("p_partkey", "p_brand", "p_type", "p_size"), F.col("l_partkey") == F.col("p_partkey"))
           .select("l_orderkey", "l_linenumber", "l_shipdate", F.col("p_brand").alias("location"),
                   F.col("p_type").alias("lon"), F.col("p_size").alias("lat")))
    dim = (part.where(F.col("p_size") <= 25).groupBy("p_brand", "p_type", "p_size")
           .agg((F.min("p_partkey") + 1).alias("location_key")))
    return conform(raw, F.col("l_shipdate"), [
        DimJoin(dim, {"location": "p_brand", "lon": "p_type", "lat": "p_size"}, {"location_key": "location_key"},
                default={"location_key": 0}),
    ], select=["l_orderkey", "l_linenumber", "utc_datetime", "location_key"])


@register("conform_inner_dims", f"""
WITH raw AS (
  SELECT user_id, ts, event_type, event_id, 'NATION_' || (user_id % 30) AS product_name,
         CASE WHEN user_id % 3 = 0 THEN 'ASIA' WHEN user_id % 3 = 1 THEN 'EUROPE' ELSE 'NOWHERE' END AS topic_name
  FROM events WHERE ts BETWEEN {SQL_EV})
SELECT 1 AS cnt, c.c_custkey AS contributor_key,
       (r.ts AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' AS utc_datetime,
       n.n_nationkey AS product_key, g.r_regionkey AS topic_key, r.event_type AS action,
       'https://example.org/a/' || r.event_id AS canonical
FROM raw r JOIN customer c ON c.c_custkey = r.user_id
JOIN nation n ON n.n_name = r.product_name
JOIN region g ON g.r_name = r.topic_name""")
def q_conform_inner_dims(spark, d):
    ev = windowed(table(spark, d, "events"), "ts", EV_LO, EV_HI)
    raw = ev.select("user_id", "ts", F.col("event_type").alias("action"),
                    concat_strict("https://example.org/a/", F.col("event_id")).alias("canonical"),
                    concat_strict("NATION_", F.col("user_id") % 30).alias("product_name"),
                    F.when(F.col("user_id") % 3 == 0, "ASIA").when(F.col("user_id") % 3 == 1, "EUROPE")
                    .otherwise("NOWHERE").alias("topic_name"))
    cust = table(spark, d, "customer").select(F.col("c_custkey").alias("contributor_key"))
    nation = table(spark, d, "nation").select(F.col("n_nationkey").alias("product_key"), "n_name")
    region = table(spark, d, "region").select(F.col("r_regionkey").alias("topic_key"), "r_name")
    out = conform(raw, to_utc("ts", tz="America/New_York"), [
        DimJoin(cust, {"user_id": "contributor_key"}, {"contributor_key": "contributor_key"}, how="inner"),
        DimJoin(nation, {"product_name": "n_name"}, {"product_key": "product_key"}, how="inner"),
        DimJoin(region, {"topic_name": "r_name"}, {"topic_key": "topic_key"}, how="inner"),
    ])
    return out.select(F.lit(1).alias("cnt"), "contributor_key", "utc_datetime", "product_key", "topic_key",
                      "action", "canonical")


# ------------------------------------------------------------------ sinks

_B1 = ("1996-01-01 00:00:00", "1996-06-30 00:00:00")
_B2 = ("1996-06-01 00:00:00", "1996-12-31 00:00:00")
_BATCH_SQL = f"""
WITH b1 AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders
            WHERE o_orderdate BETWEEN TIMESTAMP '{_B1[0]}' AND TIMESTAMP '{_B1[1]}'),
b2 AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders
       WHERE o_orderdate BETWEEN TIMESTAMP '{_B2[0]}' AND TIMESTAMP '{_B2[1]}')"""


def _batches(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    return windowed(o, "o_orderdate", *_B1), windowed(o, "o_orderdate", *_B2)


@register("insert_if_absent", _BATCH_SQL + """,
f1 AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus
       ORDER BY o_orderdate, o_orderkey) AS rn FROM b1) WHERE rn = 1),
f2 AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus
       ORDER BY o_orderdate, o_orderkey) AS rn FROM b2) WHERE rn = 1)
SELECT * FROM f1
UNION ALL
SELECT * FROM f2 WHERE NOT EXISTS (SELECT 1 FROM f1 WHERE f1.o_custkey = f2.o_custkey
                                   AND f1.o_orderstatus = f2.o_orderstatus)""")
def q_insert_if_absent(spark, d):
    b1, b2 = _batches(spark, d)
    key, order = ["o_custkey", "o_orderstatus"], ["o_orderdate", "o_orderkey"]
    t1 = insert_if_absent(None, b1, key, order)
    return t1.unionByName(insert_if_absent(t1, b2, key, order))


@register("replace_by_key", _BATCH_SQL + """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus
                               ORDER BY b DESC, o_orderdate DESC, o_orderkey DESC) AS rn
  FROM (SELECT *, 1 AS b FROM b1 UNION ALL SELECT *, 2 AS b FROM b2)) WHERE rn = 1""")
def q_replace_by_key(spark, d):
    b1, b2 = _batches(spark, d)
    key, order = ["o_custkey", "o_orderstatus"], ["o_orderdate", "o_orderkey"]
    return replace_by_key(replace_by_key(None, b1, key, order), b2, key, order)


@register("update_flag", f"""
SELECT event_id, user_id, CASE WHEN event_type = 'error' AND ts BETWEEN {SQL_EV} THEN 0 END AS comment_num
FROM events""")
def q_update_flag(spark, d):
    ev = table(spark, d, "events").select("event_id", "user_id", "event_type", "ts")
    out = set_where(ev.withColumn("comment_num", F.lit(None).cast("int")), "comment_num", 0,
                    (F.col("event_type") == "error") & between_ts("ts", EV_LO, EV_HI))
    return out.select("event_id", "user_id", "comment_num")


@register("update_derive", """
SELECT event_id, CAST(dayofweek(ts) + 1 AS INTEGER) AS dayOfWeek,
       CAST(strftime(ts, '%U') AS INTEGER) AS weekOfYear,
       CAST(month(ts) AS INTEGER) AS monthOfYear, CAST(year(ts) AS INTEGER) AS year
FROM events""")
def q_update_derive(spark, d):
    ev = table(spark, d, "events")
    return ev.select("event_id", *calendar_attributes(F.to_date("ts")))


# ------------------------------------------------------------------ lookups

@register("const_dim_lookup", f"""
SELECT e.event_id, e.user_id, r.r_regionkey AS source_key, n.n_nationkey AS team_key
FROM events e JOIN region r ON r.r_name = 'AMERICA' JOIN nation n ON n.n_name = 'NATION_7'
WHERE e.ts BETWEEN {SQL_EV}""")
def q_const_dim_lookup(spark, d):
    ev = windowed(table(spark, d, "events"), "ts", EV_LO, EV_HI).select("event_id", "user_id")
    return with_const_lookups(ev, {
        "source_key": lookup_const(table(spark, d, "region"), "r_name", "AMERICA", "r_regionkey"),
        "team_key": lookup_const(table(spark, d, "nation"), "n_name", "NATION_7", "n_nationkey"),
    })


@register("dim_two_aliases", """
SELECT o.o_orderkey, n1.n_name AS cust_nation, n2.n_nationkey AS target_key
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n1 ON c.c_nationkey = n1.n_nationkey AND n1.n_name IN ('NATION_1', 'NATION_2', 'NATION_3')
JOIN nation n2 ON n2.n_name = 'NATION_0'
WHERE o.o_orderdate BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1996-03-31 00:00:00'""")
def q_dim_two_aliases(spark, d):
    o = windowed(table(spark, d, "orders"), "o_orderdate", "1996-01-01 00:00:00", "1996-03-31 00:00:00")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, d, "nation")
    n1 = broadcast_bounded(nation.where(F.col("n_name").isin("NATION_1", "NATION_2", "NATION_3"))
                           .select(F.col("n_nationkey").alias("n1_key"), F.col("n_name").alias("cust_nation")),
                           known_rows=NATION_ROWS)
    j = (o.join(c, F.col("o_custkey") == F.col("c_custkey"))
         .join(n1, F.col("c_nationkey") == F.col("n1_key")))
    out = with_const_lookups(j, {"target_key": lookup_const(nation, "n_name", "NATION_0", "n_nationkey")})
    return out.select("o_orderkey", "cust_nation", "target_key")


@register("regex_contains", """
SELECT doc_id, lang, n_chars FROM documents WHERE regexp_matches(text, 'License')""")
def q_regex_contains(spark, d):
    docs = table(spark, d, "documents")
    return docs.where(regex_contains("text", "License")).select("doc_id", "lang", "n_chars")


@register("regex_literal_plus", """
SELECT doc_id, source FROM documents WHERE contains(text, '+1 (')""")
def q_regex_literal_plus(spark, d):
    docs = table(spark, d, "documents")
    return docs.where(literal_contains("text", "+1 (")).select("doc_id", "source")
