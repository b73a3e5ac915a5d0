"""Catalog part 3: the bug-tracker job functions themselves, run over source
tables derived from the test tables.

Source views (all derived by Spark from the test tables):

* profiles      <- customer  (userid, e-mail, account time spread from 1996-12-20)
* bugs          <- orders x customer (bug = order, product = customer nation, status)
* products      <- nation; components <- nation (one component per product)
* bugs_activity <- lineitem  (who = supplier, when = ship date, field = line number,
                              added = review flag from the return flag, attachment)
* longdescs     <- orders    (the order placed is the bug's comment)
* attachments   <- lineitem  (one per line; a patch when the quantity exceeds 25)
* fielddefs     <- a fixed list of field names for line numbers 1-7
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.functions.text import concat_strict
from cadence.operators.dims import calendar
from cadence.operators.joins import dealt
from cadence.plans import bugs
from cadence.plans import names as N
from cadence.plans.registry import register, table
from cadence.session import cut_lineage
from cadence.sources.readers import Sources

JOB_LO, JOB_HI = "1997-01-01 00:00:00", "1997-03-31 00:00:00"
NAMES = N.Names(featured_product="NATION_3", bug_url="https://bugs.example.org/show_bug.cgi?id=")

# Field names of the test source, by line number.
FIELD_NAMES = [(1, "bug_status"), (2, "product"), (3, "component"), (4, "flagtypes.name"), (5, "cc"),
               (6, "comment_tag"), (7, "priority")]


def bug_sources(spark: SparkSession, d: str) -> Sources:
    customer, orders = table(spark, d, "customer"), table(spark, d, "orders")
    lineitem, nation = table(spark, d, "lineitem"), table(spark, d, "nation")
    email = concat_strict("user", F.col("c_custkey"), "@example.org")
    profiles = customer.select(
        F.col("c_custkey").alias("userid"), email.alias("login_name"),
        (F.lit("1996-12-20 00:00:00").cast("timestamp_ntz")
         + F.make_dt_interval(F.lit(0), (F.col("c_custkey") * 7).cast("int"))).alias("creation_ts"))
    bugs_t = orders.join(dealt(customer.select("c_custkey", "c_nationkey")), F.col("o_custkey") == F.col("c_custkey")) \
        .select(F.col("o_orderkey").alias("bug_id"), F.col("c_nationkey").cast("long").alias("product_id"),
                F.col("c_nationkey").cast("long").alias("component_id"), F.col("o_orderstatus").alias("bug_status"))
    products = nation.select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"))
    components = nation.select(F.col("n_nationkey").cast("long").alias("id"),
                               concat_strict(F.col("n_name"), "/core").alias("name"),
                               F.col("n_nationkey").cast("long").alias("product_id"))
    status = orders.select(F.col("o_orderstatus").alias("value")).distinct() \
        .select(F.ascii("value").cast("long").alias("id"), "value")
    attach_id = (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("long")
    activity = lineitem.select(
        F.col("l_orderkey").alias("bug_id"), F.col("l_suppkey").alias("who"), F.col("l_shipdate").alias("bug_when"),
        F.col("l_linenumber").cast("long").alias("fieldid"),
        F.when(F.col("l_returnflag") == "R", "review+").when(F.col("l_returnflag") == "A", "review-")
        .otherwise("review?(x)").alias("added"),
        F.col("l_linestatus").alias("removed"), attach_id.alias("attach_id"))
    longdescs = orders.select(F.col("o_orderkey").alias("bug_id"), F.col("o_custkey").alias("who"),
                              F.col("o_orderdate").alias("bug_when"))
    attachments = lineitem.select(
        attach_id.alias("attach_id"), F.col("l_suppkey").alias("submitter_id"), F.col("l_orderkey").alias("bug_id"),
        F.when(F.col("l_quantity") > 25, 1).otherwise(0).alias("ispatch"),
        F.col("l_shipdate").alias("modification_time"),
        (F.col("l_shipdate") - F.make_dt_interval(F.lit(30))).alias("creation_ts"))
    fielddefs = spark.createDataFrame(FIELD_NAMES, "id long, name string")
    return Sources(spark, frames={"profiles": profiles, "bugs": bugs_t, "products": products,
                                  "components": components, "bug_status": status, "bugs_activity": activity,
                                  "longdescs": longdescs, "attachments": attachments, "fielddefs": fielddefs})


_SOURCES_SQL = """
profiles AS (SELECT c_custkey AS userid, 'user' || c_custkey || '@example.org' AS login_name,
                    TIMESTAMP '1996-12-20 00:00:00' + to_hours(c_custkey * 7) AS creation_ts FROM customer),
bugs AS (SELECT o.o_orderkey AS bug_id, CAST(c.c_nationkey AS BIGINT) AS product_id,
                CAST(c.c_nationkey AS BIGINT) AS component_id,
                o.o_orderstatus AS bug_status FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
products AS (SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name FROM nation),
components AS (SELECT CAST(n_nationkey AS BIGINT) AS id, n_name || '/core' AS name,
                   CAST(n_nationkey AS BIGINT) AS product_id FROM nation),
status AS (SELECT DISTINCT CAST(ascii(o_orderstatus) AS BIGINT) AS id, o_orderstatus AS value FROM orders),
fielddefs AS (SELECT * FROM (VALUES (1, 'bug_status'), (2, 'product'), (3, 'component'), (4, 'flagtypes.name'),
              (5, 'cc'), (6, 'comment_tag'), (7, 'priority')) t(id, name)),
activity AS (SELECT l_orderkey AS bug_id, l_suppkey AS who, l_shipdate AS bug_when, l_linenumber AS fieldid,
                    CASE WHEN l_returnflag = 'R' THEN 'review+' WHEN l_returnflag = 'A' THEN 'review-'
                         ELSE 'review?(x)' END AS added, l_linestatus AS removed,
                    l_orderkey * 8 + l_linenumber AS attach_id FROM lineitem),
longdescs AS (SELECT o_orderkey AS bug_id, o_custkey AS who, o_orderdate AS bug_when FROM orders),
attachments AS (SELECT l_orderkey * 8 + l_linenumber AS attach_id, l_suppkey AS submitter_id, l_orderkey AS bug_id,
                       CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS ispatch, l_shipdate AS modification_time,
                       l_shipdate - INTERVAL 30 DAY AS creation_ts FROM lineitem),
ctx AS (SELECT b.bug_id, b.bug_status AS status, p.name AS product, c.name AS component
        FROM bugs b JOIN products p ON p.id = b.product_id JOIN components c ON c.id = b.component_id)"""

_RAW_SQL = f"""
raw AS (
  SELECT pr.login_name AS contributor_email, a.bug_when AS local_datetime, f.name AS fields, a.bug_id,
         a.added AS added_values, a.removed AS removed_values, a.attach_id AS attachment_id,
         ctx.status, ctx.product, ctx.component
  FROM activity a JOIN ctx ON ctx.bug_id = a.bug_id JOIN profiles pr ON pr.userid = a.who
  JOIN fielddefs f ON f.id = a.fieldid
  WHERE a.bug_when BETWEEN TIMESTAMP '{JOB_LO}' AND TIMESTAMP '{JOB_HI}'
  UNION ALL
  SELECT pr.login_name, l.bug_when, 'comment', l.bug_id, NULL, NULL, NULL, ctx.status, ctx.product, ctx.component
  FROM longdescs l JOIN ctx ON ctx.bug_id = l.bug_id JOIN profiles pr ON pr.userid = l.who
  WHERE l.bug_when BETWEEN TIMESTAMP '{JOB_LO}' AND TIMESTAMP '{JOB_HI}'
  UNION ALL
  SELECT login_name, creation_ts, '{NAMES.bug_account_action}', 0, NULL, NULL, NULL, '', '', ''
  FROM profiles WHERE creation_ts BETWEEN TIMESTAMP '{JOB_LO}' AND TIMESTAMP '{JOB_HI}'),
facts AS (
  SELECT r.local_datetime AS utc_datetime, r.fields, '{NAMES.bug_url}' || r.bug_id AS canonical,
         r.added_values, r.removed_values, r.attachment_id AS attachment_key, r.bug_id,
         pr.userid AS contributor_key, p.id AS product_key, coalesce(c.id, 0) AS component_key, s.id AS status_key,
         CAST(strftime(r.local_datetime, '%Y%m%d') AS INTEGER) AS utc_date_key
  FROM raw r JOIN profiles pr ON pr.login_name = r.contributor_email
  LEFT JOIN status s ON s.value = r.status LEFT JOIN products p ON p.name = r.product
  LEFT JOIN components c ON c.name = r.component),
firsts AS (SELECT bug_id, min(utc_datetime) AS first_ts FROM facts WHERE fields = 'comment' GROUP BY bug_id
           HAVING bug_id IN (SELECT bug_id FROM facts WHERE fields = 'comment'
                             AND utc_datetime BETWEEN TIMESTAMP '{JOB_LO}' AND TIMESTAMP '{JOB_HI}')),
numbered AS (SELECT f.*, CASE WHEN fi.first_ts IS NOT NULL THEN 0 END AS comment_num
             FROM facts f LEFT JOIN firsts fi ON fi.bug_id = f.bug_id AND fi.first_ts = f.utc_datetime)"""


def _job_facts(spark, d):
    src = bug_sources(spark, d)
    raw = bugs.raw_facts(src, JOB_LO, JOB_HI, NAMES)
    contributor = src["profiles"].select(F.col("userid").alias("contributor_key"), F.col("login_name").alias("email"))
    cal = calendar(raw.select(F.to_date(F.col("local_datetime") + F.col("tz_offset")).alias("utc_date_only")))
    # stored once, as the job stores bug_facts; numbering reads it three times
    facts = cut_lineage(bugs.conform_facts(raw, contributor, cal, bugs.status_dim(src), bugs.product_dim(src),
                                           bugs.component_dim(src), NAMES))
    return src, bugs.number_comments(facts, JOB_LO, JOB_HI)


@register("bug_job_facts", "WITH" + _SOURCES_SQL + "," + _RAW_SQL + "\nSELECT * FROM numbered")
def q_bug_job_facts(spark, d):
    return _job_facts(spark, d)[1]


def _dims(spark):
    conv_names = bugs.conversion_names(NAMES)
    conversion = spark.createDataFrame([(i + 1, n) for i, n in enumerate(conv_names)],
                                       "conversion_key long, conversion_desc string")
    source = spark.createDataFrame([(1, NAMES.bugs_source)], "source_key long, source_name string")
    return conversion, source


def _teams(spark, d) -> DataFrame:
    """Teams: the nations of region 1, named like the products."""
    return table(spark, d, "nation").where(F.col("n_regionkey") == 1).select(
        (F.col("n_nationkey") + 100).cast("long").alias("team_key"), F.col("n_name").alias("team_name"))


def _conversion_values_sql() -> str:
    return ", ".join(f"({i + 1}, '{n}')" for i, n in enumerate(bugs.conversion_names(NAMES)))


@register("bug_job_conversions", "WITH" + _SOURCES_SQL + "," + _RAW_SQL + f""",
conv AS (SELECT CAST(k AS BIGINT) AS conversion_key, conversion_desc
         FROM (VALUES {_conversion_values_sql()}) t(k, conversion_desc)),
team AS (SELECT n_nationkey + 100 AS team_key, n_name AS team_name FROM nation WHERE n_regionkey = 1),
att AS (SELECT attach_id AS attachment_key, ispatch FROM attachments
        WHERE modification_time BETWEEN TIMESTAMP '{JOB_LO}' AND TIMESTAMP '{JOB_HI}'
           OR creation_ts BETWEEN TIMESTAMP '{JOB_LO}' AND TIMESTAMP '{JOB_HI}'),
f AS (SELECT n.*, p.name AS product_name, att.ispatch FROM numbered n
      LEFT JOIN products p ON p.id = n.product_key LEFT JOIN att ON att.attachment_key = n.attachment_key
      WHERE n.utc_datetime BETWEEN TIMESTAMP '{JOB_LO}' AND TIMESTAMP '{JOB_HI}'),
rows AS (
  SELECT f.*, '{NAMES.file_featured_bug}' AS conversion_desc, NULL AS team_name FROM f
    WHERE comment_num = 0 AND product_name = '{NAMES.featured_product}'
  UNION ALL SELECT f.*, '{NAMES.bug_account_action}', NULL FROM f WHERE fields = '{NAMES.bug_account_action}'
  UNION ALL SELECT f.*, '{N.FILING_A_BUG}', NULL FROM f WHERE comment_num = 0
  UNION ALL SELECT f.*, '{N.SUBMITTING_PATCH}', product_name FROM f WHERE ispatch = 1
  UNION ALL SELECT f.*, '{N.PATCH_APPROVED}', product_name FROM f
    WHERE fields = '{N.FIELD_FLAGS}' AND contains(added_values, '{N.REVIEW_GRANTED}') AND ispatch = 1
  UNION ALL SELECT f.*, '{N.CHANGE_PRODUCT}', NULL FROM f WHERE regexp_matches(fields, 'product')
  UNION ALL SELECT f.*, '{N.CHANGE_COMPONENT}', NULL FROM f WHERE regexp_matches(fields, 'component')
  UNION ALL SELECT f.*, '{N.CHANGE_STATUS}', NULL FROM f WHERE regexp_matches(fields, 'bug_status')
  UNION ALL SELECT f.*, '{N.COMMENT_ONE}', NULL FROM f WHERE fields = 'comment')
SELECT rows.canonical, rows.utc_datetime, 1 AS cnt, rows.utc_date_key, rows.contributor_key, conv.conversion_key,
       CAST(1 AS BIGINT) AS source_key, CAST(coalesce(team.team_key, 0) AS BIGINT) AS team_key
FROM rows JOIN conv ON conv.conversion_desc = rows.conversion_desc
LEFT JOIN team ON team.team_name = rows.team_name""")
def q_bug_job_conversions(spark, d):
    src, numbered = _job_facts(spark, d)
    conversion, source = _dims(spark)
    attachments = bugs.extract_attachments(src, JOB_LO, JOB_HI)
    return bugs.conversions(numbered, bugs.product_dim(src), attachments, conversion, source, _teams(spark, d),
                            JOB_LO, JOB_HI, NAMES)


# ------------------------------------------------------------------ support site
#
# Source views for the support-site job:
# * auth_user          <- customer       (account time spread from 1996-12-20)
# * questions_question <- orders         (product from the order status, none for 'P';
#                                          locale 'de' for urgent orders, else 'en-US')
# * products_product   <- order statuses; products_topic <- region
# * questions_answer   <- lineitem       (answer per line, by the supplier, at the ship date)
# * wiki_document      <- documents      (locale from the language; Spanish texts as 'en_US')
# * wiki_document_products / _topics <- labels (quality -> product, toxic -> topic)
# * wiki_revision      <- conversations  (one revision per turn, hourly from 1997-01-01)

SUPPORT_CANON_LEN = 300
SUPPORT_NAMES = N.Names(support_url="https://support.example.org")


def support_sources(spark: SparkSession, d: str) -> Sources:
    customer, orders, lineitem = table(spark, d, "customer"), table(spark, d, "orders"), table(spark, d, "lineitem")
    docs, labels, conv = table(spark, d, "documents"), table(spark, d, "labels"), table(spark, d, "conversations")
    region = table(spark, d, "region")
    auth_user = customer.select(
        F.col("c_custkey").alias("id"), concat_strict("user", F.col("c_custkey"), "@example.org").alias("email"),
        F.col("c_name").alias("username"),
        (F.lit("1996-12-20 00:00:00").cast("timestamp_ntz")
         + F.make_dt_interval(F.lit(0), (F.col("c_custkey") * 7).cast("int"))).alias("date_joined"))
    question = orders.select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") != "P", F.ascii("o_orderstatus").cast("long")).alias("product_id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "de").otherwise("en-US").alias("locale"))
    product = orders.select("o_orderstatus").distinct().select(
        F.ascii("o_orderstatus").cast("long").alias("id"), concat_strict("product-", F.col("o_orderstatus")).alias("title"))
    topic = region.select(F.col("r_regionkey").cast("long").alias("id"), F.col("r_name").alias("title"))
    answer = lineitem.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("long").alias("id"),
        F.col("l_orderkey").alias("question_id"), F.col("l_suppkey").alias("creator_id"),
        F.col("l_shipdate").alias("updated"))
    document = docs.select(F.col("doc_id").alias("id"), F.col("source").alias("slug"),
                           F.when(F.col("lang") == "en", "en-US").when(F.col("lang") == "es", "en_US")
                           .otherwise(F.col("lang")).alias("locale"))
    doc_products = labels.select(F.col("doc_id").alias("document_id"),
                                 (F.lit(70) + F.col("quality") * 9).cast("long").alias("product_id"))
    doc_topics = labels.select(F.col("doc_id").alias("document_id"), F.col("toxic").cast("long").alias("topic_id"))
    revision = conv.select(
        (F.col("conv_id") * 100 + F.col("turn")).alias("id"), F.col("conv_id").alias("document_id"),
        (F.col("conv_id") + F.col("turn")).alias("creator_id"),
        (F.lit("1997-01-01 00:00:00").cast("timestamp_ntz")
         + F.make_dt_interval(F.lit(0), (F.col("conv_id") * 13 + F.col("turn")).cast("int"))).alias("created"))
    return Sources(spark, frames={
        "auth_user": auth_user, "questions_question": question, "products_product": product,
        "products_topic": topic, "questions_answer": answer, "wiki_document": document,
        "wiki_document_products": doc_products, "wiki_document_topics": doc_topics, "wiki_revision": revision})


_SUPPORT_SOURCES_SQL = """
auth_user AS (SELECT c_custkey AS id, 'user' || c_custkey || '@example.org' AS email, c_name AS username,
                     TIMESTAMP '1996-12-20 00:00:00' + to_hours(c_custkey * 7) AS date_joined FROM customer),
question AS (SELECT o_orderkey AS id,
                    CASE WHEN o_orderstatus <> 'P' THEN CAST(ascii(o_orderstatus) AS BIGINT) END AS product_id,
                    CASE WHEN o_orderpriority = '1-URGENT' THEN 'de' ELSE 'en-US' END AS locale FROM orders),
product AS (SELECT DISTINCT CAST(ascii(o_orderstatus) AS BIGINT) AS id, 'product-' || o_orderstatus AS title
            FROM orders),
topic AS (SELECT CAST(r_regionkey AS BIGINT) AS id, r_name AS title FROM region),
answer AS (SELECT l_orderkey * 8 + l_linenumber AS id, l_orderkey AS question_id, l_suppkey AS creator_id,
                  l_shipdate AS updated FROM lineitem),
document AS (SELECT doc_id AS id, source AS slug,
                    CASE WHEN lang = 'en' THEN 'en-US' WHEN lang = 'es' THEN 'en_US' ELSE lang END AS locale
             FROM documents),
doc_products AS (SELECT doc_id AS document_id, CAST(70 + quality * 9 AS BIGINT) AS product_id FROM labels),
doc_topics AS (SELECT doc_id AS document_id, CAST(toxic AS BIGINT) AS topic_id FROM labels),
revision AS (SELECT conv_id * 100 + turn AS id, conv_id AS document_id, conv_id + turn AS creator_id,
                    TIMESTAMP '1997-01-01 00:00:00' + to_hours(conv_id * 13 + turn) AS created FROM conversations)"""


def _support_revisions_sql(action: str, locale_pred: str) -> str:
    u = SUPPORT_NAMES.support_url
    return f"""
  SELECT au.email, doc.locale AS extra_locale, coalesce(t.title, '') AS extra_topic,
         coalesce(p.title, '') AS extra_product, CAST(NULL AS BIGINT) AS extra_question,
         '{u}/' || doc.locale || '/kb/' || doc.slug || '/revision/' || r.id AS canonical, '{action}' AS action,
         doc.id AS extra_id, r.created AS local_datetime
  FROM revision r LEFT JOIN document doc ON doc.id = r.document_id
  LEFT JOIN auth_user au ON au.id = r.creator_id
  LEFT JOIN doc_products dp ON dp.document_id = doc.id LEFT JOIN product p ON p.id = dp.product_id
  LEFT JOIN doc_topics dt ON dt.document_id = doc.id LEFT JOIN topic t ON t.id = dt.topic_id
  WHERE {locale_pred} AND r.created BETWEEN TIMESTAMP '{JOB_LO}' AND TIMESTAMP '{JOB_HI}'"""


_SUPPORT_FACTS_SQL = f"""
sraw AS (
  SELECT email, '' AS extra_locale, '' AS extra_topic, '' AS extra_product, CAST(NULL AS BIGINT) AS extra_question,
         '{SUPPORT_NAMES.support_url}/en-US/user/' || username AS canonical,
         '{SUPPORT_NAMES.support_account_action}' AS action, CAST(0 AS BIGINT) AS extra_id,
         date_joined AS local_datetime
  FROM auth_user WHERE date_joined BETWEEN TIMESTAMP '{JOB_LO}' AND TIMESTAMP '{JOB_HI}'
  UNION ALL
  SELECT au.email, q.locale, '', coalesce(p.title, ''), a.question_id,
         '{SUPPORT_NAMES.support_url}/questions/' || a.question_id || '#answer-' || a.id, '{N.SUPPORT_FORUM_ANSWER}',
         a.id, a.updated
  FROM answer a JOIN auth_user au ON au.id = a.creator_id JOIN question q ON q.id = a.question_id
  LEFT JOIN product p ON p.id = q.product_id
  WHERE a.updated BETWEEN TIMESTAMP '{JOB_LO}' AND TIMESTAMP '{JOB_HI}'
  UNION ALL {_support_revisions_sql(N.SUPPORT_L10N, "doc.locale != 'en_US'")}
  UNION ALL {_support_revisions_sql(N.SUPPORT_KB, "doc.locale = 'en-US'")}),
pdim AS (SELECT id AS product_key, title AS product_name FROM product UNION ALL SELECT 0, ''),
tdim AS (SELECT id AS topic_key, title AS topic_name FROM topic UNION ALL SELECT 0, ''),
sfacts AS (
  SELECT 1 AS cnt, au.id AS contributor_key, r.local_datetime AS utc_datetime, r.canonical,
         CAST(strftime(r.local_datetime, '%Y%m%d') AS INTEGER) AS utc_date_key, pd.product_key, td.topic_key,
         r.action, r.extra_locale AS locale, r.extra_question AS question, r.extra_id AS contribution_id_part
  FROM sraw r JOIN auth_user au ON au.email = r.email
  JOIN pdim pd ON pd.product_name = r.extra_product JOIN tdim td ON td.topic_name = r.extra_topic)"""


def _support_dims(spark, src):
    blank = spark.createDataFrame([(0, "")], "k long, n string")
    product = src["products_product"].select(F.col("id").alias("product_key"), F.col("title").alias("product_name")) \
        .unionByName(blank.select(F.col("k").alias("product_key"), F.col("n").alias("product_name")))
    topic = src["products_topic"].select(F.col("id").alias("topic_key"), F.col("title").alias("topic_name")) \
        .unionByName(blank.select(F.col("k").alias("topic_key"), F.col("n").alias("topic_name")))
    contributor = src["auth_user"].select(F.col("id").alias("contributor_key"), "email")
    return contributor, product, topic


def _support_facts(spark, d):
    from cadence.plans import support
    src = support_sources(spark, d)
    raw = support.raw_facts(src, JOB_LO, JOB_HI, SUPPORT_NAMES)
    contributor, product, topic = _support_dims(spark, src)
    # stored once and read by the five conversion branches and for the calendar, as the job does with its tables
    facts = cut_lineage(support.conform_facts(raw, contributor, None, product, topic))
    return facts, calendar(facts.select(F.to_date("utc_datetime").alias("utc_date_only")))


@register("support_job_facts", "WITH" + _SUPPORT_SOURCES_SQL + "," + _SUPPORT_FACTS_SQL + "\nSELECT * FROM sfacts")
def q_support_job_facts(spark, d):
    return _support_facts(spark, d)[0]


SUPPORT_CONVERSIONS = [SUPPORT_NAMES.support_account_action, N.EDIT_ONE_KB, N.L10N_ONE_KB,
                       N.EDIT_N_KB.format(n=5), N.N_FORUM_ANSWERS.format(n=4), N.N_FORUM_ANSWERS.format(n=10)]


def _support_threshold_sql(src_rows: str, threshold: int, name: str) -> str:
    return f"""
  SELECT left(string_agg(x.canonical, ',' ORDER BY x.utc_datetime, x.canonical), {SUPPORT_CANON_LEN}) AS canonical,
         max(x.utc_datetime) AS utc_datetime, x.contributor_key, m.d AS as_of, '{name}' AS conversion_desc
  FROM {src_rows} x JOIN mondays m
    ON x.utc_datetime BETWEEN CAST(m.d AS TIMESTAMP) - INTERVAL 1 YEAR AND CAST(m.d AS TIMESTAMP)
  GROUP BY x.contributor_key, m.d HAVING count(*) >= {threshold}"""


@register("support_job_conversions", "WITH" + _SUPPORT_SOURCES_SQL + "," + _SUPPORT_FACTS_SQL + f""",
conv AS (SELECT CAST(k AS BIGINT) AS conversion_key, conversion_desc
         FROM (VALUES {", ".join(f"({i + 1}, '{n}')" for i, n in enumerate(SUPPORT_CONVERSIONS))}) t(k, conversion_desc)),
mondays AS (SELECT DISTINCT CAST(utc_datetime AS DATE) AS d FROM sfacts
            WHERE dayofweek(utc_datetime) = 1
              AND CAST(CAST(utc_datetime AS DATE) AS TIMESTAMP) BETWEEN TIMESTAMP '{JOB_LO}' AND TIMESTAMP '{JOB_HI}'),
inwin AS (SELECT * FROM sfacts WHERE utc_datetime BETWEEN TIMESTAMP '{JOB_LO}' AND TIMESTAMP '{JOB_HI}'),
kb AS (SELECT DISTINCT canonical, utc_datetime, contributor_key FROM inwin WHERE action = '{N.SUPPORT_KB}'),
answers AS (SELECT canonical, utc_datetime, contributor_key FROM sfacts WHERE action = '{N.SUPPORT_FORUM_ANSWER}'),
rows AS (
  SELECT left(string_agg(canonical, ',' ORDER BY utc_datetime, canonical), {SUPPORT_CANON_LEN}) AS canonical,
         min(utc_datetime) AS utc_datetime, contributor_key, '{SUPPORT_NAMES.support_account_action}' AS conversion_desc
  FROM inwin GROUP BY contributor_key
  UNION ALL SELECT canonical, utc_datetime, contributor_key, '{N.EDIT_ONE_KB}' FROM kb
  UNION ALL SELECT DISTINCT canonical, utc_datetime, contributor_key, '{N.L10N_ONE_KB}' FROM inwin
    WHERE action = '{N.SUPPORT_L10N}'
  UNION ALL SELECT canonical, utc_datetime, contributor_key, conversion_desc FROM ({_support_threshold_sql("kb", 5, N.EDIT_N_KB.format(n=5))})
  UNION ALL SELECT canonical, utc_datetime, contributor_key, conversion_desc FROM ({_support_threshold_sql("answers", 4, N.N_FORUM_ANSWERS.format(n=4))})
  UNION ALL SELECT canonical, utc_datetime, contributor_key, conversion_desc FROM ({_support_threshold_sql("answers", 10, N.N_FORUM_ANSWERS.format(n=10))}))
SELECT DISTINCT rows.canonical, rows.utc_datetime, 1 AS cnt,
       CAST(strftime(rows.utc_datetime, '%Y%m%d') AS INTEGER) AS utc_date_key, rows.contributor_key,
       conv.conversion_key, CAST(4 AS BIGINT) AS source_key, CAST(5 AS BIGINT) AS team_key
FROM rows JOIN conv ON conv.conversion_desc = rows.conversion_desc""")
def q_support_job_conversions(spark, d):
    from cadence.operators.dedup import pick_per_key
    from cadence.operators.hop import calendar_mondays
    from cadence.plans import support
    from cadence.plans.conversions import FACT_KEY
    facts, cal = _support_facts(spark, d)
    conversion = spark.createDataFrame([(i + 1, n) for i, n in enumerate(SUPPORT_CONVERSIONS)],
                                       "conversion_key long, conversion_desc string")
    source = spark.createDataFrame([(4, SUPPORT_NAMES.support_source)], "source_key long, source_name string")
    team = spark.createDataFrame([(5, SUPPORT_NAMES.support_team)], "team_key long, team_name string")
    dims = (conversion, source, team)
    account = support.account_conversion(facts, *dims, JOB_LO, JOB_HI, SUPPORT_NAMES, max_len=SUPPORT_CANON_LEN)
    # the single-edit rows as stored (deduplicated on the fact key) feed the yearly threshold
    kb = cut_lineage(pick_per_key(support.single_conversion(facts, *dims, JOB_LO, JOB_HI, N.SUPPORT_KB, N.EDIT_ONE_KB,
                                                            SUPPORT_NAMES), FACT_KEY))
    l10n = support.single_conversion(facts, *dims, JOB_LO, JOB_HI, N.SUPPORT_L10N, N.L10N_ONE_KB, SUPPORT_NAMES)
    mondays = calendar_mondays(cal, JOB_LO, JOB_HI)
    answers = facts.where(F.col("action") == N.SUPPORT_FORUM_ANSWER)
    edits5 = support.yearly_threshold(kb, *dims, mondays, (5,), N.EDIT_N_KB, SUPPORT_NAMES,
                                      max_len=SUPPORT_CANON_LEN)
    answers_n = support.yearly_threshold(answers, *dims, mondays, (4, 10), N.N_FORUM_ANSWERS, SUPPORT_NAMES,
                                         max_len=SUPPORT_CANON_LEN)
    return account.unionByName(kb).unionByName(l10n).unionByName(edits5).unionByName(answers_n).distinct()


# ------------------------------------------------------------------ code hosting
#
# activities <- events: no public e-mail for 'error' events; organisation and
# repository from the user; no user name for every third user; the message is the
# event's properties; purchases are opened pull requests, clicks authored commits.

HOST_LO, HOST_HI = "2024-01-08 00:00:00", "2024-01-21 00:00:00"
HOSTING_NAMES = N.Names()
# Hand-kept (team, repository) list of the test deployment.
HOST_REPO_TEAMS = [("Mobile", "repo-0"), ("Mobile", "repo-1"), ("Web", "repo-2"), ("Ghost", "repo-3")]
HOST_TEAMS = [(1, "Mobile"), (2, "Web")]


def hosting_sources(spark: SparkSession, d: str) -> Sources:
    ev = table(spark, d, "events")
    act = F.col("event_type")
    return Sources(spark, frames={"activities": ev.select(
        F.when(act != "error", concat_strict("user", F.col("user_id"), "@example.org")).alias("github_public_email"),
        concat_strict("https://code.example.org/c/", F.col("event_id")).alias("github_commit_url"),
        F.col("ts").alias("happened_on"),
        concat_strict("org", F.col("user_id") % 5).alias("github_organization"),
        concat_strict("repo-", F.col("user_id") % 12).alias("github_repository"),
        F.when(F.col("user_id") % 3 != 0, concat_strict("u", F.col("user_id"))).alias("github_username"),
        F.col("props").alias("commit_msg"), F.col("event_id").cast("string").alias("commit_id"),
        F.when(act == "purchase", N.HOSTING_PR_OPENED).when(act == "click", N.HOSTING_COMMIT_AUTHOR)
        .otherwise(act).alias("action_type"))})


def _numbered_dim(raw: DataFrame, col: str, key: str, name: str) -> DataFrame:
    """Dim of the distinct names ``<prefix><n>`` keyed ``n + 1`` (natural keys, so the
    oracle can state them)."""
    return raw.select(F.col(col).alias(name)).distinct().select(
        (F.regexp_extract(name, "[0-9]+$", 0).cast("long") + 1).alias(key), name)


@register("hosting_job_conversions", f"""
WITH acts AS (
  SELECT CASE WHEN event_type <> 'error' THEN 'user' || user_id || '@example.org' END AS email,
         'https://code.example.org/c/' || event_id AS canonical, ts AS local_datetime,
         'org' || (user_id % 5) AS org, 'repo-' || (user_id % 12) AS repo,
         CASE WHEN event_type = 'purchase' THEN '{N.HOSTING_PR_OPENED}'
              WHEN event_type = 'click' THEN '{N.HOSTING_COMMIT_AUTHOR}' ELSE event_type END AS action, user_id
  FROM events WHERE ts BETWEEN TIMESTAMP '{HOST_LO}' AND TIMESTAMP '{HOST_HI}'),
raw AS (SELECT * FROM acts WHERE email IS NOT NULL),
teams AS (SELECT * FROM (VALUES {", ".join(f"({k}, '{n}')" for k, n in HOST_TEAMS)}) t(team_key, team_name)),
mapping AS (SELECT * FROM (VALUES {", ".join(f"('{t}', '{r}')" for t, r in HOST_REPO_TEAMS)}) t(team_name, repo_name)),
repo AS (SELECT DISTINCT CAST(regexp_extract(repo, '[0-9]+$', 0) AS BIGINT) + 1 AS github_repo_key, repo,
                CAST(tm.team_key AS BIGINT) AS team_key
         FROM raw LEFT JOIN mapping m ON m.repo_name = raw.repo LEFT JOIN teams tm ON tm.team_name = m.team_name),
conv AS (SELECT * FROM (VALUES (CAST(1 AS BIGINT), '{N.SUBMITTING_PATCH}'), (CAST(2 AS BIGINT), '{N.PATCH_MERGED}'))
         t(conversion_key, conversion_desc))
SELECT raw.canonical, raw.local_datetime AS utc_datetime, 1 AS cnt,
       CAST(strftime(raw.local_datetime, '%Y%m%d') AS INTEGER) AS utc_date_key, raw.user_id AS contributor_key,
       conv.conversion_key, CAST(2 AS BIGINT) AS source_key, repo.team_key
FROM raw JOIN repo ON repo.repo = raw.repo
JOIN conv ON conv.conversion_desc = CASE raw.action WHEN '{N.HOSTING_PR_OPENED}' THEN '{N.SUBMITTING_PATCH}'
                                                    WHEN '{N.HOSTING_COMMIT_AUTHOR}' THEN '{N.PATCH_MERGED}' END""")
def q_hosting_job_conversions(spark, d):
    from cadence.plans import hosting
    src = hosting_sources(spark, d)
    raw = hosting.extract_activity(src, HOST_LO, HOST_HI)
    contributor = table(spark, d, "events").select("user_id").distinct().select(
        F.col("user_id").alias("contributor_key"), concat_strict("user", F.col("user_id"), "@example.org").alias("email"))
    cal = calendar(raw.select(F.to_date(F.col("local_datetime") + F.col("tz_offset")).alias("utc_date_only")))
    org = _numbered_dim(raw, "extra_github_org", "github_org_key", "github_org_name")
    teams = spark.createDataFrame(HOST_TEAMS, "team_key long, team_name string")
    mapping = spark.createDataFrame(HOST_REPO_TEAMS, "team_name string, repo_name string")
    repo = hosting.assign_repo_teams(_numbered_dim(raw, "extra_github_repo", "github_repo_key", "github_repo_name"),
                                     mapping, teams)
    facts = hosting.conform_facts(raw, contributor, cal, org, repo)
    conversion = spark.createDataFrame([(1, N.SUBMITTING_PATCH), (2, N.PATCH_MERGED)],
                                       "conversion_key long, conversion_desc string")
    source = spark.createDataFrame([(2, HOSTING_NAMES.hosting_source)], "source_key long, source_name string")
    return hosting.conversions(facts, repo, conversion, source, HOST_LO, HOST_HI, HOSTING_NAMES)


# ------------------------------------------------------------------ field reports
#
# reports_ngreport <- orders x customer x nation (location = the customer's nation,
# coordinates from the nation key); profiles from customers and from suppliers, both
# linked by the mentor id = customer / supplier key, so reports of customers 0-99
# reach two authors; activity from the order status, campaign for urgent orders,
# functional areas through line items (one per line number).

REP_NAMES = N.Names(reports_url="https://reports.example.org/u/")


def report_sources(spark: SparkSession, d: str) -> Sources:
    orders, customer, nation = table(spark, d, "orders"), table(spark, d, "customer"), table(spark, d, "nation")
    supplier, lineitem = table(spark, d, "supplier"), table(spark, d, "lineitem")
    geo = customer.select("c_custkey", "c_nationkey").join(
        nation.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
    rep = orders.join(geo, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("id"), F.to_date("o_orderdate").alias("report_date"),
        F.col("o_orderdate").alias("created_on"),
        concat_strict("https://events.example.org/", F.col("o_orderkey")).alias("link"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("activity_description"),
        F.col("n_name").alias("location"),
        (F.col("n_nationkey") * 1.5).cast("decimal(9,6)").alias("latitude"),
        (F.col("n_nationkey") * -2.25).cast("decimal(9,6)").alias("longitude"),
        F.col("o_custkey").alias("mentor_id"), F.ascii("o_orderstatus").cast("long").alias("activity_id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(1).cast("long")).alias("campaign_id"),
        F.lit(None).cast("long").alias("event_id"))
    profiles = customer.select(F.col("c_custkey").alias("mentor_id"), F.col("c_custkey").alias("user_id"),
                               F.regexp_replace("c_name", "#", "-").alias("display_name")).unionByName(
        supplier.select(F.col("s_suppkey").alias("mentor_id"), (F.col("s_suppkey") + 100000).alias("user_id"),
                        F.regexp_replace("s_name", "#", "-").alias("display_name")))
    users = customer.select(F.col("c_custkey").alias("id"),
                            concat_strict("user", F.col("c_custkey"), "@example.org").alias("email")).unionByName(
        supplier.select((F.col("s_suppkey") + 100000).alias("id"),
                        concat_strict("supplier", F.col("s_suppkey"), "@example.org").alias("email")))
    activity = orders.select("o_orderstatus").distinct().select(
        F.ascii("o_orderstatus").cast("long").alias("id"), concat_strict("activity-", F.col("o_orderstatus")).alias("name"))
    campaign = orders.where(F.col("o_orderpriority") == "1-URGENT").select("o_orderpriority").distinct().select(
        F.substring("o_orderpriority", 1, 1).cast("long").alias("id"),
        concat_strict("Campaign ", F.col("o_orderpriority")).alias("name"))
    bridge = lineitem.select(F.col("l_orderkey").alias("ngreport_id"),
                             F.col("l_linenumber").cast("long").alias("functionalarea_id"))
    areas = lineitem.select("l_linenumber").distinct().select(
        F.col("l_linenumber").cast("long").alias("id"), concat_strict("area-", F.col("l_linenumber")).alias("name"))
    return Sources(spark, frames={"reports_ngreport": rep, "profiles_userprofile": profiles, "auth_user": users,
                                  "reports_activity": activity, "reports_campaign": campaign,
                                  "reports_ngreport_functional_areas": bridge, "profiles_functionalarea": areas})


_REPORTS_SQL = f"""
rep AS (SELECT o.o_orderkey AS id, CAST(o.o_orderdate AS DATE) AS report_date, o.o_orderdate AS created_on,
               'https://events.example.org/' || o.o_orderkey AS link,
               CASE WHEN o.o_orderpriority <> '5-LOW' THEN o.o_orderpriority END AS activity_description,
               n.n_name AS location, CAST(n.n_nationkey * 1.5 AS DECIMAL(9,6)) AS latitude,
               CAST(n.n_nationkey * -2.25 AS DECIMAL(9,6)) AS longitude, o.o_custkey AS mentor_id,
               CAST(ascii(o.o_orderstatus) AS BIGINT) AS activity_id,
               CASE WHEN o.o_orderpriority = '1-URGENT' THEN CAST(1 AS BIGINT) END AS campaign_id
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey),
profiles AS (SELECT c_custkey AS mentor_id, c_custkey AS user_id, replace(c_name, '#', '-') AS display_name
             FROM customer
             UNION ALL SELECT s_suppkey, s_suppkey + 100000, replace(s_name, '#', '-') FROM supplier),
users AS (SELECT c_custkey AS id, 'user' || c_custkey || '@example.org' AS email FROM customer
          UNION ALL SELECT s_suppkey + 100000, 'supplier' || s_suppkey || '@example.org' FROM supplier),
activity AS (SELECT DISTINCT CAST(ascii(o_orderstatus) AS BIGINT) AS id, 'activity-' || o_orderstatus AS name
             FROM orders),
campaign AS (SELECT DISTINCT CAST(left(o_orderpriority, 1) AS BIGINT) AS id, 'Campaign ' || o_orderpriority AS name
             FROM orders WHERE o_orderpriority = '1-URGENT'),
bridge AS (SELECT l_orderkey AS ngreport_id, CAST(l_linenumber AS BIGINT) AS functionalarea_id FROM lineitem),
areas AS (SELECT DISTINCT CAST(l_linenumber AS BIGINT) AS id, 'area-' || l_linenumber AS name FROM lineitem),
raw AS (
  SELECT DISTINCT u.email, r.report_date, r.created_on AS local_datetime, left(r.link, 255) AS event_url,
         left(coalesce(r.activity_description, ''), 255) AS activity_desc, coalesce(a.name, '') AS activity,
         coalesce(cp.name, '') AS campaign, coalesce(fa.name, '') AS contribution_area, r.location, r.latitude,
         r.longitude,
         '{REP_NAMES.reports_url}' || p.display_name || '/r/' || strftime(r.report_date, '%Y/%B/%-d') || '/' || r.id
           || '/' AS canonical
  FROM rep r LEFT JOIN profiles p ON p.mentor_id = r.mentor_id LEFT JOIN users u ON u.id = p.user_id
  LEFT JOIN activity a ON a.id = r.activity_id LEFT JOIN campaign cp ON cp.id = r.campaign_id
  LEFT JOIN bridge b ON b.ngreport_id = r.id LEFT JOIN areas fa ON fa.id = b.functionalarea_id
  WHERE u.email IS NOT NULL AND r.created_on BETWEEN TIMESTAMP '{JOB_LO}' AND TIMESTAMP '{JOB_HI}'),
rfacts AS (
  SELECT us.id AS contributor_key, raw.canonical, raw.local_datetime AS utc_datetime,
         CAST(strftime(raw.local_datetime, '%Y%m%d') AS INTEGER) AS utc_date_key,
         coalesce(a.id, 0) AS activity_key, CAST(NULL AS BIGINT) AS source_key, coalesce(cp.id, 0) AS campaign_key,
         CAST(coalesce(n.n_nationkey + 1, 0) AS BIGINT) AS location_key, raw.contribution_area, raw.event_url,
         raw.activity_desc
  FROM raw JOIN users us ON us.email = raw.email
  LEFT JOIN activity a ON a.name = raw.activity LEFT JOIN campaign cp ON cp.name = raw.campaign
  LEFT JOIN nation n ON n.n_name = raw.location AND CAST(n.n_nationkey * 1.5 AS DECIMAL(9,6)) = raw.latitude
                    AND CAST(n.n_nationkey * -2.25 AS DECIMAL(9,6)) = raw.longitude)"""


def _report_facts(spark, d):
    from cadence.plans import reports
    src = report_sources(spark, d)
    raw = reports.extract_reports(src, JOB_LO, JOB_HI, REP_NAMES)
    contributor = src["auth_user"].select(F.col("id").alias("contributor_key"), "email")
    cal = calendar(raw.select(F.to_date(F.col("local_datetime") + F.col("tz_offset")).alias("utc_date_only")))
    activity = src["reports_activity"].select(F.col("id").alias("activity_key"), F.col("name").alias("activity_name"))
    campaign = reports.campaign_dim(src)
    location = table(spark, d, "nation").select(
        (F.col("n_nationkey") + 1).cast("long").alias("location_key"), F.col("n_name").alias("location_name"),
        (F.col("n_nationkey") * -2.25).cast("decimal(9,6)").alias("longitude"),
        (F.col("n_nationkey") * 1.5).cast("decimal(9,6)").alias("latitude"))
    source = spark.createDataFrame([(3, REP_NAMES.reports_source)], "source_key long, source_name string")
    # stored once and read by the three conversion branches
    return cut_lineage(reports.conform_facts(raw, contributor, cal, activity, source, campaign, location))


@register("reports_job_facts", "WITH" + _REPORTS_SQL + "\nSELECT * FROM rfacts")
def q_reports_job_facts(spark, d):
    return _report_facts(spark, d)


REP_CONV = [(1, N.ONE_IN_8_WEEKS), (2, N.ONE_IN_4_WEEKS), (3, N.FOUR_IN_4_WEEKS)]
REP_LO, REP_HI = "1997-03-01 00:00:00", "1997-03-31 00:00:00"


@register("reports_job_conversions", "WITH" + _REPORTS_SQL + f""",
w8 AS (SELECT * FROM rfacts WHERE utc_datetime BETWEEN TIMESTAMP '{REP_LO}' - INTERVAL 56 DAY
                                                   AND TIMESTAMP '{REP_HI}'),
w4 AS (SELECT * FROM rfacts WHERE utc_datetime BETWEEN TIMESTAMP '{REP_LO}' - INTERVAL 28 DAY
                                                   AND TIMESTAMP '{REP_HI}')
SELECT canonical, utc_datetime, 1 AS cnt, utc_date_key, contributor_key, CAST(1 AS BIGINT) AS conversion_key,
       source_key, CAST(4 AS BIGINT) AS team_key FROM w8
UNION ALL
SELECT canonical, utc_datetime, 1, utc_date_key, contributor_key, CAST(2 AS BIGINT), source_key, CAST(4 AS BIGINT)
FROM w4
UNION ALL
SELECT string_agg(canonical, ',' ORDER BY utc_datetime, canonical), max(utc_datetime), 1,
       max_by(utc_date_key, utc_datetime), contributor_key, CAST(3 AS BIGINT), max_by(source_key, utc_datetime),
       CAST(4 AS BIGINT)
FROM w4 GROUP BY contributor_key HAVING count(*) >= 4""")
def q_reports_job_conversions(spark, d):
    from cadence.plans import reports
    facts = _report_facts(spark, d)
    conversion = spark.createDataFrame(REP_CONV, "conversion_key long, conversion_desc string")
    team = spark.createDataFrame([(4, REP_NAMES.reports_team)], "team_key long, team_name string")
    out = reports.trailing_conversion(facts, conversion, team, REP_LO, REP_HI, 8, N.ONE_IN_8_WEEKS, REP_NAMES)
    out = out.unionByName(reports.trailing_conversion(facts, conversion, team, REP_LO, REP_HI, 4, N.ONE_IN_4_WEEKS,
                                                      REP_NAMES))
    return out.unionByName(reports.four_in_four_weeks(facts, conversion, team, REP_LO, REP_HI, names=REP_NAMES))
