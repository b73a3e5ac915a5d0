"""Hand-written source rows for the topic jobs (schemas as the sources name them)."""

from pyspark.sql import functions as F

from cadence.plans import names as N
from dates import d, ts

NAMES = N.Names()


def bug_sources(spark):
    t = spark.createDataFrame
    return {
        "profiles": t([(1, "ann@x", ts("2014-06-01 08:00:00")), (2, "bob@x", ts("2013-01-01 00:00:00")),
                       (3, "cy@x", ts("2014-06-01 09:00:00"))], "userid long, login_name string, creation_ts timestamp_ntz"),
        "products": t([(1, NAMES.featured_product), (2, "Core")], "id long, name string"),
        "components": t([(10, "Gfx", 1), (11, "Gfx", 2), (12, "DOM", 2)], "id long, name string, product_id long"),
        "bugs": t([(100, 1, 12, "NEW"), (101, 2, 12, "ASSIGNED")],
                  "bug_id long, product_id long, component_id long, bug_status string"),
        "bug_status": t([(1, "NEW"), (2, "ASSIGNED")], "id long, value string"),
        "fielddefs": t([(1, "bug_status"), (2, "product"), (3, "component"), (4, "flagtypes.name")],
                       "id long, name string"),
        "bugs_activity": t([
            (100, 2, ts("2014-06-01 10:00:00"), 1, "ASSIGNED", "NEW", None),   # same time as the first comment
            (101, 2, ts("2014-06-01 11:00:00"), 4, "review+", "", 500),
            (101, 3, ts("2014-06-01 11:30:00"), 4, "review-", "", 500),
            (101, 3, ts("2014-06-01 11:40:00"), 4, "review?(x)", "", 500),
            (101, 3, ts("2014-06-03 11:40:00"), 2, "Core", "Other", None),    # outside the window
        ], "bug_id long, who long, bug_when timestamp_ntz, fieldid long, added string, removed string, attach_id long"),
        "longdescs": t([(100, 1, ts("2014-06-01 10:00:00")), (100, 2, ts("2014-06-01 12:00:00"))],
                       "bug_id long, who long, bug_when timestamp_ntz"),
        "attachments": t([(500, 2, 101, 1, ts("2014-06-01 11:00:00"), ts("2014-05-20 00:00:00"))],
                         "attach_id long, submitter_id long, bug_id long, ispatch int, "
                         "modification_time timestamp_ntz, creation_ts timestamp_ntz"),
    }


def hosting_sources(spark):
    return {"activities": spark.createDataFrame([
        ("dev@x", "https://h/pr/1", ts("2014-06-01 10:00:00"), "orgA", "mobile-app", "dev", "m" * 300, "c1",
         N.HOSTING_PR_OPENED),
        ("dev@x", "https://h/c/2", ts("2014-06-01 11:00:00"), "orgA", "other-repo", None, "msg", "c2",
         N.HOSTING_COMMIT_AUTHOR),
        (None, "https://h/c/3", ts("2014-06-01 11:00:00"), "orgA", "other-repo", "x", "msg", "c3",
         N.HOSTING_COMMIT_AUTHOR),
    ], "github_public_email string, github_commit_url string, happened_on timestamp_ntz, github_organization string, "
       "github_repository string, github_username string, commit_msg string, commit_id string, action_type string")}


def report_sources(spark):
    t = spark.createDataFrame
    return {
        "reports_ngreport": t([
            (1, d("2014-06-01"), ts("2014-06-01 10:00:00"), "https://l/1", None, "Paris", "48.856600", "2.352200",
             9, 1, 1, 5),
            (2, d("2014-05-20"), ts("2014-05-20 10:00:00"), "https://l/2", "talk", "Paris", "48.856600", "2.352200",
             8, 2, None, None),
        ], "id long, report_date date, created_on timestamp_ntz, link string, activity_description string, "
           "location string, latitude string, longitude string, mentor_id long, activity_id long, campaign_id long, "
           "event_id long").withColumn("latitude", F.col("latitude").cast("decimal(9,6)"))
        .withColumn("longitude", F.col("longitude").cast("decimal(9,6)")),
        # two profiles share mentor 9: report 1 reaches both authors
        "profiles_userprofile": t([(9, 21, "ann"), (9, 22, "bo"), (8, 23, "cy")],
                                  "mentor_id long, user_id long, display_name string"),
        "auth_user": t([(21, "ann@x"), (22, "bo@x"), (23, "cy@x")], "id long, email string"),
        "reports_activity": t([(1, "Talk"), (2, "Booth")], "id long, name string"),
        "reports_campaign": t([(1, "Summer")], "id long, name string"),
        "reports_ngreport_functional_areas": t([(1, 7)], "ngreport_id long, functionalarea_id long"),
        "profiles_functionalarea": t([(7, "Coding")], "id long, name string"),
    }


def support_sources(spark):
    t = spark.createDataFrame
    return {
        "auth_user": t([(1, "ann@x", "ann", ts("2014-06-01 08:00:00")), (2, "bob@x", "bob", ts("2012-01-01 00:00:00")),
                        (3, "cy@x", "cy", ts("2012-01-01 00:00:00"))],
                       "id long, email string, username string, date_joined timestamp_ntz"),
        "questions_question": t([(50, 1, "en-US"), (51, None, "de")], "id long, product_id long, locale string"),
        "products_product": t([(1, "Browser"), (2, "Mobile")], "id long, title string"),
        "products_topic": t([(1, "Install"), (2, "Sync")], "id long, title string"),
        "questions_answer": t([(900, 50, 3, ts("2014-06-01 09:00:00")), (901, 51, 3, ts("2014-06-01 09:30:00"))],
                              "id long, question_id long, creator_id long, updated timestamp_ntz"),
        "wiki_document": t([(70, "intro", "en-US"), (71, "intro", "en_US"), (72, "intro", "de"), (73, "x", None)],
                           "id long, slug string, locale string"),
        # document 70 has 2 products x 2 topics
        "wiki_document_products": t([(70, 1), (70, 2), (72, 1)], "document_id long, product_id long"),
        "wiki_document_topics": t([(70, 1), (70, 2), (72, 2)], "document_id long, topic_id long"),
        "wiki_revision": t([(1000, 70, 1, ts("2014-06-01 10:00:00")), (1001, 71, 2, ts("2014-06-01 10:05:00")),
                            (1002, 72, 2, ts("2014-06-01 10:10:00")), (1003, 73, 1, ts("2014-06-01 10:15:00")),
                            (1004, 70, 2, ts("2014-06-01 10:20:00"))],
                           "id long, document_id long, creator_id long, created timestamp_ntz"),
    }


def conversion_dim(spark):
    names = [NAMES.file_featured_bug, NAMES.bug_account_action, N.FILING_A_BUG, N.SUBMITTING_PATCH, N.PATCH_APPROVED,
             N.CHANGE_PRODUCT, N.CHANGE_COMPONENT, N.CHANGE_STATUS, N.COMMENT_ONE, N.PATCH_MERGED,
             N.ONE_IN_8_WEEKS, N.ONE_IN_4_WEEKS, N.FOUR_IN_4_WEEKS, NAMES.support_account_action, N.EDIT_ONE_KB,
             N.L10N_ONE_KB, N.EDIT_N_KB.format(n=5), N.L10N_N_KB.format(n=5), N.N_FORUM_ANSWERS.format(n=4),
             N.N_FORUM_ANSWERS.format(n=10)] + [NAMES.triage(n) for n in (1, 2, 10, 25, 50, 100)]
    active = {N.FILING_A_BUG, N.SUBMITTING_PATCH, N.COMMENT_ONE, N.PATCH_MERGED, N.ONE_IN_4_WEEKS, N.EDIT_ONE_KB}
    rows = [(i + 1, n, "active" if n in active else "casual") for i, n in enumerate(names)]
    return spark.createDataFrame(rows, "conversion_key long, conversion_desc string, contributor_level string")


def source_dim(spark):
    return spark.createDataFrame([(1, NAMES.bugs_source), (2, NAMES.hosting_source), (3, NAMES.reports_source),
                                  (4, NAMES.support_source)], "source_key long, source_name string")


def team_dim(spark):
    return spark.createDataFrame([(0, "unknown"), (3, "Mobile"), (4, NAMES.reports_team), (5, NAMES.support_team),
                                  (6, NAMES.featured_product)], "team_key long, team_name string")
