"""Support-site topic: accounts, forum answers, knowledge-base edits and
localizations for a window; product / topic dims; conform into
``support_facts``; account, single-edit and yearly-threshold conversions.

Source tables: auth_user, questions_answer, questions_question,
products_product, products_topic, wiki_revision, wiki_document,
wiki_document_products, wiki_document_topics.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.functions.text import blank_if_null, concat_strict
from cadence.functions.timefn import YEAR, Span, date_key, offset_column
from cadence.operators.aggregates import group_ordered_list
from cadence.operators.conform import DimJoin, conform
from cadence.operators.dims import distinct_members
from cadence.operators.hop import Mondays, calendar_mondays
from cadence.operators.joins import lookup_const, with_const_lookups
from cadence.operators.windows import threshold_rollup
from cadence.plans import names as N
from cadence.plans.common import (CONTRIBUTOR_FACTS, insert_members, insert_raw, key_range, load_keys, store_conversions, stored_between,
                                  update_calendar, update_contributors, utc_of_raw)
from cadence.plans.conversions import FACT_COLUMNS, key_by_threshold
from cadence.sources.readers import Sources, windowed
from cadence.sources.sinks import Warehouse

RAW = "support_facts_raw"
FACTS = "support_facts"
RAW_COLS = ["email", "extra_locale", "extra_topic", "extra_product", "extra_question", "canonical", "action",
            "extra_id", "local_datetime", "tz_offset"]
RAW_KEY = [c for c in RAW_COLS if c != "tz_offset"]
FACTS_COLS = ["cnt", "contributor_key", "utc_datetime", "canonical", "utc_date_key", "product_key", "topic_key",
              "action", "locale", "question", "contribution_id_part"]


def extract_accounts(src: Sources, lo, hi, names: N.Names = N.Names(), tz=None, offset=None) -> DataFrame:
    u = windowed(src["auth_user"], "date_joined", lo, hi)
    return u.select("email", F.lit("").alias("extra_locale"), F.lit("").alias("extra_topic"),
                    F.lit("").alias("extra_product"), F.lit(None).cast("long").alias("extra_question"),
                    concat_strict(names.support_url, "/en-US/user/", F.col("username")).alias("canonical"),
                    F.lit(names.support_account_action).alias("action"), F.lit(0).cast("long").alias("extra_id"),
                    F.col("date_joined").alias("local_datetime"),
                    offset_column("date_joined", tz, offset).alias("tz_offset"))


def extract_forum_answers(src: Sources, lo, hi, names: N.Names = N.Names(), tz=None, offset=None) -> DataFrame:
    a = windowed(src["questions_answer"], "updated", lo, hi).select(
        F.col("id").alias("answer_id"), "question_id", "creator_id", "updated")
    u = src["auth_user"].select(F.col("id").alias("creator_id"), "email")
    q = src["questions_question"].select(F.col("id").alias("question_id"), F.col("product_id").alias("_pid"), "locale")
    p = src["products_product"].select(F.col("id").alias("_pid"), F.col("title").alias("_product"))
    j = a.join(u, "creator_id").join(q, "question_id").join(p, "_pid", "left")
    return j.select("email", F.col("locale").alias("extra_locale"), F.lit("").alias("extra_topic"),
                    blank_if_null("_product").alias("extra_product"), F.col("question_id").alias("extra_question"),
                    concat_strict(names.support_url, "/questions/", F.col("question_id"), "#answer-",
                                  F.col("answer_id")).alias("canonical"),
                    F.lit(N.SUPPORT_FORUM_ANSWER).alias("action"), F.col("answer_id").alias("extra_id"),
                    F.col("updated").alias("local_datetime"), offset_column("updated", tz, offset).alias("tz_offset"))


def extract_revisions(src: Sources, lo, hi, action: str, locale_filter: Column, names: N.Names = N.Names(),
                      tz=None, offset=None) -> DataFrame:
    """Knowledge-base revisions of the window with author, document, and every
    (product, topic) pair of the document (both bridges fan out)."""
    r = windowed(src["wiki_revision"], "created", lo, hi).select(
        F.col("id").alias("revision_id"), "document_id", "creator_id", "created")
    doc = src["wiki_document"].select(F.col("id").alias("document_id"), "slug", "locale")
    u = src["auth_user"].select(F.col("id").alias("creator_id"), "email")
    dp = src["wiki_document_products"].select(F.col("document_id").alias("_dp_doc"), F.col("product_id").alias("_pid"))
    p = src["products_product"].select(F.col("id").alias("_pid"), F.col("title").alias("_product"))
    dt = src["wiki_document_topics"].select(F.col("document_id").alias("_dt_doc"), F.col("topic_id").alias("_tid"))
    t = src["products_topic"].select(F.col("id").alias("_tid"), F.col("title").alias("_topic"))
    j = (r.join(doc, "document_id", "left").join(u, "creator_id", "left")
         .join(dp, F.col("_dp_doc") == F.col("document_id"), "left").join(p, "_pid", "left")
         .join(dt, F.col("_dt_doc") == F.col("document_id"), "left").join(t, "_tid", "left")
         .where(locale_filter))
    return j.select("email", F.col("locale").alias("extra_locale"), blank_if_null("_topic").alias("extra_topic"),
                    blank_if_null("_product").alias("extra_product"),
                    F.lit(None).cast("long").alias("extra_question"),
                    concat_strict(names.support_url, "/", F.col("locale"), "/kb/", F.col("slug"), "/revision/",
                                  F.col("revision_id")).alias("canonical"),
                    F.lit(action).alias("action"), F.col("document_id").alias("extra_id"),
                    F.col("created").alias("local_datetime"), offset_column("created", tz, offset).alias("tz_offset"))


def l10n_filter() -> Column:
    """As written: any locale other than 'en_US' (note the underscore)."""
    return F.col("locale") != "en_US"


def kb_filter() -> Column:
    return F.col("locale") == "en-US"


def raw_facts(src: Sources, lo, hi, names: N.Names = N.Names(), tz=None, offset=None,
              l10n: Column | None = None, kb: Column | None = None) -> DataFrame:
    parts = [extract_accounts(src, lo, hi, names, tz, offset), extract_forum_answers(src, lo, hi, names, tz, offset),
             extract_revisions(src, lo, hi, N.SUPPORT_L10N, l10n if l10n is not None else l10n_filter(), names,
                               tz, offset),
             extract_revisions(src, lo, hi, N.SUPPORT_KB, kb if kb is not None else kb_filter(), names, tz, offset)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*RAW_COLS)


def conform_facts(raw: DataFrame, contributor: DataFrame, cal: DataFrame | None, product: DataFrame,
                  topic: DataFrame) -> DataFrame:
    """``support_facts``: product and topic are inner joins by name, so a fact whose
    product or topic name is not a dim member is dropped."""
    out = conform(raw, utc_of_raw(), [
        DimJoin(contributor, {"email": "email"}, {"contributor_key": "contributor_key"}, how="inner", grows=True),
        DimJoin(product, {"extra_product": "product_name"}, {"product_key": "product_key"}, how="inner"),
        DimJoin(topic, {"extra_topic": "topic_name"}, {"topic_key": "topic_key"}, how="inner"),
    ], calendar=cal)
    return out.select(F.lit(1).alias("cnt"), "contributor_key", "utc_datetime", "canonical", "utc_date_key",
                      "product_key", "topic_key", "action", F.col("extra_locale").alias("locale"),
                      F.col("extra_question").alias("question"), F.col("extra_id").alias("contribution_id_part"))


def _keys(rows: DataFrame, conversion_dim: DataFrame, source_dim: DataFrame, team_dim: DataFrame, name: str,
          names: N.Names) -> DataFrame:
    return with_const_lookups(rows, {
        "conversion_key": lookup_const(conversion_dim, "conversion_desc", name, "conversion_key"),
        "source_key": lookup_const(source_dim, "source_name", names.support_source, "source_key"),
        "team_key": lookup_const(team_dim, "team_name", names.support_team, "team_key"),
    })


def account_conversion(facts: DataFrame, conversion_dim, source_dim, team_dim, lo, hi, names: N.Names = N.Names(),
                       action: str | None = None, max_len: int = N.CANONICAL_MAX_LEN) -> DataFrame:
    """First support activity of each contributor in the window (any action, as
    written; ``action`` restricts it), with all its canonicals in time order."""
    f = windowed(facts, "utc_datetime", lo, hi)
    if action is not None:
        f = f.where(F.col("action") == action)
    g = group_ordered_list(f, "contributor_key", "utc_datetime", "canonical", max_len=max_len, extra=[
        F.min("utc_datetime").alias("utc_datetime"), F.min("utc_date_key").alias("utc_date_key")])
    g = g.withColumn("cnt", F.lit(1))
    return _keys(g, conversion_dim, source_dim, team_dim, names.support_account_action, names).select(*FACT_COLUMNS)


def single_conversion(facts: DataFrame, conversion_dim, source_dim, team_dim, lo, hi, action: str, name: str,
                      names: N.Names = N.Names()) -> DataFrame:
    """One conversion row per matching support fact (event level)."""
    f = windowed(facts, "utc_datetime", lo, hi).where(F.col("action") == action).withColumn("cnt", F.lit(1))
    return _keys(f, conversion_dim, source_dim, team_dim, name, names).select(*FACT_COLUMNS)


def yearly_threshold(rows: DataFrame, conversion_dim, source_dim, team_dim, mondays: Mondays,
                     thresholds: Sequence[int], name_template: str, names: N.Names = N.Names(),
                     span: Span = YEAR, max_len: int = N.CANONICAL_MAX_LEN) -> DataFrame:
    """Contributors with ``n >= threshold`` rows in ``[D - span, D]`` each Monday D;
    canonical lists cut to ``max_len``."""
    r = threshold_rollup(rows, ["contributor_key"], "utc_datetime", mondays, span, thresholds, canon="canonical",
                         concat="list", max_len=max_len)
    r = key_by_threshold(r, conversion_dim, thresholds, lambda t: name_template.format(n=t))
    r = with_const_lookups(r, {
        "source_key": lookup_const(source_dim, "source_name", names.support_source, "source_key"),
        "team_key": lookup_const(team_dim, "team_name", names.support_team, "team_key"),
    })
    return r.select("canonical", "utc_datetime", F.lit(1).alias("cnt"),
                    date_key(F.to_date("utc_datetime")).alias("utc_date_key"), "contributor_key", "conversion_key",
                    "source_key", "team_key")


def run(wh: Warehouse, src: Sources, lo, hi, conversion_dim: DataFrame, source_dim: DataFrame, team_dim: DataFrame,
        names: N.Names = N.Names(), tz=None, offset=None, account_action: str | None = None) -> None:
    raw = insert_raw(wh, RAW, raw_facts(src, lo, hi, names, tz, offset), RAW_KEY, lo, hi)
    contributor = update_contributors(wh, [raw.select("email")])
    product = insert_members(wh, "support_product", distinct_members(raw, "extra_product", rename={"extra_product": "product_name"}),
                             ["product_name"], "product_key")
    topic = insert_members(wh, "support_topic", distinct_members(raw, "extra_topic", rename={"extra_topic": "topic_name"}),
                           ["topic_name"], "topic_key")
    cal = update_calendar(wh, raw)
    wh.insert_new(FACTS, conform_facts(raw, contributor, cal, product, topic),
                  [c for c in FACTS_COLS if c != "cnt"], partition_by=["utc_date_key"], within=load_keys(lo, hi))
    facts = stored_between(wh, FACTS, lo, hi)
    dims = conversion_dim, source_dim, team_dim
    store_conversions(wh, account_conversion(facts, *dims, lo, hi, names, account_action), replace=True)
    singles = single_conversion(facts, *dims, lo, hi, N.SUPPORT_KB, N.EDIT_ONE_KB, names).unionByName(
        single_conversion(facts, *dims, lo, hi, N.SUPPORT_L10N, N.L10N_ONE_KB, names))
    store_conversions(wh, singles, within=key_range(lo, hi))
    mondays = calendar_mondays(wh.table("utc_date_only"), lo, hi)
    if mondays.empty:
        return
    cf = stored_between(wh, CONTRIBUTOR_FACTS, mondays.first, mondays.last, YEAR)
    facts = stored_between(wh, FACTS, mondays.first, mondays.last, YEAR)

    def rows_of(name):
        key = conversion_dim.where(F.col("conversion_desc") == name).select("conversion_key")
        return cf.join(key, "conversion_key", "left_semi")

    answers = facts.where(F.col("action") == N.SUPPORT_FORUM_ANSWER)
    out = yearly_threshold(rows_of(N.EDIT_ONE_KB), conversion_dim, source_dim, team_dim, mondays, (5,),
                           N.EDIT_N_KB, names)
    out = out.unionByName(yearly_threshold(rows_of(N.L10N_ONE_KB), conversion_dim, source_dim, team_dim, mondays,
                                           (5,), N.L10N_N_KB, names))
    out = out.unionByName(yearly_threshold(answers, conversion_dim, source_dim, team_dim, mondays, (4, 10),
                                           N.N_FORUM_ANSWERS, names))
    store_conversions(wh, out, within=key_range(mondays.first, mondays.last, YEAR))
