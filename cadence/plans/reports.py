"""Field-report topic: reports for a window (author via the mentor profile link),
activity / location / campaign dims, conform into ``reports_facts``, and the
"1 in 8 weeks", "1 in 4 weeks" and "4 in 4 weeks" conversions (replace semantics).

Source tables: reports_ngreport, profiles_userprofile, auth_user,
reports_activity, reports_campaign, reports_ngreport_functional_areas,
profiles_functionalarea.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.functions.text import blank_if_null, concat_strict, left_chars
from cadence.functions.timefn import Span, offset_column, ymd_month_name
from cadence.operators.aggregates import group_ordered_list
from cadence.operators.conform import DimJoin, conform
from cadence.operators.dims import add_members, distinct_members
from cadence.operators.joins import lookup_const
from cadence.operators.windows import trailing_window
from cadence.plans import names as N
from cadence.plans.common import (insert_members, insert_raw, load_keys, store_conversions, stored_between, update_calendar,
                                  update_contributors, utc_of_raw)
from cadence.plans.conversions import FACT_COLUMNS
from cadence.sources.readers import Sources, copy_columns, windowed
from cadence.sources.sinks import Warehouse

RAW = "reports_facts_raw"
FACTS = "reports_facts"
RAW_COLS = ["email", "report_date", "local_datetime", "tz_offset", "event_url", "activity_desc", "activity",
            "campaign", "contribution_area", "location", "latitude", "longitude", "canonical", "source_text"]
RAW_KEY = [c for c in RAW_COLS if c not in ("tz_offset", "source_text")]
FACTS_COLS = ["contributor_key", "canonical", "utc_datetime", "utc_date_key", "activity_key", "source_key",
              "campaign_key", "location_key", "contribution_area", "event_url", "activity_desc"]


def extract_reports(src: Sources, lo, hi, names: N.Names = N.Names(), tz: str | None = None, offset=None,
                    author_link: str = "mentor_id") -> DataFrame:
    """Distinct report rows created in the window.

    The author is found through the profile sharing ``author_link`` with the
    report (as written: the mentor id, so a report reaches every profile with
    that mentor); reports without an author e-mail are dropped, which turns the
    profile and user joins into inner joins.
    """
    r = windowed(src["reports_ngreport"], "created_on", lo, hi)
    prof = src["profiles_userprofile"].select(F.col(author_link).alias("_link"), "user_id", "display_name")
    user = src["auth_user"].select(F.col("id").alias("user_id"), "email")
    act = src["reports_activity"].select(F.col("id").alias("activity_id"), F.col("name").alias("_activity"))
    camp = src["reports_campaign"].select(F.col("id").alias("campaign_id"), F.col("name").alias("_campaign"))
    bridge = src["reports_ngreport_functional_areas"].select(F.col("ngreport_id").alias("_rid"), "functionalarea_id")
    area = src["profiles_functionalarea"].select(F.col("id").alias("functionalarea_id"), F.col("name").alias("_area"))
    j = (r.join(prof, F.col(author_link) == F.col("_link"), "left")
         .join(user, "user_id", "left")
         .join(act, "activity_id", "left")
         .join(camp, "campaign_id", "left")
         .join(bridge, F.col("id") == F.col("_rid"), "left")
         .join(area, "functionalarea_id", "left")
         .where(F.col("email").isNotNull()))
    canonical = concat_strict(names.reports_url, F.col("display_name"), "/r/", ymd_month_name("report_date"), "/",
                              F.col("id"), "/")
    return j.select(
        "email", "report_date", F.col("created_on").alias("local_datetime"),
        offset_column("created_on", tz, offset).alias("tz_offset"),
        left_chars("link", 255).alias("event_url"),
        left_chars(blank_if_null("activity_description"), 255).alias("activity_desc"),
        blank_if_null("_activity").alias("activity"), blank_if_null("_campaign").alias("campaign"),
        blank_if_null("_area").alias("contribution_area"), "location", "latitude", "longitude",
        canonical.alias("canonical"), F.lit(None).cast("string").alias("source_text"),
    ).distinct()


def campaign_dim(src: Sources) -> DataFrame:
    return copy_columns(src["reports_campaign"], {"id": "campaign_key", "name": "campaign_name"})


def activity_members(raw_window: DataFrame, existing: DataFrame | None) -> DataFrame:
    m = distinct_members(raw_window, "activity", rename={"activity": "activity_name"})
    return add_members(existing, m, "activity_name", "activity_key")


def location_members(raw_window: DataFrame, existing: DataFrame | None) -> DataFrame:
    m = distinct_members(raw_window, ["location", "longitude", "latitude"], rename={"location": "location_name"})
    return add_members(existing, m, ["location_name", "longitude", "latitude"], "location_key")


def conform_facts(raw: DataFrame, contributor: DataFrame, cal: DataFrame, activity: DataFrame, source: DataFrame,
                  campaign: DataFrame, location: DataFrame) -> DataFrame:
    out = conform(raw, utc_of_raw(), [
        DimJoin(contributor, {"email": "email"}, {"contributor_key": "contributor_key"}, how="inner", grows=True),
        DimJoin(activity, {"activity": "activity_name"}, {"activity_key": "activity_key"},
                default={"activity_key": 0}),
        DimJoin(source, {"source_text": "source_name"}, {"source_key": "source_key"}),
        DimJoin(campaign, {"campaign": "campaign_name"}, {"campaign_key": "campaign_key"},
                default={"campaign_key": 0}),
        DimJoin(location, {"location": "location_name", "longitude": "longitude", "latitude": "latitude"},
                {"location_key": "location_key"}, default={"location_key": 0}),
    ], calendar=cal)
    return out.select(*FACTS_COLS)


def _with_team(rows: DataFrame, team_dim: DataFrame, names: N.Names) -> DataFrame:
    return rows.withColumn("team_key", lookup_const(team_dim, "team_name", names.reports_team, "team_key")) \
               .where(F.col("team_key").isNotNull())


def _with_conversion(rows: DataFrame, conversion_dim: DataFrame, name: str) -> DataFrame:
    return rows.withColumn("conversion_key", lookup_const(conversion_dim, "conversion_desc", name, "conversion_key")) \
               .where(F.col("conversion_key").isNotNull())


def trailing_conversion(facts: DataFrame, conversion_dim: DataFrame, team_dim: DataFrame, lo, hi, weeks: int,
                        name: str, names: N.Names = N.Names()) -> DataFrame:
    """Every report in ``[lo - weeks, hi]`` becomes a conversion row named ``name``."""
    f = trailing_window(facts, "utc_datetime", lo, hi, Span.weeks(weeks)).withColumn("cnt", F.lit(1))
    return _with_team(_with_conversion(f, conversion_dim, name), team_dim, names).select(*FACT_COLUMNS)


def four_in_four_weeks(facts: DataFrame, conversion_dim: DataFrame, team_dim: DataFrame, lo, hi, n: int = 4,
                       names: N.Names = N.Names()) -> DataFrame:
    """Contributors with at least ``n`` reports in ``[lo - 4 weeks, hi]``: one row each,
    listing the reports in time order, at the latest report's time."""
    f = trailing_window(facts, "utc_datetime", lo, hi, Span.weeks(4))
    g = group_ordered_list(f, ["contributor_key"], "utc_datetime", "canonical", extra=[
        F.count(F.lit(1)).alias("_n"), F.max("utc_datetime").alias("utc_datetime"),
        F.max_by("utc_date_key", "utc_datetime").alias("utc_date_key"),
        F.max_by("source_key", "utc_datetime").alias("source_key")])
    g = g.where(F.col("_n") >= n).withColumn("cnt", F.lit(1))
    return _with_team(_with_conversion(g, conversion_dim, N.FOUR_IN_4_WEEKS), team_dim, names).select(*FACT_COLUMNS)


def run(wh: Warehouse, src: Sources, lo, hi, conversion_dim: DataFrame, source_dim: DataFrame, team_dim: DataFrame,
        names: N.Names = N.Names(), tz: str | None = None, offset=None, four_in_4w: bool = True) -> None:
    raw = insert_raw(wh, RAW, extract_reports(src, lo, hi, names, tz, offset).select(*RAW_COLS), RAW_KEY, lo, hi)
    wh.insert_new("reports_campaign", campaign_dim(src), ["campaign_key"])
    activity = insert_members(wh, "reports_activity", activity_members(raw, None), ["activity_name"], "activity_key")
    location = insert_members(wh, "reports_location", location_members(raw, None), ["location_name", "longitude", "latitude"], "location_key")
    contributor = update_contributors(wh, [raw.select("email")])
    cal = update_calendar(wh, raw)
    facts = conform_facts(raw, contributor, cal, activity, source_dim, wh.table("reports_campaign"), location)
    wh.insert_new(FACTS, facts, FACTS_COLS, partition_by=["utc_date_key"], within=load_keys(lo, hi))
    stored = stored_between(wh, FACTS, lo, hi, Span.weeks(8))
    rows = trailing_conversion(stored, conversion_dim, team_dim, lo, hi, 8, N.ONE_IN_8_WEEKS, names).unionByName(
        trailing_conversion(stored, conversion_dim, team_dim, lo, hi, 4, N.ONE_IN_4_WEEKS, names))
    if four_in_4w:
        rows = rows.unionByName(four_in_four_weeks(stored, conversion_dim, team_dim, lo, hi, names=names))
    store_conversions(wh, rows, replace=True)
