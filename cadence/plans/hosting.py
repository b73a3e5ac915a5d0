"""Code-hosting topic: pull requests and commits for a window, org / repo dims
(repo -> team from a maintained mapping), conform into ``hosting_facts`` and the
two patch conversions (replace semantics).

Source table: activities (public e-mail, commit URL, time, organization,
repository, user name, commit message, commit id, action type).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.functions.text import left_chars
from cadence.functions.timefn import offset_column
from cadence.operators.conform import DimJoin, conform
from cadence.operators.dims import add_members, distinct_members, map_attribute
from cadence.operators.joins import least_keys, lookup_const
from cadence.plans import names as N
from cadence.plans.common import (insert_members, insert_raw, load_keys, store_conversions, stored_between, update_calendar,
                                  update_contributors, utc_of_raw)
from cadence.plans.conversions import FACT_COLUMNS, convert
from cadence.sources.readers import Sources, windowed
from cadence.sources.sinks import Warehouse

RAW = "hosting_facts_raw"
FACTS = "hosting_facts"
RAW_KEY = ["email", "canonical", "local_datetime", "action"]
FACTS_KEY = ["contributor_key", "canonical", "action", "github_org_key", "github_repo_key", "utc_datetime",
             "utc_date_key"]


def extract_activity(src: Sources, lo, hi, tz: str | None = None, offset=None) -> DataFrame:
    """Activity with a public e-mail in the window. The extract carries the source
    offset (zero when neither a zone nor an offset is known)."""
    a = windowed(src["activities"], "happened_on", lo, hi).where(F.col("github_public_email").isNotNull())
    return a.select(F.col("github_public_email").alias("email"), F.col("github_commit_url").alias("canonical"),
                    F.col("happened_on").alias("local_datetime"),
                    offset_column("happened_on", tz, offset).alias("tz_offset"),
                    F.col("github_organization").alias("extra_github_org"),
                    F.col("github_repository").alias("extra_github_repo"),
                    F.coalesce(F.col("github_username"), F.col("github_public_email")).alias("extra_github_username"),
                    left_chars("commit_msg", 255).alias("extra_commit_msg"),
                    F.col("commit_id").alias("extra_commit_id"), F.col("action_type").alias("action"))


def org_members(raw_window: DataFrame, existing: DataFrame | None) -> DataFrame:
    m = distinct_members(raw_window, "extra_github_org", rename={"extra_github_org": "github_org_name"})
    return add_members(existing, m, "github_org_name", "github_org_key")


def repo_members(raw_window: DataFrame, existing: DataFrame | None) -> DataFrame:
    m = distinct_members(raw_window, "extra_github_repo", rename={"extra_github_repo": "github_repo_name"})
    return add_members(existing, m, "github_repo_name", "github_repo_key")


def assign_repo_teams(repo_dim: DataFrame, mapping: DataFrame, team_dim: DataFrame) -> DataFrame:
    """``team_key`` of each repository from a (team_name, repo_name) mapping, in one
    join (a team name missing from the team dim gives NULL). Repositories not in
    the mapping keep their current team."""
    m = (mapping.join(least_keys(team_dim, "team_name", "team_key"), "team_name", "left")
         .select(F.col("repo_name").alias("name"), F.col("team_key").alias("_mapped_team"),
                 F.lit(True).alias("_mapped")))
    cur = repo_dim if "team_key" in repo_dim.columns else repo_dim.withColumn("team_key", F.lit(None).cast("long"))
    out = map_attribute(cur, m, "github_repo_name", "name", ["_mapped_team", "_mapped"])
    team = F.when(F.col("_mapped").isNotNull(), F.col("_mapped_team")).otherwise(F.col("team_key"))
    return out.withColumn("team_key", team.cast("long")).drop("_mapped_team", "_mapped")


def conform_facts(raw: DataFrame, contributor: DataFrame, cal: DataFrame, org: DataFrame,
                  repo: DataFrame) -> DataFrame:
    """``hosting_facts``: unknown org / repo become the member 0."""
    out = conform(raw, utc_of_raw(), [
        DimJoin(contributor, {"email": "email"}, {"contributor_key": "contributor_key"}, how="inner", grows=True),
        DimJoin(org, {"extra_github_org": "github_org_name"}, {"github_org_key": "github_org_key"},
                default={"github_org_key": 0}),
        DimJoin(repo, {"extra_github_repo": "github_repo_name"}, {"github_repo_key": "github_repo_key"},
                default={"github_repo_key": 0}),
    ], calendar=cal)
    return out.select(*FACTS_KEY)


def conversions(facts: DataFrame, repo: DataFrame, conversion_dim: DataFrame, source_dim: DataFrame, lo, hi,
                names: N.Names = N.Names()) -> DataFrame:
    """Opened pull requests and authored commits; team of the repository (rows of
    an unknown repository need a repo row with key 0)."""
    f = windowed(facts, "utc_datetime", lo, hi).join(repo.select("github_repo_key", "team_key"), "github_repo_key")
    rows = convert(f, {N.SUBMITTING_PATCH: F.col("action") == N.HOSTING_PR_OPENED,
                       N.PATCH_MERGED: F.col("action") == N.HOSTING_COMMIT_AUTHOR})
    rows = rows.join(least_keys(conversion_dim, "conversion_desc", "conversion_key"), "conversion_desc")
    rows = rows.withColumn("source_key", lookup_const(source_dim, "source_name", names.hosting_source, "source_key")) \
               .where(F.col("source_key").isNotNull())
    return rows.select(*FACT_COLUMNS)


def run(wh: Warehouse, src: Sources, lo, hi, conversion_dim: DataFrame, source_dim: DataFrame,
        team_dim: DataFrame, repo_teams: DataFrame | None = None, names: N.Names = N.Names(),
        tz: str | None = None, offset=None) -> None:
    raw = insert_raw(wh, RAW, extract_activity(src, lo, hi, tz, offset), RAW_KEY, lo, hi)
    insert_members(wh, "hosting_org", org_members(raw, None), ["github_org_name"], "github_org_key")
    insert_members(wh, "hosting_repo", repo_members(raw, None), ["github_repo_name"], "github_repo_key", team_key=F.lit(None).cast("long"))
    if repo_teams is not None:
        wh.upsert("hosting_repo", assign_repo_teams(wh.table("hosting_repo"), repo_teams, team_dim),
                  ["github_repo_name"])
    contributor = update_contributors(wh, [raw.select("email")])
    cal = update_calendar(wh, raw)
    wh.insert_new(FACTS, conform_facts(raw, contributor, cal, wh.table("hosting_org"), wh.table("hosting_repo")),
                  FACTS_KEY, partition_by=["utc_date_key"], within=load_keys(lo, hi))
    store_conversions(wh, conversions(stored_between(wh, FACTS, lo, hi), wh.table("hosting_repo"),
                                      conversion_dim, source_dim,
                                      lo, hi, names), replace=True)
