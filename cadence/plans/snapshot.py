"""Weekly snapshot of active contributors and the first-time (``is_new``) flag."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.functions.timefn import YEAR, Span
from cadence.operators.hop import AS_OF, Mondays
from cadence.operators.joins import broadcast_counted
from cadence.operators.windows import first_time_flag, trailing_distinct

SNAPSHOT_KEY = ["contributor_key", "c_date", "team_name", "source_name"]


def active_snapshot(contributor_facts: DataFrame, conversion: DataFrame, team: DataFrame,
                    source: DataFrame, mondays: Mondays, span: Span = YEAR,
                    level: str = "active") -> DataFrame:
    """(contributor_key, c_date, team_name, source_name): contributors with a
    conversion of ``contributor_level = level`` in ``[D - span, D]``, each Monday D.

    Facts whose team or source has no dim row drop
    out (inner joins), as in the warehouse definition.
    """
    conv = broadcast_counted(conversion.where(F.col("contributor_level") == level).select("conversion_key"))
    facts = (contributor_facts.select("contributor_key", "conversion_key", "team_key", "source_key", "utc_datetime")
             .join(conv, "conversion_key", "left_semi")
             .join(broadcast_counted(team.select("team_key", "team_name")), "team_key")
             .join(broadcast_counted(source.select("source_key", "source_name")), "source_key"))
    snap = trailing_distinct(facts, ["contributor_key", "team_name", "source_name"], "utc_datetime", mondays, span)
    return snap.select("contributor_key", F.col(AS_OF).alias("c_date"), "team_name", "source_name")


def flag_new(active: DataFrame, span: Span = YEAR) -> DataFrame:
    """Adds ``is_new``: 1 when the row is the contributor's only snapshot row in the
    trailing span ending at its date, among the rows given."""
    return first_time_flag(active, "contributor_key", "c_date", span)
