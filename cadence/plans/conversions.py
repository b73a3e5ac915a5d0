"""Conversions: named behavioural goals turned into ``contributor_facts`` rows.

A conversion is a rule over conformed facts (one row per matching fact), or a
threshold over such rows in a trailing window as seen each Monday. Rules of one
topic are evaluated in a single pass over the facts (:func:`convert`), then the
conversion / source / team keys are attached from their dimensions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.functions.timefn import date_key
from cadence.operators.joins import least_keys, lookup_const, with_const_lookups
from cadence.operators.rules import fan_out_rules
from cadence.sources.readers import windowed

FACT_COLUMNS = ["canonical", "utc_datetime", "cnt", "utc_date_key", "contributor_key",
                "conversion_key", "source_key", "team_key"]
# Stored key of contributor_facts (our choice; rows equal on it are one conversion).
FACT_KEY = ["contributor_key", "conversion_key", "canonical", "utc_datetime"]


def convert(facts: DataFrame, rules: dict[str, Column], lo=None, hi=None, ts: str = "utc_datetime",
            out: str = "conversion_desc") -> DataFrame:
    """Facts (inside ``[lo, hi]`` on ``ts``) tagged with each rule they meet; ``cnt`` = 1."""
    f = facts if lo is None else windowed(facts, ts, lo, hi)
    return fan_out_rules(f, rules, out).withColumn("cnt", F.lit(1))


@dataclass
class Team:
    """How a conversion row gets its team: none stored, a fixed team by name, or the
    team whose name equals a fact column (unknown -> ``default``)."""

    fixed: str | None = None
    by_column: str | None = None
    default: int | None = None


def attach_keys(rows: DataFrame, conversion_dim: DataFrame, source_dim: DataFrame, source_name: str,
                team: Team | None = None, team_dim: DataFrame | None = None,
                desc: str = "conversion_desc") -> DataFrame:
    """``contributor_facts`` columns for conversion rows named in ``desc``.

    A conversion or source missing from its dim gives no rows (as an inner join on
    the constant dim row would). Of several rows with one name the least key is taken.
    """
    conv = least_keys(conversion_dim, "conversion_desc", "conversion_key").withColumnRenamed("conversion_desc", "_cd")
    out = rows.join(conv, F.col(desc) == F.col("_cd"), "inner").drop("_cd")
    out = out.withColumn("source_key", lookup_const(source_dim, "source_name", source_name, "source_key")) \
             .where(F.col("source_key").isNotNull())
    team = team or Team()
    if team.fixed is not None:
        out = out.withColumn("team_key", lookup_const(team_dim, "team_name", team.fixed, "team_key")) \
                 .where(F.col("team_key").isNotNull())
    elif team.by_column is not None:
        t = least_keys(team_dim, "team_name", "team_key").select(F.col("team_name").alias("_tn"), F.col("team_key").alias("_tk"))
        out = out.join(t, F.col(team.by_column) == F.col("_tn"), "left")
        tk = F.col("_tk") if team.default is None else F.coalesce(F.col("_tk"), F.lit(team.default))
        out = out.withColumn("team_key", tk.cast("long")).drop("_tn", "_tk")
    else:
        out = out.withColumn("team_key", F.lit(None).cast("long"))
    if "utc_date_key" not in out.columns:
        out = out.withColumn("utc_date_key", date_key(F.to_date("utc_datetime")))
    return out.select(*FACT_COLUMNS)


def key_by_threshold(rows: DataFrame, conversion_dim: DataFrame, thresholds, name_of) -> DataFrame:
    """``conversion_key`` of the conversion named ``name_of(threshold)`` for each row.

    One threshold: a scalar-subquery lookup. Several: an equi-join on the name
    (the name is computed from the row's threshold, so it is never a constant and
    the join never degenerates into a cross product).
    """
    th = sorted(set(int(t) for t in thresholds))
    if len(th) == 1:
        return with_const_lookups(rows, {
            "conversion_key": lookup_const(conversion_dim, "conversion_desc", name_of(th[0]), "conversion_key")})
    target = F.lit(None).cast("string")
    for t in th:
        target = F.when(F.col("threshold") == t, F.lit(name_of(t))).otherwise(target)
    conv = least_keys(conversion_dim, "conversion_desc", "conversion_key").withColumnRenamed("conversion_desc", "_target")
    return rows.withColumn("_target", target).join(conv, "_target").drop("_target")
