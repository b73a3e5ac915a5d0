"""Conform raw facts: UTC time, calendar key, and surrogate keys from dimensions.

One function serves every topic: a list of :class:`DimJoin` says, per dimension,
which raw columns match which dim columns, whether a missing member drops the row
(inner) or keeps it (left), and which value stands for "unknown".
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.functions.timefn import date_key
from cadence.operators.joins import dealt


@dataclass
class DimJoin:
    dim: DataFrame
    on: dict[str, str]                 # raw column -> dim column
    take: dict[str, str]               # dim column -> output column
    how: str = "left"                  # "left" keeps facts without a member
    default: dict[str, Any] = field(default_factory=dict)   # output column -> value when missing
    null_safe: bool = False            # match NULL with NULL
    ignore_case: bool = False          # compare names without case (as a case-insensitive collation)
    grows: bool = False                # has a member a contributor or the like: joined by dealing both sides


def join_dim(raw: DataFrame, dj: DimJoin, tag: str) -> DataFrame:
    dim = dj.dim.select(*[F.col(c).alias(f"{tag}_{c}") for c in set(dj.on.values()) | set(dj.take)])
    cond = None
    for rc, dc in dj.on.items():
        left, right = F.col(rc), F.col(f"{tag}_{dc}")
        if dj.ignore_case:
            left, right = F.lower(left), F.lower(right)
        c = left.eqNullSafe(right) if dj.null_safe else left == right
        cond = c if cond is None else cond & c
    out = raw.join(dealt(dim) if dj.grows else dim, cond, dj.how)
    for dc, oc in dj.take.items():
        v = F.col(f"{tag}_{dc}")
        if oc in dj.default:
            v = F.coalesce(v, F.lit(dj.default[oc]))
        out = out.withColumn(oc, v)
    return out.drop(*[f"{tag}_{c}" for c in set(dj.on.values()) | set(dj.take)])


def conform(raw: DataFrame, utc: Column, dims: list[DimJoin], calendar: DataFrame | None = None,
            select: list | None = None) -> DataFrame:
    """Raw facts with ``utc_datetime``, ``utc_date_key`` and the dims' keys.

    ``calendar`` (``utc_date_key``, ``utc_date_only``) is joined inner on the UTC
    date, so a fact needs its date in the calendar; without it the key is derived.
    """
    out = raw.withColumn("utc_datetime", utc)
    if calendar is not None:
        cal = calendar.select(F.col("utc_date_only").alias("_cal_d"), F.col("utc_date_key"))
        out = out.join(cal, F.to_date("utc_datetime") == F.col("_cal_d"), "inner").drop("_cal_d")
    else:
        out = out.withColumn("utc_date_key", date_key(F.to_date("utc_datetime")))
    for i, dj in enumerate(dims):
        out = join_dim(out, dj, f"_d{i}")
    return out.select(*select) if select else out
