"""Dimension members, surrogate keys, calendar, and attribute mapping."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.functions.timefn import between_ts, calendar_attributes, date_key
from cadence.operators.dedup import insert_if_absent
from cadence.operators.joins import dealt
from cadence.session import materialised

UNKNOWN_KEY = 0


def _cols(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def surrogate_key(*cols, probe: int = 0, bits: int = 64) -> Column:
    """Stable key of a natural key, ``bits`` wide (no coordination between writers).

    Each column is hashed after a mark whether it is NULL, as a NULL alone would leave
    the hash unchanged and its place in the key would be lost. 0 is reserved for the
    "unknown" member, so a hash of 0 is moved to 1. ``probe`` gives further keys of the
    same member, for where the first is taken (:func:`number_members`).
    """
    each = [F.col(c) if isinstance(c, str) else c for c in cols]
    h = F.xxhash64(*[x for c in each for x in (c.isNull(), c)], *([F.lit(probe)] if probe else []))
    if bits < 64:
        h = F.pmod(h, F.lit(1 << bits))
    return F.when(h == 0, F.lit(1).cast("long")).otherwise(h)


@contextlib.contextmanager
def number_members(members: DataFrame, natural: Sequence[str] | str, key_col: str, taken: DataFrame | None = None,
                   bits: int = 64, probes: int = 64) -> Iterator[DataFrame]:
    """``members`` (distinct natural keys) with a surrogate key that none of them shares and
    that is not in ``taken`` (a column ``key_col`` of stored members), for a ``with`` block.

    Every member proposes its hash. Of those that propose one key the first in natural
    order takes it, unless it is taken already; the others propose their next hash. One round
    is enough unless hashes collide; each is checked, and written before the next.
    """
    natural = _cols(natural)
    with contextlib.ExitStack() as tables:
        left, out = members.select(*natural), None
        taken = members.sparkSession.createDataFrame([], f"{key_col} long") if taken is None else taken.select(key_col)
        for probe in range(probes):
            first = Window.partitionBy(key_col).orderBy(*[F.col(c).asc_nulls_first() for c in natural])
            offers = left.select(surrogate_key(*natural, probe=probe, bits=bits).alias(key_col), *natural)
            offers = offers.withColumn("_nth", F.row_number().over(first))
            used = dealt(taken.select(F.col(key_col).alias("_used")).distinct())
            offers = offers.join(used, F.col(key_col) == F.col("_used"), "left")
            offers = tables.enter_context(materialised(offers.withColumn("_won", (F.col("_nth") == 1) & F.col("_used").isNull())))
            won, lost = offers.where("_won").select(key_col, *natural), offers.where("NOT _won").select(*natural)
            out = won if out is None else out.unionByName(won)
            if lost.isEmpty():
                yield out
                return
            taken, left = taken.unionByName(won.select(key_col)), lost
        raise ValueError(f"no free {bits}-bit keys after {probes} probes")


def key_collisions(dim: DataFrame, key_col: str, natural: Sequence[str] | str) -> DataFrame:
    """Surrogate keys that stand for more than one natural key, with their number.
    :func:`number_members` gives none."""
    members = dim.select(key_col, *_cols(natural)).distinct()
    return members.groupBy(key_col).agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > 1)


def distinct_members(df: DataFrame, cols: Sequence[str] | str, ts: str | None = None,
                     lo=None, hi=None, rename: dict | None = None) -> DataFrame:
    """Distinct natural keys, optionally of the rows inside ``[lo, hi]`` on ``ts``."""
    cols = _cols(cols)
    if ts is not None:
        df = df.where(between_ts(ts, lo, hi))
    out = df.select(*cols).distinct()
    for a, b in (rename or {}).items():
        out = out.withColumnRenamed(a, b)
    return out


def add_members(existing: DataFrame | None, members: DataFrame, natural: Sequence[str] | str,
                key_col: str) -> DataFrame:
    """Dim rows (with surrogate key) for distinct ``members``; with ``existing``, only
    those not stored yet. Pass ``existing=None`` when the sink does the key check
    itself (``Warehouse.insert_new``), so the dim is compared only once."""
    natural = _cols(natural)
    fresh = members.select(surrogate_key(*natural).alias(key_col), *natural)
    if existing is None:
        return fresh
    return insert_if_absent(existing, fresh, natural)


def calendar(dates: DataFrame, date_col: str = "utc_date_only") -> DataFrame:
    """Calendar dimension for the distinct dates of ``dates[date_col]``.

    Attributes are always derived for every date (no date is left without a
    day of week because it fell outside some window).
    """
    d = F.col(date_col)
    return (dates.select(d.alias("utc_date_only")).where(F.col("utc_date_only").isNotNull()).distinct()
            .select(date_key("utc_date_only").alias("utc_date_key"), F.col("utc_date_only"),
                    *calendar_attributes("utc_date_only")))


def map_attribute(dim: DataFrame, mapping: DataFrame, dim_col: str, map_col: str,
                  attr_cols: Sequence[str] | str) -> DataFrame:
    """Set attributes of dim rows from a (name -> attribute) mapping table, in one
    left join (rows without a mapping keep NULL)."""
    attr_cols = _cols(attr_cols)
    m = mapping.select(F.col(map_col).alias("_map_name"), *attr_cols)
    base = dim.drop(*[c for c in attr_cols if c in dim.columns])
    return base.join(m, F.col(dim_col) == F.col("_map_name"), "left").drop("_map_name")
