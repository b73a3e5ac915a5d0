"""Key dedup semantics of the warehouse sinks, as DataFrame transformations.

* insert-if-absent: a row is added only when no row with its key exists yet;
  within one batch the first row per key (in a stated order) wins.
* replace: a row replaces the stored row with its key; within one batch the
  last row per key wins.

Keys compare NULL-safely (NULL equals NULL), so re-running a window whose rows
have empty optional fields adds nothing. Ties in the stated order are broken by
all remaining columns, so the survivor is deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.operators.joins import dealt


def _cols(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _total_order(df: DataFrame, key: list[str], order: Sequence, descending: bool) -> list[Column]:
    named = [o for o in order if isinstance(o, str)]
    exprs = [F.col(o) if isinstance(o, str) else o for o in order]
    rest = [F.col(c) for c in df.columns if c not in key and c not in named]
    cols = exprs + rest or [F.col(k) for k in key]   # all columns are key: any row will do
    if descending:
        return [c.desc_nulls_last() for c in cols]
    return [c.asc_nulls_first() for c in cols]


def _narrow(df: DataFrame, k: str) -> Column:
    """``k`` as it is compared: a text beyond 64 characters (a list of links may have 65,000)
    by its SHA-256, so that stored keys are shuffled and sorted as digests."""
    if not isinstance(df.schema[k].dataType, T.StringType):
        return F.col(k)
    return F.when(F.length(k) > 64, F.concat(F.lit("#"), F.sha2(F.col(k), 256))).otherwise(F.col(k))


def pick_per_key(df: DataFrame, key: Sequence[str] | str, order: Sequence = (),
                 last: bool = False) -> DataFrame:
    """One row per key: the first (or last) in ``order``.

    ``row_number() = 1`` is planned with a partial group limit before the shuffle,
    so a hot key sends one row per map partition, not all of its rows.
    """
    key = _cols(key)
    w = Window.partitionBy(*[_narrow(df, k) for k in key]).orderBy(*_total_order(df, key, order, last))
    return df.withColumn("_pick", F.row_number().over(w)).where(F.col("_pick") == 1).drop("_pick")


def anti_join_keys(df: DataFrame, other: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key (NULL-safe) does not occur in ``other``."""
    key = _cols(key)
    o = other.select(*[_narrow(other, k).alias(f"_ak_{i}") for i, k in enumerate(key)])
    cond = None
    for i, k in enumerate(key):
        c = _narrow(df, k).eqNullSafe(F.col(f"_ak_{i}"))
        cond = c if cond is None else cond & c
    return df.join(o, cond, "left_anti")


def insert_if_absent(existing: DataFrame | None, incoming: DataFrame, key: Sequence[str] | str,
                     order: Sequence = ()) -> DataFrame:
    """Rows of ``incoming`` to append: first per key, and no key already stored."""
    fresh = pick_per_key(incoming, key, order)
    if existing is None:
        return fresh
    return anti_join_keys(fresh, dealt(existing), key)


def replace_by_key(existing: DataFrame | None, incoming: DataFrame, key: Sequence[str] | str,
                   order: Sequence = ()) -> DataFrame:
    """The table after replacing: stored rows whose key is not in the batch, plus the
    last row per key of the batch."""
    fresh = pick_per_key(incoming, key, order, last=True)
    if existing is None:
        return fresh
    kept = anti_join_keys(existing, dealt(fresh), key)
    return kept.unionByName(fresh.select(*existing.columns))
