"""Joins on keys that compare NULL-safely (NULL equals NULL)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _condition(keys: Sequence[str], prefix: str) -> Column:
    cond = None
    for i, k in enumerate(keys):
        c = F.col(k).eqNullSafe(F.col(f"{prefix}{i}"))
        cond = c if cond is None else cond & c
    return cond


def semi_join_keys(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``other``."""
    o = other.select(*[F.col(k).alias(f"_sk{i}") for i, k in enumerate(keys)])
    return df.join(o, _condition(keys, "_sk"), "left_semi")


def join_keys(df: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``df`` joined with ``other`` on ``keys``, which are kept once."""
    rest = [c for c in other.columns if c not in keys]
    o = other.select(*[F.col(k).alias(f"_jk{i}") for i, k in enumerate(keys)], *rest)
    return df.join(o, _condition(keys, "_jk"), how).drop(*[f"_jk{i}" for i in range(len(keys))])
