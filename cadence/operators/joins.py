"""Join helpers: broadcast only behind a size check; constant-row dim lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def broadcast_bounded(df: DataFrame, known_rows: int, max_rows: int = 100_000) -> DataFrame:
    """Broadcast ``df`` if the bound ``known_rows`` on its rows, known from construction
    (e.g. the number of weeks in a reporting window), is at most ``max_rows``. Anything
    else is left to Spark's own size check and AQE."""
    return F.broadcast(df) if known_rows <= max_rows else df


def broadcast_counted(dim: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Broadcast ``dim`` if it has at most ``max_rows`` rows, which a count that stops there tells.

    For facts joined with a dimension of few keys. By its estimates Spark may broadcast the facts
    instead, or deal them by the dim's key, and keeps that for the steps after the join:
    all facts are then worked on in as many tasks as the dimension has keys, or in one.
    """
    return broadcast_bounded(dim, dim.limit(max_rows + 1).count(), max_rows)


def dealt(df: DataFrame) -> DataFrame:
    """``df``, which grows with the facts, for a join that deals both sides by their keys.

    Below Spark's broadcast threshold such a table would go whole through the driver, in
    each join of a job again, and more of it with every load."""
    return df.hint("merge")


def lookup_const(dim: DataFrame, name_col: str, name: str, value_col: str, ignore_case: bool = False) -> Column:
    """Key of the dim row whose ``name_col`` equals ``name``, as a scalar subquery.

    Replaces ``INNER JOIN dim ON (dim.name = 'literal')``: the subquery runs once and
    its value is inlined, so no join (and no nested loop) is planned. A missing row yields
    NULL, which callers turn into "no rows". Of several rows with the name the least key
    is taken: a fact is not to be counted once for each of them.
    """
    match = F.lower(F.col(name_col)) == F.lit(name.lower()) if ignore_case else F.col(name_col) == F.lit(name)
    return dim.where(match).select(F.min(value_col).alias(value_col)).scalar()


def least_keys(dim: DataFrame, name_col: str, key_col: str) -> DataFrame:
    """``dim`` reduced to one key a name, the least, as :func:`lookup_const` takes it: joining on
    the name then neither multiplies facts nor depends on how a key is looked up."""
    return dim.groupBy(name_col).agg(F.min(key_col).alias(key_col))


def with_const_lookups(df: DataFrame, lookups: dict[str, Column]) -> DataFrame:
    """Add constant-row lookups as columns and drop rows where any is missing.

    Same result as a chain of inner joins on constant dim rows: a missing dim row
    empties the result.
    """
    for name, value in lookups.items():
        df = df.withColumn(name, value)
    cond = None
    for name in lookups:
        c = F.col(name).isNotNull()
        cond = c if cond is None else cond & c
    return df.where(cond) if cond is not None else df
