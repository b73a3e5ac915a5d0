"""Registry of named queries over the driver's test tables and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Fixed sizes of the two reference tables in the test schema (independent of scale).
NATION_ROWS, REGION_ROWS = 25, 5

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with its oracle SQL."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


_TABLES: dict[tuple, DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The test table ``name`` under ``sf_dir``; the read (file listing, schema) is
    done once per session and path, as with a table registered in a catalog."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    k = (id(spark), spark.sparkContext.applicationId, path)
    if k not in _TABLES:
        _TABLES[k] = spark.read.parquet(path)
    return _TABLES[k]
