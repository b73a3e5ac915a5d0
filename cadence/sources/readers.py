"""Source readers and window predicates.

Sources are read as DataFrames (Parquet by default, JDBC optional); the time
window is a typed, closed predicate that Spark pushes into the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.functions.timefn import between_ts


def read_table(spark: SparkSession, root: str, name: str, fmt: str = "parquet") -> DataFrame:
    """A table stored as ``<root>/<name>``, or as ``<root>/<name>.parquet``. Only Spark
    looks at the path, so any file system that it knows will do."""
    path = f"{root.rstrip('/')}/{name}"
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as e:
        if fmt != "parquet" or name.endswith(".parquet") or e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.read.parquet(path + ".parquet")


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower=None, upper=None,
              num_partitions: int | None = None) -> DataFrame:
    """A source table over JDBC, split into ``num_partitions`` ranges of
    ``partition_column`` so the read is parallel. Range predicates applied later
    are pushed into the generated SQL."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower)).option("upperBound", str(upper))
                  .option("numPartitions", str(num_partitions or spark.sparkContext.defaultParallelism)))
    return reader.load()


class Sources:
    """Named source tables of one system, resolved lazily: from a dict of DataFrames,
    else from a root folder, or over JDBC, where ``jdbc`` holds what :func:`read_jdbc`
    takes for all tables and ``jdbc_partitions`` what it takes for single ones (unrun
    here, as there is no database server)."""

    def __init__(self, spark: SparkSession, root: str | None = None,
                 frames: dict[str, DataFrame] | None = None, fmt: str = "parquet",
                 jdbc: dict | None = None, jdbc_partitions: dict[str, dict] | None = None):
        self.spark, self.root, self.frames, self.fmt = spark, root, dict(frames or {}), fmt
        self.jdbc, self.jdbc_partitions = jdbc, jdbc_partitions or {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.frames:
            if self.jdbc is not None:
                self.frames[name] = read_jdbc(self.spark, table=name, **self.jdbc, **self.jdbc_partitions.get(name, {}))
            elif self.root is not None:
                self.frames[name] = read_table(self.spark, self.root, name, self.fmt)
            else:
                raise KeyError(name)
        return self.frames[name]


def windowed(df: DataFrame, ts: str, lo, hi) -> DataFrame:
    """Rows with ``lo <= ts <= hi`` (closed on both ends)."""
    return df.where(between_ts(ts, lo, hi))


def any_in_window(ranges: Sequence[tuple[str, object, object]]) -> Column:
    """Disjunction of closed windows, e.g. modified-in-window OR created-in-window."""
    cond = None
    for c, lo, hi in ranges:
        t = between_ts(c, lo, hi)
        cond = t if cond is None else cond | t
    return cond


def window_any(df: DataFrame, ranges: Sequence[tuple[str, object, object]]) -> DataFrame:
    return df.where(any_in_window(ranges))


def copy_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Full copy of a source table under warehouse column names (by name, not position)."""
    return df.select(*[F.col(src).alias(dst) for src, dst in mapping.items()])
