"""Helpers shared by the operators: table reads, Arrow batches, materialised steps."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.session import cut_lineage

#: Rows handed to Python at a time. Documents may be long, so a batch stays small.
ARROW_ROWS = 512


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the rows of an Arrow batch, unless the session already asks for fewer."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]],
              schema: str) -> DataFrame:
    """``df.mapInArrow`` with small batches; workers look for this package where the driver has it."""
    small_batches(df.sparkSession)
    env, root = df.sparkSession.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH", ""), root]))
    return df.mapInArrow(fn, schema)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as a table under the session's checkpoint folder and read again,
    so that later steps neither recompute it nor depend on executor-local files."""
    return cut_lineage(df)


def slices(texts: list[str], size: int) -> Iterator[tuple[int, int]]:
    """Index ranges of ``texts`` holding about ``size`` characters each."""
    lo = n = 0
    for i, t in enumerate(texts):
        n += len(t)
        if n >= size:
            yield lo, i + 1
            lo, n = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def text_or_empty(text_col: str):
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))
