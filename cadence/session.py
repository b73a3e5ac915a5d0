"""Session factory and the few session-level settings the library relies on."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

# Settings every job in this library is written against. They are defaults only:
# a cluster that already sets a key keeps its own value.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.parquet.datetimeRebaseModeInWrite": "CORRECTED",
}


def get_spark(app: str = "cadence", master: str | None = None,
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Return the active session or build one with :data:`DEFAULT_CONF`.

    ``master`` is only applied when given (tests pass ``local[*]``); on a cluster
    the launcher decides. Defaults never replace a value that the launcher or the
    active session's application has set; ``extra`` is set always.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    active = SparkSession.getActiveSession()
    given = dict((active.sparkContext.getConf() if active else SparkConf()).getAll())
    conf = {k: v for k, v in DEFAULT_CONF.items() if k not in given}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Read from the session. Where nothing is configured a scratch folder is made in
    local mode only (tests); on a cluster that folder would be another one on each
    machine, so there it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all machines share (master {sc.master})")
        configured = tempfile.mkdtemp(prefix="cadence-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def _cut_root(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables"


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder and read
    it back.

    One job writes it (task failures are retried; no executor-local state), and the
    returned frame scans columnar files with statistics and filter pushdown, which a
    ``Dataset.checkpoint`` (an RDD computed twice unless cached) would not give. The
    table stays until :func:`drop_cut_tables`, as frames may read it any time later;
    where the end of its use is known, take :func:`materialised`.
    """
    return _write_cut(df)[0]


def _write_cut(df: DataFrame) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = f"{_cut_root(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


@contextlib.contextmanager
def materialised(df: DataFrame) -> Iterator[DataFrame]:
    """:func:`cut_lineage` for the length of a ``with`` block; the table is deleted after it."""
    out, path = _write_cut(df)
    try:
        yield out
    finally:
        _delete(df.sparkSession, path)


def drop_cut_tables(spark: SparkSession) -> None:
    """Delete every table this application has cut. Frames that read one are void then."""
    _delete(spark, _cut_root(spark))
