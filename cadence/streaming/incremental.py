"""Continuous form of the windowed load: extract files landing in a folder are
appended insert-if-absent to a warehouse table, one micro-batch at a time.

Replaying a micro-batch after a failure adds nothing (the sink dedups by key),
so together with the stream checkpoint the load is exactly-once. The caller names
the folder of that checkpoint, as it must be the same one after a restart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from cadence.sources.sinks import Warehouse


def load_stream(spark: SparkSession, landing: str, schema: StructType, wh: Warehouse, table: str,
                key: Sequence[str], order: Sequence = (), partition_by: Sequence[str] | None = None,
                fmt: str = "parquet", available_now: bool = True, *, checkpoint: str,
                max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the load; with ``available_now`` it processes what has landed and stops."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(landing)

    def write_batch(batch, _epoch_id):
        wh.insert_new(table, batch, key, order, partition_by)

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
