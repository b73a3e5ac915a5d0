"""Joins of facts with dimensions in the weekly job: facts are neither broadcast nor worked on in a task a dimension key."""

import datetime as dt
import re

from pyspark.sql import functions as F

from cadence.operators.hop import every_monday
from cadence.operators.joins import broadcast_counted
from cadence.plans import aggregate
from cadence.plans.snapshot import SNAPSHOT_KEY, active_snapshot
from cadence.sources.sinks import Warehouse
from dates import d


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def facts(spark, n=40):
    rows = [(i, i % 3, i % 2, 0, dt.datetime(2014, 5, 1) + dt.timedelta(days=i)) for i in range(n)]
    return spark.createDataFrame(rows, "contributor_key long, conversion_key long, team_key long, source_key long, utc_datetime timestamp_ntz")


def wide_dim(spark, key, name):
    """Two members, of a table that Spark takes for a large one."""
    return spark.range(1_000_000).select((F.col("id") % 2).alias(key)).distinct().withColumn(name, F.col(key).cast("string"))


def test_snapshot_facts_are_not_broadcast_or_dealt_by_dimension(spark):
    level = wide_dim(spark, "conversion_key", "_").select("conversion_key", F.lit("active").alias("contributor_level"))
    snap = active_snapshot(facts(spark), level, wide_dim(spark, "team_key", "team_name"), wide_dim(spark, "source_key", "source_name"),
                           every_monday("2014-05-01 00:00:00", "2014-07-01 00:00:00"))
    text = plan(snap)
    joins = re.findall(r"(\w+Join) \[(\w+?)#", text)
    assert sorted(joins) == [("BroadcastHashJoin", k) for k in ("conversion_key", "source_key", "team_key")]
    assert "BuildLeft" not in text
    got = {(r.contributor_key, r.team_name, r.source_name) for r in snap.collect()}
    assert got == {(i, str(i % 2), "0") for i in range(40) if i % 3 < 2}


def test_large_dimension_is_not_broadcast(spark):
    dim = spark.range(30).select(F.col("id").alias("team_key"))
    assert "ResolvedHint" not in broadcast_counted(dim, 29)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" in broadcast_counted(dim, 30)._jdf.queryExecution().analyzed().toString()


def test_snapshot_rows_of_a_window_are_not_sorted_for_the_first_of_a_key(spark, scratch):
    wh = Warehouse(spark, scratch)
    mondays = [d("2014-06-02") + dt.timedelta(days=7 * i) for i in range(4)]
    wh.insert_new("utc_date_only", spark.createDataFrame([(m,) for m in mondays], "utc_date_only date"), ["utc_date_only"])
    facts(spark).write.parquet(f"{scratch}/plain")
    rows = spark.read.parquet(f"{scratch}/plain").withColumn("utc_date_key", F.date_format("utc_datetime", "yyyyMMdd").cast("int"))
    wh.insert_new("contributor_facts", rows.withColumn("canonical", F.lit("c")), ["contributor_key", "utc_datetime"], partition_by=["utc_date_key"])
    dims = (wide_dim(spark, "conversion_key", "_").select("conversion_key", F.lit("active").alias("contributor_level")),
            wide_dim(spark, "team_key", "team_name"), wide_dim(spark, "source_key", "source_name"))
    aggregate.run(wh, f"{mondays[0]} 00:00:00", f"{mondays[1]} 00:00:00", *dims)
    out = aggregate.snapshot_window(wh, f"{mondays[1]} 00:00:00", f"{mondays[3]} 00:00:00", *dims)
    assert "row_number()" not in plan(out)
    keys = [tuple(r) for r in out.select(*SNAPSHOT_KEY).collect()]
    assert len(keys) == len(set(keys)) and {k[1] for k in keys} >= set(mondays[2:])
