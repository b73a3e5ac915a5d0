"""Commits of the warehouse: what readers see, what is listed and rewritten, how files stay few."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from cadence.plans import hosting
from cadence.plans import names as N
from cadence.plans.common import insert_raw
from cadence.sources import sinks
from cadence.sources.readers import Sources
from cadence.sources.sinks import Warehouse
from dates import d, ts
from source_rows import conversion_dim, hosting_sources, source_dim, team_dim

SCHEMA = "k long, v string, p int"


def rows_of(wh, name="t"):
    return sorted(tuple(r) for r in wh.table(name).collect())


def files(root):
    return sorted(os.path.join(p, f) for p, _, fs in os.walk(root) for f in fs if f.endswith(".parquet"))


def broken(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("v", F.when(F.col("k") == rows[-1][0], F.raise_error(F.lit("lost"))).otherwise(F.col("v")))


def test_a_lost_write_leaves_the_old_state(spark, scratch):
    wh = Warehouse(spark, scratch)
    wh.insert_new("t", spark.createDataFrame([(1, "a", 1), (2, "b", 2)], SCHEMA), ["k"], partition_by=["p"])
    old = rows_of(wh)
    for write in (lambda x: wh.insert_new("t", x, ["k", "p"], partition_by=["p"], within=(1, 9)), lambda x: wh.upsert("t", x, ["k"], partition_by=["p"]),
                  lambda x: wh.overwrite_partitions("t", x, ["p"])):
        with pytest.raises(Exception, match="lost"):
            write(broken(spark, [(1, "x", 1), (5, "y", 2), (6, "z", 3)]))
        assert rows_of(wh) == old


def test_lost_between_staging_and_the_log(spark, scratch, monkeypatch):
    wh = Warehouse(spark, scratch)
    wh.insert_new("t", spark.createDataFrame([(1, "a", 1), (2, "b", 2)], SCHEMA), ["k"], partition_by=["p"])
    with monkeypatch.context() as m:
        m.setattr(Warehouse, "_log", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            wh.overwrite_partitions("t", spark.createDataFrame([(7, "n", 1), (8, "n", 2)], SCHEMA), ["p"])
    assert rows_of(wh) == [(1, "a", 1), (2, "b", 2)]
    wh.overwrite_partitions("t", spark.createDataFrame([(7, "n", 1)], SCHEMA), ["p"])
    assert rows_of(wh) == [(2, "b", 2), (7, "n", 1)]
    staged = len(files(scratch + "/t"))
    wh.vacuum("t")
    assert rows_of(wh) == [(2, "b", 2), (7, "n", 1)] and staged > len(files(scratch + "/t")) == 2


def test_a_reader_keeps_the_state_it_opened(spark, scratch):
    wh = Warehouse(spark, scratch)
    wh.insert_new("t", spark.createDataFrame([(1, "a", 1), (2, "b", 2)], SCHEMA), ["k"], partition_by=["p"])
    opened = wh.table("t")
    wh.overwrite_partitions("t", opened.withColumn("v", F.lit("new")), ["p"])
    assert sorted(r.v for r in opened.collect()) == ["a", "b"] and sorted(r.v for r in wh.table("t").collect()) == ["new", "new"]


def test_two_writers_are_noticed(spark, scratch):
    wh = Warehouse(spark, scratch)
    wh.insert_new("t", spark.createDataFrame([(1, "a", 1)], SCHEMA), ["k"])
    stale = wh._entry("t")
    wh.insert_new("t", spark.createDataFrame([(2, "b", 1)], SCHEMA), ["k"])
    with pytest.raises(RuntimeError, match="another job"):
        wh._log("t", stale | {"version": stale["version"] + 1})
    assert len(rows_of(wh)) == 2


def test_exchange_retracts_and_inserts_at_once(spark, scratch):
    wh = Warehouse(spark, scratch)
    wh.insert_new("t", spark.createDataFrame([(1, "a", 1), (2, "a", 1), (3, "b", 2), (4, "c", 3)], SCHEMA), ["k"], partition_by=["p"])
    far = files(scratch + "/t")
    new = spark.createDataFrame([(2, "again", 1), (3, "no", 2), (5, "e", 4), (6, "f", 1)], SCHEMA)
    gone = spark.createDataFrame([("a", 1), ("x", 9)], "v string, p int")
    version = wh._entry("t")["version"]
    wh.exchange("t", new, gone, ["k"], ["v"], ["p"])
    assert rows_of(wh) == [(2, "again", 1), (3, "b", 2), (4, "c", 3), (5, "e", 4), (6, "f", 1)]
    assert wh._entry("t")["version"] == version + 1 and set(far) <= set(files(scratch + "/t"))
    wh.exchange("t", new, gone, ["k"], ["v"], ["p"])
    wh.exchange("t", new, gone.limit(0), ["k"], ["v"], ["p"], within=(1, 9))
    assert len(rows_of(wh)) == 5 and wh._entry("t")["version"] == version + 1


def test_many_runs_leave_few_files(spark, scratch, monkeypatch):
    monkeypatch.setattr(sinks, "MAX_BATCHES", 4)
    wh = Warehouse(spark, scratch)
    for i in range(14):
        wh.insert_new("dim", spark.createDataFrame([(i, "m", 0), (i - 1, "other", 0)], SCHEMA), ["k"], order=["v"])
        wh.insert_new("part", spark.createDataFrame([(i, "m", i % 2)], SCHEMA), ["k"], partition_by=["p"], within=(0, 1))
        assert all(len(b) <= 4 for t in ("dim", "part") for b in wh._entry(t)["parts"].values())
    assert [r[0] for r in rows_of(wh, "dim")] == list(range(-1, 14)) and [r[0] for r in rows_of(wh, "part")] == list(range(14))
    for t in ("dim", "part"):
        wh.vacuum(t)
    assert len(files(scratch + "/dim")) <= 4 and len(files(scratch + "/part")) <= 8
    assert len(rows_of(wh, "dim")) == 15 and len(rows_of(wh, "part")) == 14


def test_a_repeated_run_writes_no_entry(spark, scratch):
    wh = Warehouse(spark, scratch)
    df = spark.createDataFrame([(1, "a", 1), (2, None, None)], SCHEMA)
    for by in (None, ["p"]):
        for _ in range(2):
            wh.insert_new(f"t{bool(by)}", df, ["k", "p"], partition_by=by)
        assert wh._entry(f"t{bool(by)}")["version"] == 0 and len(rows_of(wh, f"t{bool(by)}")) == 2


def test_a_plain_folder_becomes_a_table(spark, scratch):
    wh = Warehouse(spark, scratch)
    spark.createDataFrame([(1, "a", 1), (2, "b", 2)], SCHEMA).write.parquet(wh.path("t"))
    assert wh.table("t").count() == 2
    wh.insert_new("t", spark.createDataFrame([(2, "x", 2), (3, "c", 3)], SCHEMA), ["k"], partition_by=["p"])
    assert rows_of(wh) == [(1, "a", 1), (2, "b", 2), (3, "c", 3)]


def test_between_lists_only_the_partitions_asked_for(spark, scratch):
    wh = Warehouse(spark, scratch)
    days = spark.range(30).select((F.col("id") + 20140601).cast("int").alias("p"), F.col("id").alias("k"))
    wh.insert_new("t", days, ["k"], partition_by=["p"])
    dates = days.select("k", F.date_add(F.lit(d("2014-06-01")), F.col("k").cast("int")).alias("p"))
    wh.insert_new("u", dates, ["k"], partition_by=["p"])
    assert len(wh.table("t", between=(20140603, 20140604)).inputFiles()) == 2
    assert len(wh.table("u", between=(d("2014-06-03"), d("2014-06-05"))).inputFiles()) == 3
    assert wh.table("t", between=(1, 2)).count() == 0 and len(wh.table("t").inputFiles()) == 30


def test_a_one_day_load_lists_one_day(spark, scratch, monkeypatch):
    wh = Warehouse(spark, scratch)
    src = Sources(spark, frames=hosting_sources(spark))
    first = src["activities"]
    dims = conversion_dim(spark), source_dim(spark), team_dim(spark)
    for day in range(5):
        src.frames["activities"] = first.withColumn("happened_on", F.col("happened_on") + F.make_dt_interval(F.lit(day)))
        insert_raw(wh, hosting.RAW, hosting.extract_activity(src, f"2014-06-{day + 1:02d} 00:00:00", f"2014-06-{day + 1:02d} 23:59:59"),
                   hosting.RAW_KEY, f"2014-06-{day + 1:02d} 00:00:00", f"2014-06-{day + 1:02d} 23:59:59")
    assert sorted(wh._entry(hosting.RAW)["parts"]) == [f"local_date_key=201406{i:02d}" for i in range(1, 6)]
    listed = []
    plain = Warehouse._rows
    monkeypatch.setattr(Warehouse, "_rows", lambda self, name, entry, parts: listed.append((name, list(parts))) or plain(self, name, entry, parts))
    src.frames["activities"] = first.withColumn("happened_on", F.col("happened_on") + F.make_dt_interval(F.lit(2)))
    before = len(files(scratch))
    hosting.run(wh, src, "2014-06-03 00:00:00", "2014-06-03 23:59:59", *dims)
    raw = [p for name, parts in listed if name == hosting.RAW for p in parts]
    assert raw and set(raw) == {"local_date_key=20140603"} and wh.table(hosting.RAW).count() == 10
    facts = [p for name, parts in listed if name == hosting.FACTS for p in parts]
    assert set(facts) <= {f"utc_date_key=2014060{i}" for i in (2, 3, 4)} and len(files(scratch)) > before
    assert N.PATCH_MERGED and dt and ts
