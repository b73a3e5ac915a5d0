"""Surrogate keys under colliding hashes; ordered lists put together from fragments."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cadence.operators import aggregates
from cadence.operators.aggregates import group_ordered_list, whole_lists
from cadence.operators.dims import key_collisions, number_members, surrogate_key
from cadence.plans.common import insert_members
from cadence.sources.sinks import Warehouse
from dates import ts


def members(spark, lo, hi):
    return spark.range(lo, hi).select(F.concat(F.lit("m"), "id").alias("name"), F.when(F.col("id") % 3 != 0, F.col("id") % 7).alias("part"))


def test_eight_bit_hashes_collide_and_are_told_apart(spark):
    df = members(spark, 0, 150)
    assert df.select(surrogate_key("name", "part", bits=8).alias("k")).distinct().count() < 130
    with number_members(df, ["name", "part"], "k", bits=8) as keyed:
        got = {(r.name, r.part): r.k for r in keyed.collect()}
        assert len(got) == len(set(got.values())) == 150 and 0 not in got.values() and max(got.values()) < 256
        assert key_collisions(keyed, "k", ["name", "part"]).isEmpty()
        taken = keyed.select("k")
        with number_members(members(spark, 150, 200), ["name", "part"], "k", taken, bits=8) as more:
            new = [r.k for r in more.collect()]
    assert len(set(new) | set(got.values())) == 200 and len(new) == 50
    with number_members(df, ["name", "part"], "k", bits=8) as again:
        assert {(r.name, r.part): r.k for r in again.collect()} == got
    with pytest.raises(ValueError, match="no free"):
        with number_members(members(spark, 0, 300), ["name", "part"], "k", bits=8, probes=5):
            pass


def test_without_collisions_the_key_is_the_hash(spark):
    df = members(spark, 0, 20)
    with number_members(df, ["name", "part"], "k") as keyed:
        assert keyed.where(F.col("k") != surrogate_key("name", "part")).isEmpty() and keyed.count() == 20
    with number_members(df.limit(0), ["name", "part"], "k") as none:
        assert none.count() == 0


def test_members_keep_their_keys_over_loads(spark, scratch):
    wh = Warehouse(spark, scratch)
    first = {r.name: r.k for r in insert_members(wh, "dim", members(spark, 0, 30), ["name", "part"], "k", team=F.lit(None).cast("long")).collect()}
    dim = insert_members(wh, "dim", members(spark, 20, 40), ["name", "part"], "k", team=F.lit(None).cast("long"))
    got = {r.name: r.k for r in dim.collect()}
    assert dim.columns == ["k", "name", "part", "team"] and len(got) == len(set(got.values())) == 40 and first.items() <= got.items()


def test_fragments_give_the_same_lists(spark, monkeypatch):
    rows = [(None if i % 4 == 3 else i % 4, ts("2014-06-01 00:00:00") + dt.timedelta(minutes=(i * 37) % 60), None if i % 11 == 0 else f"v{i % 23}")
            for i in range(600)] + [(9, ts("2014-06-01 00:00:00"), None)] + [(8, ts("2014-06-01 00:00:00"), "same")] * 50
    df = spark.createDataFrame(rows, "g int, t timestamp_ntz, v string")
    extra = [F.count(F.lit(1)).alias("n"), F.max("t").alias("last")]
    want = sorted(map(str, group_ordered_list(df, "g", "t", "v", extra=extra).collect()))
    monkeypatch.setattr(aggregates, "FRAGMENT_VALUES", 7)
    assert sorted(map(str, group_ordered_list(df, "g", "t", "v", extra=extra).collect())) == want
    one = {r.g: r.canonical for r in whole_lists(df, ["g"], "t", "v").collect()}
    assert one[8] == ",".join(["same"] * 50) and 9 not in one
    assert one[0] == ",".join(v for _, v in sorted((t, v) for g, t, v in rows if g == 0 and v is not None))
