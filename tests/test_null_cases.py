"""NULL values, keys and partitions, late data and order of runs, on hand-written rows."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from source_rows import bug_sources, conversion_dim, source_dim, team_dim

from cadence.functions.timefn import YEAR
from cadence.operators.aggregates import group_ordered_list
from cadence.operators.dims import key_collisions, surrogate_key
from cadence.operators.hop import every_monday
from cadence.operators.joins import lookup_const
from cadence.operators.windows import threshold_rollup
from cadence.plans import aggregate, bugs, reports
from cadence.sources.readers import Sources, read_table
from cadence.sources.sinks import Warehouse
from dates import d, ts

LO, HI = "2014-06-01 00:00:00", "2014-06-02 00:00:00"


def test_capped_list_skips_nulls_before_the_cut(spark):
    rows = [(g, ts(f"2014-06-01 0{i}:00:00"), None) for g in ("a", None) for i in range(3)] + \
           [("a", ts("2014-06-01 09:00:00"), "ab"), (None, ts("2014-06-01 09:00:00"), "cd"), ("b", ts("2014-06-01 09:00:00"), None)]
    df = spark.createDataFrame(rows, "g string, t timestamp_ntz, v string")
    for extra in ([], [F.count(F.lit(1)).alias("n")]):
        got = {r.g: r.canonical for r in group_ordered_list(df, "g", "t", "v", max_len=2, extra=extra).collect()}
        assert got == {"a": "ab", None: "cd", "b": None}
    mondays = every_monday("2014-06-02 00:00:00", "2014-06-02 00:00:00")
    for method in ("auto", "explode"):
        out = threshold_rollup(df, ["g"], "t", mondays, YEAR, [1], canon="v", concat="list", max_len=2, method=method).collect()
        assert {r.g: (r.cnt, r.canonical) for r in out} == {"a": (4, "ab"), None: (4, "cd"), "b": (1, None)}


@pytest.mark.parametrize("max_len", [1, 2, 7, 30, 65000])
def test_capped_lists_equal_the_cut_full_list(spark, max_len):
    rows = [(i % 3, ts("2014-06-01 00:00:00") + dt.timedelta(minutes=(i * 37) % 50), None if i % 7 == 0 else "x" * (i % 5)) for i in range(200)]
    df = spark.createDataFrame(rows, "g int, t timestamp_ntz, v string")
    want = {g: ",".join(v for _, v in sorted((t, v) for h, t, v in rows if h == g and v is not None))[:max_len] for g in range(3)}
    assert {r.g: r.canonical for r in group_ordered_list(df, "g", "t", "v", max_len=max_len).collect()} == want


def test_null_partitions_in_both_sinks(spark, scratch):
    wh = Warehouse(spark, scratch)
    rows = spark.createDataFrame([(1, None, "a"), (2, None, "b")], "k int, p int, v string")
    for _ in range(2):
        wh.insert_new("t", rows, ["k"], partition_by=["p"])
    assert wh.table("t").count() == 2
    wh.upsert("t", spark.createDataFrame([(1, None, "c")], "k int, p int, v string"), ["k"], partition_by=["p"])
    assert sorted((r.k, r.v) for r in wh.table("t").collect()) == [(1, "c"), (2, "b")]


def test_partition_columns_keep_their_type(spark, scratch):
    wh = Warehouse(spark, scratch)
    wh.insert_new("t", spark.createDataFrame([(1, "007")], "k int, p string"), ["k"], partition_by=["p"])
    assert [(r.k, r.p) for r in wh.table("t").collect()] == [(1, "007")] and wh.table("t").dtypes == [("k", "int"), ("p", "string")]


def test_partitioned_writes_make_few_files(spark, scratch):
    wh = Warehouse(spark, scratch)
    wh.insert_new("t", spark.range(4000).repartition(8).select("id", (F.col("id") % 50).alias("p")), ["id"], partition_by=["p"])
    files = [f for _, _, fs in os.walk(os.path.join(scratch, "t")) for f in fs if f.endswith(".parquet")]
    assert 50 <= len(files) <= 110


def test_unpartitioned_replace_switches_folders(spark, scratch):
    wh = Warehouse(spark, scratch)
    for v in ("a", "b"):
        wh.upsert("t", spark.createDataFrame([(1, v), (2, "x")], "k int, v string"), ["k"])
    assert sorted((r.k, r.v) for r in wh.table("t").collect()) == [(1, "b"), (2, "x")]
    boom = F.udf(lambda x: 1 / 0, "string")
    with pytest.raises(Exception):
        wh.upsert("t", spark.createDataFrame([(1, "c")], "k int, v string").withColumn("v", boom("v")), ["k"])
    assert sorted((r.k, r.v) for r in wh.table("t").collect()) == [(1, "b"), (2, "x")]


def test_first_run_over_an_empty_window(spark, scratch):
    wh = Warehouse(spark, scratch)
    src = Sources(spark, frames=bug_sources(spark))
    bugs.run(wh, src, "2001-01-01 00:00:00", "2001-01-02 00:00:00", conversion_dim(spark), source_dim(spark), team_dim(spark))
    assert wh.table(bugs.FACTS).count() == 0 and wh.table("contributor_facts").count() == 0
    bugs.run(wh, src, LO, HI, conversion_dim(spark), source_dim(spark), team_dim(spark))
    assert wh.table(bugs.FACTS).count() > 0


def test_older_comment_loaded_later_takes_the_flag(spark, scratch):
    wh = Warehouse(spark, scratch)
    src = Sources(spark, frames=bug_sources(spark))
    dims = conversion_dim(spark), source_dim(spark), team_dim(spark)
    bugs.run(wh, src, LO, HI, *dims)
    flagged = lambda: sorted({(r.bug_id, str(r.utc_datetime)) for r in wh.table(bugs.FACTS).where("comment_num = 0").collect()})
    assert flagged() == [(100, "2014-06-01 10:00:00")]
    older = spark.createDataFrame([(100, 2, ts("2014-05-20 07:00:00"))], "bug_id long, who long, bug_when timestamp_ntz")
    src.frames["longdescs"] = src["longdescs"].unionByName(older)
    for _ in range(2):
        bugs.run(wh, src, "2014-05-20 00:00:00", "2014-05-21 00:00:00", *dims)
        assert flagged() == [(100, "2014-05-20 07:00:00")]
    bugs.run(wh, src, LO, HI, *dims)
    assert flagged() == [(100, "2014-05-20 07:00:00")]


def test_is_new_does_not_depend_on_the_order_of_runs(spark, scratch):
    facts = spark.createDataFrame([(1, 1, 1, 1, ts("2014-06-05 10:00:00"), 20140605)],
                                  "contributor_key long, conversion_key long, team_key long, source_key long, utc_datetime timestamp_ntz, utc_date_key int")
    conv = spark.createDataFrame([(1, "active")], "conversion_key long, contributor_level string")
    team = spark.createDataFrame([(1, "t")], "team_key long, team_name string")
    source = spark.createDataFrame([(1, "s")], "source_key long, source_name string")
    cal = spark.createDataFrame([(d(x),) for x in ("2014-06-09", "2014-06-16", "2014-06-23")], "utc_date_only date")
    cal = cal.withColumns({"day_of_week": F.date_format("utc_date_only", "EEEE")})
    results = []
    for k, order in enumerate((("09", "16", "23"), ("23", "16", "09"), ("16", "23", "09"))):
        wh = Warehouse(spark, os.path.join(scratch, str(k)))
        facts.write.parquet(os.path.join(scratch, str(k), "contributor_facts"))
        cal.write.parquet(os.path.join(scratch, str(k), "utc_date_only"))
        for day in order:
            aggregate.run(wh, f"2014-06-{day} 00:00:00", f"2014-06-{day} 00:00:00", conv, team, source)
        results.append(sorted((r.c_date, r.is_new) for r in wh.table("contributor_active").collect()))
    assert results[0] == results[1] == results[2] == [(d("2014-06-09"), 1), (d("2014-06-16"), 0), (d("2014-06-23"), 0)]


def test_surrogate_keys_keep_the_place_of_nulls(spark):
    df = spark.createDataFrame([("p", 5.0, None), ("p", None, 5.0), (None, None, None), ("", None, None)], "a string, b double, c double")
    keyed = df.select(surrogate_key("a", "b", "c").alias("k"), "*")
    assert keyed.select("k").distinct().count() == 4 and key_collisions(keyed, "k", ["a", "b", "c"]).count() == 0
    assert [r.members for r in key_collisions(keyed.withColumn("k", F.lit(1)), "k", ["a", "b", "c"]).collect()] == [4]
    raw = spark.createDataFrame([("p", 5.0, None), ("p", None, 5.0)], "location string, longitude double, latitude double")
    assert reports.location_members(raw, None).select("location_key").distinct().count() == 2


def test_duplicate_dim_name_takes_the_least_key(spark):
    dim = spark.createDataFrame([(7, "x"), (3, "x"), (1, "y")], "key long, name string")
    got = spark.range(2).select(lookup_const(dim, "name", "x", "key").alias("k"), lookup_const(dim, "name", "z", "key").alias("none"))
    assert [(r.k, r.none) for r in got.collect()] == [(3, None), (3, None)]


def test_duplicate_names_give_one_row_wherever_a_key_is_looked_up(spark):
    from cadence.plans.conversions import Team, attach_keys, key_by_threshold

    t = spark.createDataFrame
    conversion = t([(9, "c"), (2, "c"), (5, "n 4"), (4, "n 4"), (7, "n 10")], "conversion_key long, conversion_desc string")
    team, source = t([(8, "t"), (3, "t")], "team_key long, team_name string"), t([(6, "s"), (1, "s")], "source_key long, source_name string")
    rows = t([("u", ts("2014-06-01 00:00:00"), 1, 11, "c", "t")], "canonical string, utc_datetime timestamp_ntz, cnt int, contributor_key long, conversion_desc string, own string")
    for how in (Team(by_column="own"), Team(fixed="t")):
        assert [(r.conversion_key, r.source_key, r.team_key) for r in attach_keys(rows, conversion, source, "s", how, team).collect()] == [(2, 1, 3)]
    found = t([(4,), (10,)], "threshold int")
    for th in ((4,), (4, 10)):
        got = key_by_threshold(found.where(F.col("threshold").isin(*th)), conversion, th, lambda n: f"n {n}").collect()
        assert sorted((r.threshold, r.conversion_key) for r in got) == [(4, 4), (10, 7)][:len(th)]


def test_renamed_product_keeps_its_first_name(spark, scratch):
    wh = Warehouse(spark, scratch)
    src = Sources(spark, frames=bug_sources(spark))
    dims = conversion_dim(spark), source_dim(spark), team_dim(spark)
    bugs.run(wh, src, LO, HI, *dims)
    src.frames["products"] = src["products"].withColumn("name", F.concat(F.col("name"), F.lit(" renamed")))
    bugs.run(wh, src, LO, HI, *dims)
    assert not [r for r in wh.table("bug_product").collect() if r.product_name.endswith("renamed")]


def test_read_table_by_uri(spark):
    for root in ("file:///root/testdata/sf0.001", "/root/testdata/sf0.001"):
        assert read_table(spark, root, "nation").count() == 25
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_table(spark, "/root/testdata/sf0.001", "no_such_table")
