import os

from cadence import cli
from cadence.sources.sinks import Warehouse
from dates import ts
from source_rows import bug_sources, conversion_dim, source_dim, team_dim


def test_cli_topic_then_aggregate(spark, scratch):
    src_dir, wh_dir = os.path.join(scratch, "src"), os.path.join(scratch, "wh")
    frames = bug_sources(spark)
    # a comment on Monday 2014-06-09 puts that Monday in the calendar
    frames["longdescs"] = frames["longdescs"].unionByName(
        spark.createDataFrame([(100, 3, ts("2014-06-09 00:00:00"))], "bug_id long, who long, bug_when timestamp_ntz"))
    for name, df in frames.items():
        df.write.parquet(os.path.join(src_dir, name))
    wh = Warehouse(spark, wh_dir)
    for name, df in {"conversion": conversion_dim(spark), "source": source_dim(spark), "team": team_dim(spark)}.items():
        df.write.parquet(wh.path(name))
    assert cli.main(["--warehouse", wh_dir, "--sources", src_dir, "bugs",
                     "2014-06-01 00:00:00", "2014-06-09 00:00:00"]) == 0
    assert wh.table("contributor_facts").count() > 0
    assert cli.main(["--warehouse", wh_dir, "aggregate", "2014-06-01 00:00:00", "2014-06-09 00:00:00"]) == 0
    snap = wh.table("contributor_active").collect()
    assert snap and {str(r.c_date) for r in snap} == {"2014-06-09"}
