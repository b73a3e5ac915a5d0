import os

from cadence.sources.sinks import Warehouse
from cadence.streaming import load_stream
from dates import ts

SCHEMA = "email string, local_datetime timestamp_ntz, fields string, bug_id long"


def test_stream_load_is_insert_if_absent(spark, scratch):
    landing = os.path.join(scratch, "landing")
    wh = Warehouse(spark, os.path.join(scratch, "wh"))
    ckpt = os.path.join(scratch, "ckpt")
    a = spark.createDataFrame([("a@x", ts("2014-06-01 10:00:00"), "comment", 1),
                               ("a@x", ts("2014-06-01 10:00:00"), "comment", 1),
                               ("b@x", ts("2014-06-01 11:00:00"), "comment", 2)], SCHEMA)
    a.write.mode("append").parquet(landing)
    schema = a.schema
    key = ["email", "local_datetime", "fields", "bug_id"]
    q = load_stream(spark, landing, schema, wh, "raw", key, checkpoint=ckpt)
    q.awaitTermination(120)
    assert wh.table("raw").count() == 2
    # an overlapping extract lands later: only the new row is added
    b = spark.createDataFrame([("b@x", ts("2014-06-01 11:00:00"), "comment", 2),
                               ("c@x", ts("2014-06-01 12:00:00"), "comment", 3)], SCHEMA)
    b.write.mode("append").parquet(landing)
    q = load_stream(spark, landing, schema, wh, "raw", key, checkpoint=ckpt)
    q.awaitTermination(120)
    assert sorted(r.email for r in wh.table("raw").collect()) == ["a@x", "b@x", "c@x"]
