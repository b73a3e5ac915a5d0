"""Tables that grow with the facts are dealt by their keys in joins, not sent through the driver."""

import re
import uuid

from pyspark.sql import functions as F

from cadence.operators.conform import DimJoin, conform
from cadence.operators.dedup import insert_if_absent, replace_by_key
from cadence.plans import bugs
from cadence.sources.readers import Sources
from dates import ts


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def small(df, scratch):
    """``df`` as a stored table, which Spark knows to be small (it takes rows from Python for a large table)."""
    path = f"{scratch}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def test_growing_tables_are_dealt(spark, scratch):
    a, b = (small(spark.createDataFrame([(1, "x"), (None, "y"), (i, "z")], "k long, v string"), scratch) for i in (2, 3))
    for df, rows in ((insert_if_absent(a, b, ["k"]), {(3, "z")}),
                     (replace_by_key(a, b, ["k"]), {(1, "x"), (None, "y"), (2, "z"), (3, "z")})):
        assert "Broadcast" not in plan(df) and "SortMergeJoin" in plan(df)
        assert {tuple(r) for r in df.collect()} == rows
    raw = spark.createDataFrame([("e", ts("2014-06-01 10:00:00"))], "email string, t timestamp_ntz")
    people = small(spark.createDataFrame([("e", 7)], "email string, contributor_key long"), scratch)
    out = conform(raw, F.col("t"), [DimJoin(people, {"email": "email"}, {"contributor_key": "contributor_key"}, how="inner", grows=True)])
    assert "Broadcast" not in plan(out) and out.first().contributor_key == 7


def test_bug_extract_sends_neither_bugs_nor_accounts_through_the_driver(spark, scratch):
    def make(rows, schema):
        return small(spark.createDataFrame(rows, schema), scratch)

    src = Sources(spark, frames={
        "longdescs": make([(1, 5, ts("2014-06-01 10:00:00"))], "bug_id long, who long, bug_when timestamp_ntz"),
        "bugs": make([(1, 2, 3, "NEW")], "bug_id long, product_id long, component_id long, bug_status string"),
        "products": make([(2, "P")], "id long, name string"), "components": make([(3, "C")], "id long, name string"),
        "profiles": make([(5, "a@x")], "userid long, login_name string")})
    out = bugs.extract_comments(src, "2014-06-01 00:00:00", "2014-06-02 00:00:00")
    assert set(re.findall(r"SortMergeJoin \[(\w+?)#", plan(out))) == {"bug_id", "who"}
    assert [(r.contributor_email, r.product) for r in out.collect()] == [("a@x", "P")]
