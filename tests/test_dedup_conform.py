from pyspark.sql import functions as F

from cadence.operators.conform import DimJoin, conform
from cadence.operators.dedup import insert_if_absent, replace_by_key
from cadence.operators.joins import lookup_const, with_const_lookups
from cadence.operators.rules import fan_out_rules
from cadence.sources.sinks import Warehouse
from dates import ts


def test_insert_if_absent_and_replace(spark):
    b1 = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 3), (None, "n", 4), (None, "m", 5)],
                               "k long, v string, o int")
    b2 = spark.createDataFrame([(1, "z", 0), (3, "d", 1), (3, "e", 2)], "k long, v string, o int")
    t1 = insert_if_absent(None, b1, ["k"], ["o"])
    assert sorted((r.k, r.v) for r in t1.collect() if r.k is not None) == [(1, "a"), (2, "c")]
    assert [r.v for r in t1.collect() if r.k is None] == ["n"]          # NULL keys compare equal
    add = insert_if_absent(t1, b2, ["k"], ["o"])
    assert sorted((r.k, r.v) for r in add.collect()) == [(3, "d")]
    assert insert_if_absent(t1.unionByName(add), b2, ["k"], ["o"]).count() == 0   # re-run adds nothing
    r1 = replace_by_key(None, b1, ["k"], ["o"])
    r2 = replace_by_key(r1, b2, ["k"], ["o"])
    assert sorted((r.k or -1, r.v) for r in r2.collect()) == [(-1, "m"), (1, "z"), (2, "c"), (3, "e")]


def test_warehouse_idempotent(spark, scratch):
    wh = Warehouse(spark, scratch)
    rows = spark.createDataFrame([(1, "a", 20140602), (2, "b", 20140603)], "k long, v string, p int")
    wh.insert_new("t", rows, ["k"], partition_by=["p"])
    wh.insert_new("t", rows, ["k"], partition_by=["p"])
    assert wh.table("t").count() == 2
    wh.upsert("t", spark.createDataFrame([(2, "B", 20140603)], "k long, v string, p int"), ["k"], partition_by=["p"])
    wh.upsert("t", spark.createDataFrame([(2, "B", 20140603)], "k long, v string, p int"), ["k"], partition_by=["p"])
    assert sorted((r.k, r.v) for r in wh.table("t").collect()) == [(1, "a"), (2, "B")]


def test_conform_unknown_member_fanout_and_inner(spark):
    raw = spark.createDataFrame([
        ("a@x", ts("2014-06-02 20:00:00"), "NEW", "Core", "Gfx"),
        ("a@x", ts("2014-06-02 21:00:00"), "NEW", "Nope", "Nope"),
        ("b@x", ts("2014-06-02 22:00:00"), "NEW", "Core", "Gfx"),     # no contributor row: dropped
    ], "email string, t timestamp_ntz, status string, product string, component string")
    contributor = spark.createDataFrame([(7, "a@x")], "contributor_key long, email string")
    product = spark.createDataFrame([(1, "Core"), (2, "Other")], "product_key long, product_name string")
    # one component name under two products: a name join fans out
    component = spark.createDataFrame([(10, "Gfx", 1), (11, "Gfx", 2)],
                                      "component_key long, component_name string, product_key long")
    out = conform(raw, F.col("t"), [
        DimJoin(contributor, {"email": "email"}, {"contributor_key": "contributor_key"}, how="inner"),
        DimJoin(product, {"product": "product_name"}, {"product_key": "product_key"}),
        DimJoin(component, {"component": "component_name"}, {"component_key": "component_key"},
                default={"component_key": 0}),
    ]).collect()
    got = sorted((str(r.utc_datetime), r.product_key, r.component_key, r.utc_date_key) for r in out)
    assert got == [("2014-06-02 20:00:00", 1, 10, 20140602), ("2014-06-02 20:00:00", 1, 11, 20140602),
                   ("2014-06-02 21:00:00", None, 0, 20140602)]   # no coercion: NULL product, component 0


def test_const_lookup_missing_row_empties_result(spark):
    facts = spark.createDataFrame([(1,), (2,)], "i int")
    dim = spark.createDataFrame([(5, "Filing a bug")], "conversion_key long, conversion_desc string")
    ok = with_const_lookups(facts, {"k": lookup_const(dim, "conversion_desc", "Filing a bug", "conversion_key")})
    assert sorted(r.k for r in ok.collect()) == [5, 5]
    gone = with_const_lookups(facts, {"k": lookup_const(dim, "conversion_desc", "Unknown", "conversion_key")})
    assert gone.count() == 0
    # names compare exactly (case matters)
    assert with_const_lookups(facts, {"k": lookup_const(dim, "conversion_desc", "filing a bug",
                                                        "conversion_key")}).count() == 0


def test_rule_fan_out(spark):
    df = spark.createDataFrame([("comment",), ("product",), ("other",)], "fields string")
    out = fan_out_rules(df, {"c": F.col("fields") == "comment", "any": F.col("fields").isin("comment", "product")})
    assert sorted((r.fields, r.conversion_desc) for r in out.collect()) == \
        [("comment", "any"), ("comment", "c"), ("product", "any")]


def test_case_option_and_component_by_product(spark):
    facts = spark.createDataFrame([(1,)], "i int")
    dim = spark.createDataFrame([(6, "Orchard")], "team_key long, team_name string")
    assert with_const_lookups(facts, {"k": lookup_const(dim, "team_name", "orchard", "team_key")}).count() == 0
    assert with_const_lookups(facts, {"k": lookup_const(dim, "team_name", "orchard", "team_key",
                                                       ignore_case=True)}).first().k == 6
    raw = spark.createDataFrame([("a@x", "orchard")], "email string, team string")
    out = conform(raw, F.lit(None).cast("timestamp_ntz"), [
        DimJoin(dim, {"team": "team_name"}, {"team_key": "team_key"}, ignore_case=True)]).first()
    assert out.team_key == 6


def test_component_matched_with_its_product(spark):
    from cadence.plans import bugs
    raw = spark.createDataFrame([("a@x", ts("2014-06-02 10:00:00"), None, "f", 1, None, None, None, "NEW", "Core", "Gfx")],
                                "contributor_email string, local_datetime timestamp_ntz, tz_offset interval day to second, "
                                "fields string, bug_id long, added_values string, removed_values string, "
                                "attachment_id long, status string, product string, component string") \
        .withColumn("tz_offset", F.make_dt_interval(F.lit(0)))
    contributor = spark.createDataFrame([(7, "a@x")], "contributor_key long, email string")
    cal = spark.createDataFrame([(20140602, ts("2014-06-02 00:00:00").date())], "utc_date_key int, utc_date_only date")
    status = spark.createDataFrame([(1, "NEW")], "status_key long, status_name string")
    product = spark.createDataFrame([(1, "Core"), (2, "Other")], "product_key long, product_name string")
    component = spark.createDataFrame([(10, "Gfx", 1), (11, "Gfx", 2)],
                                      "component_key long, component_name string, product_key long")
    as_written = bugs.conform_facts(raw, contributor, cal, status, product, component)
    assert sorted(r.component_key for r in as_written.collect()) == [10, 11]          # fan-out, as written
    scoped = bugs.conform_facts(raw, contributor, cal, status, product, component, component_by_product=True)
    assert [r.component_key for r in scoped.collect()] == [10]


def test_long_keys_are_compared_by_digest(spark):
    from cadence.operators.dedup import insert_if_absent, pick_per_key

    a, b = "x" * 70_000, "x" * 69_999 + "y"
    stored = spark.createDataFrame([(1, a, "s"), (2, None, "s")], "k long, c string, v string")
    batch = spark.createDataFrame([(1, a, "n"), (1, b, "n"), (1, b, "o"), (2, None, "n"), (2, "", "n"), (2, "x", "n")], "k long, c string, v string")
    assert sorted((r.k, len(r.c), r.v) for r in insert_if_absent(stored, batch, ["k", "c"]).collect()) == [(1, 70_000, "n"), (2, 0, "n"), (2, 1, "n")]
    assert pick_per_key(batch, ["k", "c"]).count() == 5
    plan = insert_if_absent(stored, batch, ["k", "c"])._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "sha2" in plan
