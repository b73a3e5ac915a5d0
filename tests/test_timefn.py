import datetime as dt

import duckdb
from pyspark.sql import functions as F

from cadence.functions.text import concat_strict, left_chars, literal_contains, regex_contains
from cadence.functions.timefn import (between_ts, calendar_attributes, date_key, hours_offset, mysql_week,
                                      offset_column, to_utc, ymd_month_name)
from dates import d, ts


def test_week_zero_and_first_sunday(spark):
    df = spark.createDataFrame([(d("2014-01-01"),), (d("2014-01-05"),), (d("2012-01-01"),), (d("2014-12-31"),)],
                               "x date")
    got = {r.x: r.w for r in df.select("x", mysql_week("x").alias("w")).collect()}
    assert got[d("2014-01-01")] == 0          # Wednesday before the first Sunday
    assert got[d("2014-01-05")] == 1          # first Sunday starts week 1
    assert got[d("2012-01-01")] == 1          # year starting on a Sunday
    assert got[d("2014-12-31")] == 52


def test_week_matches_sunday_week_numbering_over_many_years(spark):
    days = spark.range(0, 12419).select(F.date_add(F.lit(d("1990-01-01")), F.col("id").cast("int")).alias("x"))
    ours = {r.x: (r.w, r.dow) for r in days.select("x", mysql_week("x").alias("w"),
                                                   F.dayofweek("x").alias("dow")).collect()}
    con = duckdb.connect()
    ref = con.execute("SELECT CAST(x AS DATE), CAST(strftime(x, '%U') AS INT), dayofweek(x) + 1 "
                      "FROM range(DATE '1990-01-01', DATE '2024-01-01', INTERVAL 1 DAY) t(x)").fetchall()
    assert len(ref) == 12418
    for day, w, dow in ref:
        assert ours[day] == (w, dow)


def test_calendar_attributes_and_key(spark):
    df = spark.createDataFrame([(d("2014-06-02"),)], "x date")
    r = df.select(date_key("x").alias("k"), *calendar_attributes("x")).first()
    assert (r.k, r.dayOfWeek, r.weekOfYear, r.monthOfYear, r.year) == (20140602, 2, 22, 6, 2014)


def test_month_name_format(spark):
    df = spark.createDataFrame([(d("2014-06-02"),)], "x date")
    assert df.select(ymd_month_name("x")).first()[0] == "2014/June/2"


def test_closed_window_typed_bounds(spark):
    rows = [(ts("2014-06-01 00:00:00"),), (ts("2014-06-02 00:00:00"),), (ts("2014-05-31 23:59:59.999999"),),
            (ts("2014-06-02 00:00:00.000001"),)]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    got = sorted(r.t for r in df.where(between_ts("t", "2014-06-01 00:00:00", "2014-06-02 00:00:00")).collect())
    assert got == [ts("2014-06-01 00:00:00"), ts("2014-06-02 00:00:00")]


def test_utc_rollover_and_null_offset(spark):
    df = spark.createDataFrame([(ts("2014-06-02 20:00:00"), 7), (ts("2014-06-02 20:00:00"), None)],
                               "t timestamp_ntz, h int")
    out = df.select(to_utc("t", offset=hours_offset("h")).alias("u")).collect()
    assert out[0].u == ts("2014-06-03 03:00:00")
    assert out[1].u is None


def test_offset_rules_zone_and_dst(spark):
    # same local time on both sides of a daylight-saving change, with a zone
    df = spark.createDataFrame([(ts("2014-03-08 12:00:00"),), (ts("2014-03-10 12:00:00"),)], "t timestamp_ntz")
    got = [r.u for r in df.select(to_utc("t", tz="America/New_York").alias("u")).collect()]
    assert got == [ts("2014-03-08 17:00:00"), ts("2014-03-10 16:00:00")]
    # the offset column derived from the zone gives the same UTC time
    off = [r.u for r in df.select((F.col("t") + offset_column("t", tz="America/New_York")).alias("u")).collect()]
    assert off == got
    # neither zone nor offset: local time taken as UTC
    assert [r.u for r in df.select((F.col("t") + offset_column("t")).alias("u")).collect()] == \
        [ts("2014-03-08 12:00:00"), ts("2014-03-10 12:00:00")]
    # fixed offset from the source
    fixed = df.select((F.col("t") + offset_column("t", offset=dt.timedelta(hours=-7))).alias("u")).first().u
    assert fixed == ts("2014-03-08 05:00:00")


def test_text_helpers(spark):
    df = spark.createDataFrame([("review+", "a", 1), ("review-", None, 2), ("review?(x)", "b", 3)],
                               "s string, n string, i long")
    assert [r.c for r in df.select(concat_strict("u/", F.col("n"), "/", F.col("i")).alias("c")).collect()] == \
        ["u/a/1", None, "u/b/3"]
    assert df.select(left_chars(F.lit("éèàü"), 2)).first()[0] == "éè"
    # a literal '+' match does not accept "review-" or "review?"
    assert [r.s for r in df.where(literal_contains("s", "review+")).collect()] == ["review+"]
    # the regular expression review+ ("revie" then one or more "w") matches all three
    assert df.where(regex_contains("s", "review+")).count() == 3


def test_zone_at_clock_changes(spark):
    rows = [("2014-03-09 01:30:00", "2014-03-09 06:30:00"), ("2014-03-09 02:30:00", "2014-03-09 07:30:00"),   # 02:30 does not exist
            ("2014-03-09 03:00:00", "2014-03-09 07:00:00"), ("2014-11-02 00:30:00", "2014-11-02 04:30:00"),
            ("2014-11-02 01:30:00", "2014-11-02 05:30:00"), ("2014-11-02 02:00:00", "2014-11-02 07:00:00")]   # 01:30 comes twice
    df = spark.createDataFrame([(ts(a), ts(b)) for a, b in rows], "a timestamp_ntz, b timestamp_ntz")
    from cadence.functions.timefn import add_offset, offset_column, to_utc

    got = df.select(to_utc("a", tz="America/New_York").alias("x"), add_offset("a", offset_column("a", "America/New_York")).alias("y"), "b").collect()
    assert all(r.x == r.y == r.b for r in got)
