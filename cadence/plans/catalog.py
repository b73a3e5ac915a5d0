"""Queries over the driver's test tables, each with an independent SQL oracle.

Roles the test tables play in the contribution warehouse:

* history  = ``orders`` (contributor ``o_custkey``, time ``o_orderdate``, source
  ``o_orderstatus``, conversion ``o_orderpriority``, team ``c_mktsegment``),
* activity = ``events`` (contributor ``user_id``, time ``ts``, action ``event_type``),
* item log = ``lineitem`` joined to ``part`` (contributor ``l_suppkey``, canonical
  from ``p_type``, conversion ``l_returnflag``, time ``l_shipdate``).

Each query reads whole tables; window bounds are the feature being tested, never
a way to shrink the input.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from cadence.functions.timefn import YEAR
from cadence.operators.dims import calendar
from cadence.operators.hop import calendar_mondays
from cadence.plans.snapshot import active_snapshot, flag_new

from cadence.plans.registry import ORACLE, QUERIES, register, table  # noqa: F401


# ------------------------------------------------------------------ history

HIST_LO, HIST_HI = "1996-01-01 00:00:00", "1997-12-31 00:00:00"
ACTIVE_PRIORITIES = ("1-URGENT", "2-HIGH")


def history_warehouse(spark: SparkSession, d: str):
    """``orders`` as contributor facts plus its conversion / team / source dims."""
    orders = table(spark, d, "orders")
    customer = table(spark, d, "customer")
    facts = (orders.join(customer.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
             .select(F.col("o_custkey").alias("contributor_key"), F.col("o_orderdate").alias("utc_datetime"),
                     F.col("o_orderpriority").alias("conversion_key"), F.col("c_mktsegment").alias("team_key"),
                     F.col("o_orderstatus").alias("source_key"), F.col("o_orderkey")))
    conversion = (orders.select(F.col("o_orderpriority").alias("conversion_key")).distinct()
                  .withColumn("contributor_level",
                              F.when(F.col("conversion_key").isin(*ACTIVE_PRIORITIES), "active").otherwise("casual")))
    team = customer.select(F.col("c_mktsegment").alias("team_key")).distinct().withColumn("team_name", F.col("team_key"))
    source = orders.select(F.col("o_orderstatus").alias("source_key")).distinct().withColumn("source_name", F.col("source_key"))
    cal = calendar(orders.select(F.to_date("o_orderdate").alias("utc_date_only")))
    return facts, conversion, team, source, cal


_HIST_SNAPSHOT_SQL = f"""
WITH cal AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders),
mondays AS (SELECT d FROM cal WHERE dayofweek(d) = 1
            AND CAST(d AS TIMESTAMP) BETWEEN TIMESTAMP '{HIST_LO}' AND TIMESTAMP '{HIST_HI}'),
facts AS (SELECT o.o_custkey AS contributor_key, o.o_orderdate AS utc_datetime,
                 c.c_mktsegment AS team_name, o.o_orderstatus AS source_name
          FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
          WHERE o.o_orderpriority IN ('1-URGENT', '2-HIGH')),
snap AS (SELECT DISTINCT f.contributor_key, m.d AS c_date, f.team_name, f.source_name
         FROM facts f JOIN mondays m
           ON f.utc_datetime BETWEEN CAST(m.d AS TIMESTAMP) - INTERVAL 1 YEAR AND CAST(m.d AS TIMESTAMP))
"""


def _hist_snapshot(spark, d):
    facts, conversion, team, source, cal = history_warehouse(spark, d)
    return active_snapshot(facts, conversion, team, source, calendar_mondays(cal, HIST_LO, HIST_HI), YEAR)


@register("active_snapshot", _HIST_SNAPSHOT_SQL + "SELECT * FROM snap")
def q_active_snapshot(spark, d):
    return _hist_snapshot(spark, d)


@register("active_is_new", _HIST_SNAPSHOT_SQL + """
SELECT s.*, CASE WHEN (SELECT count(*) FROM snap s2 WHERE s2.contributor_key = s.contributor_key
                        AND s2.c_date BETWEEN s.c_date - INTERVAL 1 YEAR AND s.c_date) = 1
                 THEN 1 ELSE 0 END AS is_new
FROM snap s""")
def q_active_is_new(spark, d):
    return flag_new(_hist_snapshot(spark, d), YEAR)


# query groups register themselves on import
from cadence.plans import catalog_loads, catalog_conversions, catalog_jobs, catalog_runs  # noqa: E402,F401
