"""Skew check: one contributor holds a third of all facts. Runs the main operators
with an event log in a scratch folder and prints, per operator, the largest number
of shuffle records any single task read (vs. the hot key's row count).

Usage: python scripts/skew_check.py [rows]
"""

from __future__ import annotations

import glob
import json
import sys
import tempfile

sys.path.insert(0, __file__.rsplit("/scripts/", 1)[0])

from pyspark.sql import functions as F  # noqa: E402

from cadence.functions.timefn import YEAR  # noqa: E402
from cadence.operators.dedup import pick_per_key  # noqa: E402
from cadence.operators.hop import every_monday  # noqa: E402
from cadence.operators.windows import first_event_flag, threshold_rollup, trailing_distinct  # noqa: E402
from cadence.session import get_spark  # noqa: E402


def main():
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 600_000
    ev = tempfile.mkdtemp(prefix="skew-events-")
    spark = get_spark("skew-check", master="local[8]", shuffle_partitions=32,
                      extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": ev,
                             "spark.eventLog.compress": "false",
                             # keep the 32 hash partitions visible (no coalescing of small ones)
                             "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    ids = spark.range(n).repartition(32)
    hot = F.col("id") % 3 == 0
    facts = ids.select(
        F.when(hot, F.lit(0)).otherwise(F.col("id") % 5000 + 1).alias("contributor_key"),
        (F.lit("2013-01-01 00:00:00").cast("timestamp_ntz")
         + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                              ((F.col("id") * 7919) % (730 * 86400)).cast("decimal(18,6)"))).alias("utc_datetime"),
        F.concat(F.lit("bug/"), (F.col("id") % 997).cast("string")).alias("canonical"),
    ).cache()
    hot_rows = facts.where(F.col("contributor_key") == 0).count()
    mondays = every_monday("2014-01-01 00:00:00", "2014-12-31 00:00:00")
    runs = {
        "threshold_rollup(list, cut 200)": threshold_rollup(facts, ["contributor_key"], "utc_datetime", mondays, YEAR,
                                                            [5, 50], canon="canonical", concat="list", max_len=200),
        "threshold_rollup(repeat, runs)": threshold_rollup(facts, ["contributor_key", "canonical"], "utc_datetime",
                                                           mondays, YEAR, [5, 50], canon="canonical", concat="repeat"),
        "threshold_rollup(repeat, explode)": threshold_rollup(facts, ["contributor_key", "canonical"], "utc_datetime",
                                                              mondays, YEAR, [5, 50], canon="canonical",
                                                              concat="repeat", method="explode"),
        "trailing_distinct": trailing_distinct(facts, ["contributor_key"], "utc_datetime", mondays, YEAR),
        "pick_per_key": pick_per_key(facts, ["contributor_key"], ["utc_datetime"]),
        "first_event_flag": first_event_flag(facts, "contributor_key", "utc_datetime",
                                             F.col("canonical").startswith("bug/1"), "2014-01-01 00:00:00",
                                             "2014-12-31 00:00:00", flag="first"),
    }
    for name, df in runs.items():
        spark.sparkContext.setJobGroup(name, name)
        df.write.format("noop").mode("overwrite").save()
    spark.stop()
    stage_group, per_stage = {}, {}
    for path in glob.glob(ev + "/*/events_*"):
        for line in open(path):
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                g = e.get("Properties", {}).get("spark.jobGroup.id")
                for s in e.get("Stage IDs", []):
                    stage_group[s] = g
            if e["Event"] == "SparkListenerTaskEnd":
                g = stage_group.get(e["Stage ID"])
                recs = e.get("Task Metrics", {}).get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
                if g and recs:
                    mx, tot = per_stage.get((g, e["Stage ID"]), (0, 0))
                    per_stage[(g, e["Stage ID"])] = (max(mx, recs), tot + recs)
    print(f"rows={n} hot contributor rows={hot_rows}")
    for name in runs:
        stages = sorted((sid, mx, tot) for (g, sid), (mx, tot) in per_stage.items() if g == name)
        worst = max(stages, key=lambda t: t[1]) if stages else (None, 0, 0)
        print(f"{name:34s} shuffle stages={len(stages)}; largest task read {worst[1]} of {worst[2]} records "
              f"in its stage")


if __name__ == "__main__":
    main()
