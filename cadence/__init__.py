"""cadence: contribution analytics on Spark.

Windowed, re-runnable loads of activity records, conformed into a star schema,
turned into named conversions and weekly trailing-window snapshots. Every step is
DataFrame / Spark SQL code; nothing is collected to the driver.
"""

__version__ = "0.1.0"
