"""Command line: run a topic job or the weekly snapshot for a window.

    python -m cadence.cli --warehouse WH --sources SRC bugs "2021-03-07 00:00:00" "2021-03-13 23:59:59"
    python -m cadence.cli --warehouse WH aggregate "2021-03-01 00:00:00" "2021-03-31 23:59:59"

Topic jobs first, then ``aggregate`` (it reads the conversions they wrote). The
conversion, source and team dimensions are read from the warehouse tables
``conversion``, ``source`` and ``team``; the repository -> team list for the
hosting job from ``repo_team`` when present. ``--names`` is a JSON object with the
deployment's own values of :class:`cadence.plans.names.Names`; ``--jdbc`` one with what
``read_jdbc`` takes for all tables (``url``, ``properties``) instead of ``--sources``.
"""

from __future__ import annotations

import argparse
import json
import sys

from cadence.plans import aggregate, bugs, hosting, reports, support
from cadence.plans.names import Names
from cadence.session import get_spark
from cadence.sources.readers import Sources
from cadence.sources.sinks import Warehouse

TOPICS = {"bugs": bugs, "hosting": hosting, "reports": reports, "support": support}


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="cadence")
    p.add_argument("--warehouse", required=True, help="warehouse root (any Hadoop path)")
    p.add_argument("--sources", help="folder holding the source system's exported tables")
    p.add_argument("--jdbc", help="JSON object: the source database's url and properties")
    p.add_argument("--names", default="{}", help="JSON object: this deployment's names")
    p.add_argument("--format", default="parquet", help="source table format")
    p.add_argument("--tz", help="time zone of the source's local times (default: taken as UTC)")
    p.add_argument("job", choices=sorted(TOPICS) + ["aggregate"])
    p.add_argument("lower")
    p.add_argument("upper")
    a = p.parse_args(argv)

    spark = get_spark("cadence-" + a.job)
    wh = Warehouse(spark, a.warehouse)
    conversion, source, team = wh.table("conversion"), wh.table("source"), wh.table("team")
    if a.job == "aggregate":
        aggregate.run(wh, a.lower, a.upper, conversion, team, source)
        return 0
    if not a.sources and not a.jdbc:
        p.error("--sources or --jdbc is required for a topic job")
    src = Sources(spark, root=a.sources, fmt=a.format, jdbc=json.loads(a.jdbc) if a.jdbc else None)
    names = Names(**json.loads(a.names))
    if a.job == "hosting":
        hosting.run(wh, src, a.lower, a.upper, conversion, source, team, wh.read("repo_team"), names, tz=a.tz)
    else:
        TOPICS[a.job].run(wh, src, a.lower, a.upper, conversion, source, team, names=names, tz=a.tz)
    return 0


if __name__ == "__main__":
    sys.exit(main())
