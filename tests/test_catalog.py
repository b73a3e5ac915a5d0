"""Every registered query against its SQL oracle (DuckDB) on the smallest test
tables, plus plan checks: filters reach the scan, no nested-loop joins, no
Python UDFs."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from cadence.plans.catalog import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE) and len(QUERIES) >= 40
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    res = duck.execute(ORACLE[name])
    dcols = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(dcols, res.fetchall())


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# a whole job's plan is that of reading its stored result (and running it again takes minutes)
@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.endswith(("_job_run", "_job_zone", "_job_late_facts"))))
def test_plan_has_no_nested_loop_or_python(spark, name):
    plan = _plan(QUERIES[name](spark, SF))
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_window_filter_pushed_to_scan(spark):
    plan = _plan(E.queries()["window_scan"](spark, SF))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan


def test_hop_prefilter_pushed_and_partial_aggregation(spark):
    plan = _plan(E.queries()["active_snapshot"](spark, SF))
    assert "GreaterThanOrEqual(o_orderdate,1995-01-01T00:00)" in plan     # first Monday - 1 year
    assert "partial_" in plan or "HashAggregate" in plan


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["contributor_key", "c_date", "team_name", "source_name", "is_new"]
    assert df.count() > 0
