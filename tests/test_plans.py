"""Plan properties that must hold at any scale, checked on every registered read query."""

import pytest

from tidemark.plans import queries as Q
from tidemark.plans import registry
from tidemark.sources.warehouse import DerivedWarehouse

SF = "/root/testdata/sf0.001"
WRITES = ("refresh_", "import_", "csv_")
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "Expand", "BatchEvalPython", "ArrowEvalPython",
             "PythonUDF")
READS = sorted(n for n in registry.queries() if not n.startswith(WRITES))


MAPS = ("MapInPandas", "MapInArrow", "FlatMapGroups")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", READS)
def test_no_operator_that_breaks_at_scale(spark, name):
    plan = _plan(registry.queries()[name](spark, SF))
    assert not [op for op in FORBIDDEN if op in plan], plan


def test_window_reaches_the_parquet_scan(spark):
    plan = _plan(Q.kpis(DerivedWarehouse(spark, SF), "2024-01-08", "2024-01-28"))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-08T00:00), LessThan(ts,2024-01-29T00:00)]" \
        in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan


def test_sessions_fact_has_two_exchanges_with_partial_aggregates(spark):
    plan = _plan(DerivedWarehouse(spark, SF).table("fact_sessions"))
    assert plan.count("Exchange hashpartitioning") == 2
    assert "partial_bit_or" in plan and "count(distinct" not in plan


def test_pareto_window_runs_on_top_rows_only(spark):
    plan = _plan(Q.pages_pareto(DerivedWarehouse(spark, SF), "2024-01-08", "2024-01-28", 50))
    assert "TakeOrderedAndProject(limit=50" in plan


def test_landing_writers_and_readers_run_no_python(spark, tmpdir_spark):
    from tidemark.plans import ingest as I
    from tidemark.sources import landed as L
    rows = spark.range(10).selectExpr("cast(id as string) j", "id % 2 g")
    plans = [_plan(L._page_lines(rows, "[", "]", 3, ["g"]))]
    facts = spark.createDataFrame([("20240101", "1", "2", "3")], "date string, totalUsers string, sessions string, screenPageViews string")
    L.land_report(facts, tmpdir_spark, I.SESSIONS.dimensions, I.SESSIONS.metrics)
    plans.append(_plan(I.report_batch(spark, tmpdir_spark, I.SESSIONS)))
    plans.append(_plan(I.report_rejects(spark, tmpdir_spark, I.SESSIONS, "2024-01-01", "2024-01-02")))
    assert not [op for p in plans for op in (*FORBIDDEN, *MAPS) if op in p]


def test_one_events_scan_per_page_fact(spark):
    plan = _plan(registry.queries()["fact_ga4_pages_daily"](spark, SF))
    assert plan.count("events.parquet") == 1
