"""Served queries give the same answers from materialised tables as from the driver tables."""

import datetime as dt
import math
from collections import Counter

import pytest

from tidemark.plans import quality as QA
from tidemark.plans import queries as Q
from tidemark.plans.build import materialize
from tidemark.sources.warehouse import DerivedWarehouse

SF = "/root/testdata/sf0.001"
S, E, A = "2024-01-08", "2024-01-28", "2024-01-28"

CASES = {
    "kpis": lambda w: Q.kpis(w, S, E),
    "top_pages": lambda w: Q.top_pages(w, S, E, 10),
    "pages_weekly": lambda w: Q.pages_weekly(w, 8),
    "video_funnel": lambda w: Q.video_funnel(w, S, E),
    "top_countries": lambda w: Q.top_countries(w, S, E, 10),
    "yt_top_videos": lambda w: Q.yt_top_videos(w, S, E, 20),
    "utm_aggregate": lambda w: Q.utm_aggregate(w, S, E, 20),
    "comms_by_campaign": lambda w: Q.comms_by_campaign(w, S, E, 20),
    "comms_summary": lambda w: Q.comms_summary(w, 10),
    "pages_pareto": lambda w: Q.pages_pareto(w, S, E, 50),
    "wow": lambda w: Q.wow(w, A),
    "seven_vs_28": lambda w: Q.seven_vs_28(w, A),
    "volumetry_series": lambda w: QA.volumetry_series(w),
    "check_unique": lambda w: QA.check_unique(w),
    "check_not_null": lambda w: QA.check_not_null(w),
    "health": lambda w: Q.health(w),
    "freshness": lambda w: QA.freshness(w, A, E),
    "quality_alerts": lambda w: QA.quality_alerts(w, A),
    "partial_day": lambda w: QA.partial_day(w, E, A),
}


def _bag(df):
    def n(v):
        return float(f"{v:.9g}") if isinstance(v, float) and not math.isnan(v) else v
    return Counter(tuple(n(x) for x in r) for r in df.collect())


@pytest.fixture(scope="module")
def stored(spark):
    from tidemark.session import scratch_dir
    return materialize(spark, SF, scratch_dir(spark, "materialized"))


@pytest.mark.parametrize("name", sorted(CASES))
def test_stored_equals_derived(spark, stored, name):
    derived = DerivedWarehouse(spark, SF)
    assert _bag(CASES[name](stored)) == _bag(CASES[name](derived))


def _scans(df) -> list[str]:
    """The file scans of a plan, one line each."""
    plan = df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().sparkPlan().toString()
    return [line for line in plan.splitlines() if "FileScan" in line]


def test_health_and_freshness_read_no_data_page(spark, stored):
    assert not _scans(QA.freshness(stored, A, E)) and not _scans(QA.partial_day(stored, E, A))
    scans = _scans(Q.health(stored))
    assert scans and all("ReadSchema: struct<>" in line for line in scans), scans


def test_quality_questions_read_the_profile_and_one_mart(spark, stored):
    from tidemark.plans import profile as P
    before = {n: _bag(CASES[n](stored)) for n in ("quality_alerts", "check_not_null", "check_unique")}
    catalog = _bag(QA.datasets_catalog(stored))
    P.build_profile(spark, stored.root)
    assert {n: _bag(CASES[n](stored)) for n in before} == before and _bag(QA.datasets_catalog(stored)) == catalog
    for df, tables in ((QA.quality_alerts(stored, A), {"table_profile", "fact_engagement_daily"}), (QA.datasets_catalog(stored), {"table_profile"}),
                       (QA.check_not_null(stored), {"table_profile"}), (QA.check_unique(stored), {"table_profile"})):
        read = {t for line in _scans(df) for t in (*tables, "fact_ga4", "fact_sessions", "fact_rd", "fact_yt", "map_") if f"/{t}" in line}
        assert read <= tables and read, read


def test_profile_follows_refreshed_days_and_declared_keys(spark):
    from tidemark.operators import tables as K
    from tidemark.plans import profile as P
    from tidemark.schemas import Dataset
    from tidemark.session import scratch_dir
    from tidemark.sources.warehouse import StoredWarehouse
    root, t = scratch_dir(spark, "profile"), "fact_ga4_events_daily"
    rows = [(dt.date(2024, 1, d), e, n, None) for d, e, n in ((1, "a", 1), (1, "a", 2), (1, None, 3), (2, "b", 4), (3, "b", None), (3, "c", 5))]
    df = spark.createDataFrame(rows, "date date, eventName string, eventCount long, activeUsers long")
    K.write_partitioned(df, f"{root}/{t}", ["date"])
    K.rebuild(spark.createDataFrame([("s",) + (None,) * 7], P.TABLES["map_utm_campaign"]), f"{root}/map_utm_campaign")
    P.build_profile(spark, root)
    w = StoredWarehouse(spark, root)
    alike = lambda: (_bag(w.profile()), _bag(P.profile_days(w.table(t), t).unionByName(P.profile_days(w.table("map_utm_campaign"), "map_utm_campaign"))))
    got, want = alike()
    assert got == want and ("fact_ga4_events_daily", dt.date(2024, 1, 1), "key", "date,eventName", 3, 0, 1, 2) in got
    day2 = spark.createDataFrame([(dt.date(2024, 1, 2), "x", 1, 1)] * 3, df.schema)
    K.replace_window(spark, day2, f"{root}/{t}", "2024-01-02", "2024-01-03")
    P.refresh_profile(spark, root, t, "2024-01-02", "2024-01-03")
    P.refresh_profile(spark, root, "map_utm_campaign", None, None)
    got, want = alike()
    assert got == want and not [r for r in got if r[1] == dt.date(2024, 1, 3)]
    two = (Dataset("x", t, "", "", (), (), unique=("date", "eventName")), Dataset("y", t, "", "", (), (), unique=("date", "eventCount")),
           Dataset("z", t, "", "", (), (), unique=("eventName",)))
    assert P.unique_keys(t, two) == [("date", "eventName"), ("date", "eventCount")]
    keys = P.profile_days(df, t, two).where("kind = 'key'").groupBy("name").agg({"duplicate_rows": "sum"}).collect()
    assert sorted(tuple(r) for r in keys) == [("date,eventCount", 0), ("date,eventName", 2)]


def test_stored_window_read_prunes_partitions(spark, stored):
    plan = stored.fact("fact_sessions", S, E)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2024-01-08" in plan
    assert stored.fact("fact_sessions", S, E).agg({"date": "min"}).first()[0] == dt.date(2024, 1, 8)


def test_window_refresh_of_marts_equals_full_rebuild(spark):
    from pyspark.sql import functions as F

    from tidemark.operators import tables as K
    from tidemark.plans.build import materialize, refresh_marts_window
    from tidemark.session import scratch_dir
    root = scratch_dir(spark, "marts-window")
    stored = materialize(spark, SF, root)
    # a re-pull changes two days of sessions and drops one
    s = stored.fact("fact_sessions", "2024-01-10", "2024-01-12").where(F.col("date") != F.lit(dt.date(2024, 1, 11)))
    changed = s.select("date", (F.col("pageviews") + 5).alias("pageviews"), (F.col("sessions") * 2).alias("sessions"),
                       "users", "avg_session_duration").checkpoint()
    K.replace_window(spark, changed, f"{root}/fact_sessions", "2024-01-10", "2024-01-12")
    refresh_marts_window(spark, root, "2024-01-10", "2024-01-12")
    incremental = _bag(stored.table("fact_engagement_daily"))
    from tidemark.plans import marts as M
    full = _bag(M.engagement_daily(stored.table("dim_date"), stored.table("fact_sessions"),
                                   stored.table("fact_yt_channel_daily")))
    assert incremental == full
    day11 = stored.table("fact_engagement_daily").where(F.col("date") == F.lit(dt.date(2024, 1, 11))).first()
    assert day11.sessions == 0 and day11.pageviews == 0


def _files(spark, root, table):
    from urllib.parse import urlparse
    import pathlib
    path = pathlib.Path(urlparse(f"{root}/{table}").path)
    return {str(p.relative_to(path)) for p in path.rglob("*.parquet")}


def test_send_summary_is_merged_by_window(spark):
    from pyspark.sql import functions as F

    from tidemark.operators import tables as K
    from tidemark.plans import build as B
    from tidemark.plans import marts as M
    from tidemark.session import scratch_dir
    from tidemark.sources.warehouse import StoredWarehouse
    root = scratch_dir(spark, "send-summary")
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    sends = [(day(d), c, 10 + d, d, 1) for d, c in ((0, "A"), (5, "A"), (9, "B"), (12, "C"), (20, "A"), (30, "D"), (30, None))]
    K.write_partitioned(spark.createDataFrame(sends, "date date, campaignId string, sends long, opens long, clicks long"),
                        f"{root}/fact_rd_email_campaign", ["date"])
    K.write_partitioned(spark.createDataFrame([(day(n), "s", "m", c, n + 1, 1) for n in range(35) for c in "abcd"],
                                              "date date, source string, medium string, campaign string, sessions long, users long"),
                        f"{root}/fact_ga4_sessions_by_utm_daily", ["date"])
    m = [("s", "m", c, c.upper(), c, "s", "m", c) for c in "abcd"]
    K.rebuild(spark.createDataFrame(m, B.TABLES["map_utm_campaign"]), f"{root}/map_utm_campaign")
    B.build_comms(spark, root)
    w = StoredWarehouse(spark, root)
    full = lambda: _bag(M.comms_impact_summary(w.table("fact_comms_impact_daily"), w.table("fact_rd_email_campaign")))
    before = _files(spark, root, "fact_comms_impact_summary")
    # in the window A's send goes, B's changes, a new one of E comes; and the sessions of its days
    window = (day(5), day(9))
    new = spark.createDataFrame([(day(9), "B", 99, None, 7), (day(8), "E", 1, 1, 1)], "date date, campaignId string, sends long, opens long, clicks long")
    K.replace_window(spark, new, f"{root}/fact_rd_email_campaign", *window)
    utm = w.fact("fact_ga4_sessions_by_utm_daily", *window).where(F.col("date") != F.lit(day(7))).withColumn("sessions", F.col("sessions") * 3)
    K.replace_window(spark, utm, f"{root}/fact_ga4_sessions_by_utm_daily", *window)
    B.refresh_comms_window(spark, root, *window)
    assert _bag(w.table("fact_comms_impact_summary")) == full()
    # A's other dates got new totals; C (day 12) and D (day 30) lie outside and keep their files
    kept = {f for f in before if f.startswith(("send_date=2024-01-13", "send_date=2024-01-31"))}
    assert len(kept) >= 2 and kept <= _files(spark, root, "fact_comms_impact_summary")
    fresh, _, _ = B.summary_changes(w, *window, day(3), day(10))
    scan = next(line for line in fresh._jdf.queryExecution().executedPlan().toString().splitlines()
                if "FileScan" in line and "campaignId:string,sessions:bigint>" in line)
    filters = scan[scan.index("PartitionFilters"):]
    assert str(day(2)) in filters and str(day(12)) in filters, filters
    B.refresh_comms_window(spark, root, *window)  # again: nothing changes
    assert _bag(w.table("fact_comms_impact_summary")) == full()


def test_reports_read_the_events_twice(spark):
    w = DerivedWarehouse(spark, SF)
    for df in (Q.weekly_report(w, S, E, 10), Q.weekly_summary(w, A), Q.top_pages(w, S, E, 10)):
        scans = [line for line in df._jdf.queryExecution().sparkPlan().toString().splitlines() if "FileScan" in line and "user_id" in line]
        assert len(scans) == 2 and all("GreaterThanOrEqual(ts" in line for line in scans), scans


def test_reports_without_events_or_without_pages(spark):
    w = DerivedWarehouse(spark, SF)
    rows = {(r.section, r["rank"], r.label): r.value for r in Q.weekly_report(w, "2030-01-01", "2030-01-07", 10).collect()}
    assert rows == {("kpis", 1, "users"): 0.0, ("kpis", 2, "sessions"): 0.0, ("kpis", 3, "pageviews"): 0.0, ("top_pages", 1, "Total"): 0.0,
                    ("funnel", 1, "start"): 0.0, ("funnel", 2, "progress"): 0.0, ("funnel", 3, "completion_rate"): 0.0}
    assert [tuple(r) for r in Q.top_pages(w, "2030-01-01", "2030-01-07", 10).collect()] == [("NA", "Total", 0)]
    assert Q.top_pages(w, S, E, None).count() == Q.top_pages(w, S, E, 10 ** 6).count()


def test_stored_and_derived_reports_agree(spark, stored):
    assert _bag(Q.weekly_report(stored, S, E, 7)) == _bag(Q.weekly_report(DerivedWarehouse(spark, SF), S, E, 7))
