"""Command line: the warehouse jobs over a stored warehouse folder.

    python -m tidemark init --root R [--start 2023-01-01] [--as-of D]
    python -m tidemark refresh-report --table fact_sessions --report P --root R [--days 30] [--as-of D]
    python -m tidemark refresh-analytics [--sessions P] [--events P] [--pages P] [--utm P] --root R [--days 30] [--as-of D]
    python -m tidemark refresh-yt-channel --report P --root R [--days 30] [--as-of D]
    python -m tidemark refresh-yt-videos --report P --root R --start D --end D [--max-results 50]
    python -m tidemark refresh-yt --channel-report P --videos-report P --root R [--days 30] [--as-of D]
    python -m tidemark refresh-rd-campaigns --campaigns P --metrics P --root R [--days 30] [--as-of D]
    python -m tidemark refresh-rd-leads --contacts P --root R [--days 30] [--as-of D]
    python -m tidemark import-utm-map [--path P] --root R
    python -m tidemark import-csv-pages|import-csv-countries --paths P [P ...] --root R [--as-of D]
    python -m tidemark import-csv-videos --start-paths P [P ...] --progress-paths P [P ...] --root R [--as-of D]
    python -m tidemark materialize-all --sf-dir D --root R
    python -m tidemark refresh-marts --root R [--days 30] [--as-of D]
    python -m tidemark materialize-engagement --root R
    python -m tidemark materialize-comms-impact --root R
    python -m tidemark catalog --root R --out P
    python -m tidemark query NAME --root R [--start D] [--end D] [--as-of D] [--limit N] [--registry F]

Every job is a Spark job over ``--root`` (date-partitioned Parquet tables); ``--as-of`` replaces
"today" so runs are reproducible. ``--registry`` names a YAML file of datasets (freshness, not-null and
unique checks) that replaces the built-in one. ``refresh-report`` keeps the rows it leaves out in ``<root>/quarantine``.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import sys

from pyspark.sql import DataFrame

QUERY_NAMES = ("kpis", "top_pages", "pages_weekly", "video_funnel", "top_countries", "top_weekdays",
               "yt_channel_daily", "yt_top_videos", "engagement_kpis", "engagement_series", "yt_retention",
               "utm_aggregate", "comms_by_campaign", "pages_pareto", "rd_kpis", "comms_summary", "wow",
               "mtd_vs_prev", "seven_vs_28", "health", "freshness", "quality_signals", "quality_alerts",
               "partial_day", "weekly_report", "weekly_summary", "check_not_null", "check_unique",
               "datasets_catalog", "field_matrix")


def run_query(w, name: str, start, end, as_of, limit: int | None, registry=None) -> DataFrame:
    from tidemark.plans import quality as QA
    from tidemark.plans import queries as Q
    from tidemark.schemas import REGISTRY
    reg = REGISTRY if registry is None else registry
    lim = {} if limit is None else {"limit": limit}
    table = {
        "kpis": lambda: Q.kpis(w, start, end),
        "top_pages": lambda: Q.top_pages(w, start, end, **lim),
        "pages_weekly": lambda: Q.pages_weekly(w, **({"weeks": limit} if limit else {})),
        "video_funnel": lambda: Q.video_funnel(w, start, end),
        "top_countries": lambda: Q.top_countries(w, start, end, **lim),
        "top_weekdays": lambda: Q.top_weekdays(w, start, end),
        "yt_channel_daily": lambda: Q.yt_channel_daily(w, start, end),
        "yt_top_videos": lambda: Q.yt_top_videos(w, start, end, **lim),
        "engagement_kpis": lambda: Q.engagement_kpis(w, start, end),
        "engagement_series": lambda: Q.engagement_series(w, start, end),
        "yt_retention": lambda: Q.yt_retention(w, start, end, **lim),
        "utm_aggregate": lambda: Q.utm_aggregate(w, start, end, **lim),
        "comms_by_campaign": lambda: Q.comms_by_campaign(w, start, end, **lim),
        "pages_pareto": lambda: Q.pages_pareto(w, start, end, limit),
        "rd_kpis": lambda: Q.rd_kpis(w, start, end),
        "comms_summary": lambda: Q.comms_summary(w, **lim),
        "wow": lambda: Q.wow(w, end),
        "mtd_vs_prev": lambda: Q.mtd_vs_prev(w, end),
        "seven_vs_28": lambda: Q.seven_vs_28(w, end),
        "health": lambda: Q.health(w),
        "freshness": lambda: QA.freshness(w, as_of, end, reg),
        "quality_signals": lambda: QA.quality_signals(w, as_of),
        "quality_alerts": lambda: QA.quality_alerts(w, as_of, registry=reg),
        "partial_day": lambda: QA.partial_day(w, end, as_of),
        "weekly_report": lambda: Q.weekly_report(w, start, end, **({"top_n": limit} if limit else {})),
        "weekly_summary": lambda: Q.weekly_summary(w, as_of),
        "check_not_null": lambda: QA.check_not_null(w, reg),
        "check_unique": lambda: QA.check_unique(w, reg),
        "datasets_catalog": lambda: QA.datasets_catalog(w),
        "field_matrix": lambda: QA.field_matrix(w, end),
    }
    return table[name]()


def _parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="tidemark")
    sub = ap.add_subparsers(dest="cmd", required=True)

    def cmd(name, *args):
        p = sub.add_parser(name)
        p.add_argument("--root", required=True)
        p.add_argument("--as-of", default=None)
        for a in args:
            a(p)
        return p

    days = lambda p: p.add_argument("--days", type=int, default=30)
    report = lambda p: p.add_argument("--report", required=True)
    cmd("init", lambda p: p.add_argument("--start", default="2023-01-01"))
    cmd("refresh-report", report, days, lambda p: p.add_argument("--table", required=True))
    cmd("refresh-analytics", days, *[(lambda flag: (lambda p: p.add_argument(flag, default=None)))(f)
                                     for f in ("--sessions", "--events", "--pages", "--utm")])
    cmd("refresh-yt-channel", report, days)
    cmd("refresh-yt-videos", report, lambda p: p.add_argument("--start", required=True),
        lambda p: p.add_argument("--end", required=True), lambda p: p.add_argument("--max-results", type=int, default=50))
    cmd("refresh-yt", days, lambda p: p.add_argument("--channel-report", required=True),
        lambda p: p.add_argument("--videos-report", required=True),
        lambda p: p.add_argument("--max-results", type=int, default=50))
    cmd("refresh-rd-campaigns", days, lambda p: p.add_argument("--campaigns", required=True),
        lambda p: p.add_argument("--metrics", required=True))
    cmd("refresh-rd-leads", days, lambda p: p.add_argument("--contacts", required=True))
    cmd("import-utm-map", lambda p: p.add_argument("--path", default=None))
    cmd("import-csv-pages", lambda p: p.add_argument("--paths", nargs="+", required=True))
    cmd("import-csv-countries", lambda p: p.add_argument("--paths", nargs="+", required=True))
    cmd("import-csv-videos", lambda p: p.add_argument("--start-paths", nargs="*", default=[]),
        lambda p: p.add_argument("--progress-paths", nargs="*", default=[]))
    cmd("materialize-all", lambda p: p.add_argument("--sf-dir", required=True))
    cmd("refresh-marts", days)
    cmd("materialize-engagement")
    cmd("materialize-comms-impact")
    cmd("catalog", lambda p: p.add_argument("--out", required=True))
    cmd("query", lambda p: p.add_argument("name", choices=QUERY_NAMES),
        lambda p: p.add_argument("--start", default=None), lambda p: p.add_argument("--end", default=None),
        lambda p: p.add_argument("--limit", type=int, default=None), lambda p: p.add_argument("--registry", default=None))
    return ap


def main(argv: list[str] | None = None, spark=None) -> DataFrame | None:
    from tidemark.functions.columns import as_date
    from tidemark.operators import tables as K
    from tidemark.operators.calendar import calendar
    from tidemark.plans import ingest as I
    from tidemark.plans import marts as M
    from tidemark.plans import quality as QA
    from tidemark.schemas import PARTITION_COLS, TABLES, load_registry
    from tidemark.session import get_spark
    from tidemark.sources.warehouse import StoredWarehouse

    a = _parser().parse_args(argv)
    spark = spark or get_spark()
    root = a.root.rstrip("/")
    as_of = as_date(a.as_of) if a.as_of else _dt.date.today()
    w = StoredWarehouse(spark, root)

    def window():
        return I.refresh_window(as_of, a.days)

    if a.cmd == "init":
        for t in TABLES:
            if t.startswith(("fact_", "dim_", "map_")) and t != "dim_date":
                K.ensure_table(spark, f"{root}/{t}", t)
        K.rebuild(calendar(spark, a.start, as_of), f"{root}/dim_date")
    elif a.cmd == "refresh-report":
        I.refresh_report(spark, a.report, f"{root}/{a.table}", I.REPORTS[a.table], *window(), quarantine_root=root)
    elif a.cmd == "refresh-analytics":
        given = {"fact_sessions": a.sessions, "fact_ga4_events_daily": a.events, "fact_ga4_pages_daily": a.pages,
                 "fact_ga4_sessions_by_utm_daily": a.utm}
        I.refresh_reports(spark, {t: p for t, p in given.items() if p}, root, as_of, a.days)
    elif a.cmd == "refresh-yt-channel":
        I.refresh_yt_channel(spark, a.report, f"{root}/fact_yt_channel_daily", *window())
    elif a.cmd == "refresh-yt-videos":
        I.refresh_yt_videos(spark, a.report, f"{root}/fact_yt_video_period", a.max_results, a.start, a.end)
    elif a.cmd == "refresh-yt":
        I.refresh_yt_channel_and_videos(spark, a.channel_report, a.videos_report, root, as_of, a.days,
                                        a.max_results)
    elif a.cmd == "refresh-rd-campaigns":
        I.refresh_email_campaigns(spark, a.campaigns, a.metrics, f"{root}/fact_rd_email_campaign", *window())
    elif a.cmd == "refresh-rd-leads":
        I.refresh_lead_stage(spark, a.contacts, f"{root}/fact_rd_lead_stage_daily", *window())
    elif a.cmd == "import-utm-map":
        I.import_utm_map(spark, a.path, f"{root}/map_utm_campaign")
    elif a.cmd == "import-csv-pages":
        I.import_pages_csv(spark, a.paths, root, as_of)
    elif a.cmd == "import-csv-countries":
        I.import_countries_csv(spark, a.paths, root, as_of)
    elif a.cmd == "import-csv-videos":
        I.import_videos_csv(spark, {"video_start": a.start_paths, "video_progress": a.progress_paths}, root, as_of)
    elif a.cmd == "materialize-all":
        from tidemark.plans.build import materialize
        materialize(spark, a.sf_dir, root)
    elif a.cmd == "refresh-marts":
        from tidemark.plans.build import refresh_marts_window
        refresh_marts_window(spark, root, *window())
    elif a.cmd == "materialize-engagement":
        K.rebuild(M.engagement_daily(w.table("dim_date"), w.table("fact_sessions"), w.table("fact_yt_channel_daily")),
                  f"{root}/fact_engagement_daily", PARTITION_COLS["fact_engagement_daily"])
    elif a.cmd == "materialize-comms-impact":
        K.rebuild(M.comms_impact_daily(w.table("fact_ga4_sessions_by_utm_daily"), w.table("map_utm_campaign")),
                  f"{root}/fact_comms_impact_daily", PARTITION_COLS["fact_comms_impact_daily"])
        K.rebuild(M.comms_impact_summary(w.table("fact_comms_impact_daily"), w.table("fact_rd_email_campaign")),
                  f"{root}/fact_comms_impact_summary", PARTITION_COLS["fact_comms_impact_summary"])
    elif a.cmd == "catalog":
        K.export_csv(QA.datasets_catalog(w), a.out)
    elif a.cmd == "query":
        end = as_date(a.end) if a.end else as_of
        start = as_date(a.start) if a.start else end - _dt.timedelta(days=7)
        df = run_query(w, a.name, start, end, as_of, a.limit, load_registry(a.registry) if a.registry else None)
        if __name__ == "__main__":
            df.show(200, truncate=False)
        return df
    return None


if __name__ == "__main__":
    main(sys.argv[1:])
