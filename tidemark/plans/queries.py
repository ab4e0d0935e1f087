"""Served queries: parameterised questions over the warehouse, answered as DataFrames.

Every function takes a ``Warehouse`` plus explicit parameters (dates as 'yyyy-MM-dd' or
``date``) and returns a lazy DataFrame. Top-k results use the metric and then the key as a
tie-break, so they are deterministic.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators import compare as CMP
from tidemark.operators.prefix import running_share_all, running_share_top
from tidemark.sources.warehouse import Warehouse

# The two funnel events, and the report label of a page with neither title nor path.
FUNNEL_EVENTS = ("video_start", "video_progress")
UNTITLED_LABEL = "(sem título)"


def _top(df: DataFrame, metric: str, keys: list[str], limit: int | None) -> DataFrame:
    ordered = df.orderBy(F.col(metric).desc_nulls_last(), *[F.col(k).asc_nulls_last() for k in keys])
    return ordered.limit(limit) if limit is not None else ordered


# Q1
def kpis(w: Warehouse, start, end) -> DataFrame:
    """Users, sessions, page views summed over the days of the window (as doubles)."""
    f = w.fact("fact_sessions", start, end)
    return f.agg(*[C.sum0(c).cast("double").alias(c) for c in ("users", "sessions", "pageviews")])


# Q2
def _page_rows(w: Warehouse, start, end) -> DataFrame:
    return (w.fact("fact_ga4_pages_daily", start, end).groupBy("pagePath")
            .agg(F.coalesce(F.max("pageTitle"), F.col("pagePath")).alias("page_title"),
                 C.sum0("screenPageViews").cast("bigint").alias("pageviews"))
            .withColumnRenamed("pagePath", "page_path"))


def top_pages(w: Warehouse, start, end, limit: int = 10) -> DataFrame:
    """Top pages by views; falls back to one ('NA', 'Total', Σ page views) row when the page
    fact is missing or has no rows in the window. With a limit the page fact is read once: whether there are rows
    shows in the top itself (a window over ``limit`` + 1 rows); without one an EXISTS subquery tells."""
    fallback = (w.fact("fact_sessions", start, end)
                 .agg(C.sum0("pageviews").cast("bigint").alias("pageviews"))
                 .select(F.lit("NA").alias("page_path"), F.lit("Total").alias("page_title"), "pageviews"))
    if not w.has("fact_ga4_pages_daily"):
        return fallback
    top = _top(_page_rows(w, start, end), "pageviews", ["page_path"], limit).select("page_path", "page_title", "pageviews")
    if not limit:
        return top.unionByName(fallback.where(~w.fact("fact_ga4_pages_daily", start, end).exists()))
    both = top.withColumn("instead", F.lit(False)).unionByName(fallback.withColumn("instead", F.lit(True)))
    return _top(_without_unused(both).drop("instead"), "pageviews", ["page_path"], limit)


def _without_unused(df: DataFrame) -> DataFrame:
    """Rows marked ``instead`` count only where there is no other row. For a few rows: they meet in one task."""
    whole = Window.partitionBy(F.lit(0))
    others = F.count_if(~F.col("instead")).over(whole)
    return df.withColumn("others", others).where(~F.col("instead") | (F.col("others") == 0)).drop("others")


# Q3
def pages_weekly(w: Warehouse, weeks: int = 8) -> DataFrame:
    """Page views per '%Y-%W' week, the last ``weeks`` weeks in ascending order."""
    f = w.table("fact_sessions")
    weekly = (f.groupBy(C.year_week_w("date").alias("year_week"))
               .agg(C.sum0("pageviews").cast("bigint").alias("pageviews")))
    last = weekly.orderBy(F.col("year_week").desc_nulls_last()).limit(weeks)
    return last.orderBy("year_week")


# Q4
def video_funnel(w: Warehouse, start, end) -> DataFrame:
    """start, progress and completion rate (progress / start × 100, 2 decimals, 0 if no start)."""
    if w.has("fact_ga4_events_daily"):
        f = w.fact("fact_ga4_events_daily", start, end).select(
            F.col("eventName").alias("name"), F.col("eventCount").alias("n"))
    else:
        f = w.fact("fact_events", start, end).select(
            F.col("event_name").alias("name"), F.col("event_count").alias("n"))
    f = f.where(F.col("name").isin(*FUNNEL_EVENTS))
    agg = f.agg(C.sum0(F.when(F.col("name") == "video_start", F.col("n"))).cast("bigint").alias("start"),
                C.sum0(F.when(F.col("name") == "video_progress", F.col("n"))).cast("bigint").alias("progress"))
    rate = F.when(F.col("start") > 0,
                  F.round(F.col("progress").cast("double") / F.col("start").cast("double") * F.lit(100.0), 2)) \
            .otherwise(F.lit(0.0))
    return agg.select("start", "progress", rate.alias("completion_rate"))


# Q5
def top_countries(w: Warehouse, start, end, limit: int = 10) -> DataFrame:
    """Users per country in the window, most first; empty when the country fact is missing."""
    if not w.has("fact_sessions_by_country"):
        return w.spark.createDataFrame([], "country_id string, users bigint")
    f = w.fact("fact_sessions_by_country", start, end)
    agg = f.groupBy("country_id").agg(C.sum0("users").cast("bigint").alias("users"))
    return _top(agg, "users", ["country_id"], limit)


# Q6
def top_weekdays(w: Warehouse, start, end) -> DataFrame:
    """Users per weekday ('0' = Sunday), most first."""
    f = w.fact("fact_sessions", start, end)
    agg = f.groupBy(C.weekday_w("date").alias("weekday")).agg(C.sum0("users").cast("bigint").alias("users"))
    return _top(agg, "users", ["weekday"], None)


# Q7
def yt_channel_daily(w: Warehouse, start, end) -> DataFrame:
    """Channel days in the window (NULL metrics as 0), by date; empty when the table is missing."""
    if not w.has("fact_yt_channel_daily"):
        return w.spark.createDataFrame([], "date date, views bigint, estimatedMinutesWatched bigint, "
                                           "averageViewDuration double")
    f = w.fact("fact_yt_channel_daily", start, end)
    return (f.select("date",
                     F.coalesce("views", F.lit(0)).cast("bigint").alias("views"),
                     F.coalesce("estimatedMinutesWatched", F.lit(0)).cast("bigint").alias("estimatedMinutesWatched"),
                     F.coalesce("averageViewDuration", F.lit(0.0)).cast("double").alias("averageViewDuration"))
             .orderBy("date"))


def _periods_touching(w: Warehouse, start, end) -> DataFrame:
    """Video periods that start on ``start`` or end on ``end`` (either edge matching)."""
    return w.video_periods(start, end)


# Q8
def yt_top_videos(w: Warehouse, start, end, limit: int = 20) -> DataFrame:
    """Views, minutes and mean of the period means (rounded to 6 decimals) per video."""
    if not w.has("fact_yt_video_period"):
        return w.spark.createDataFrame([], "videoId string, views bigint, estimatedMinutesWatched bigint, "
                                           "averageViewDuration double")
    p = _periods_touching(w, start, end)
    agg = (p.groupBy("videoId")
            .agg(C.sum0("views").cast("bigint").alias("views"),
                 C.sum0("estimatedMinutesWatched").cast("bigint").alias("estimatedMinutesWatched"),
                 F.coalesce(F.round(F.avg("averageViewDuration"), 6), F.lit(0.0)).alias("averageViewDuration")))
    return _top(agg, "views", ["videoId"], limit)


# Q9
def engagement_kpis(w: Warehouse, start, end) -> DataFrame:
    """Sessions, page views, video views and minutes summed over the window (as doubles)."""
    f = w.fact("fact_engagement_daily", start, end)
    return f.agg(C.sum0("sessions").cast("double").alias("sessions"),
                 C.sum0("pageviews").cast("double").alias("pageviews"),
                 C.sum0("views").cast("double").alias("views"),
                 C.sum0("estimatedMinutesWatched").cast("double").alias("minutes"))


# Q10
def engagement_series(w: Warehouse, start, end) -> DataFrame:
    """Per day of the window: sessions and minutes watched, by date."""
    f = w.fact("fact_engagement_daily", start, end)
    return (f.select("date",
                     F.coalesce("sessions", F.lit(0)).cast("bigint").alias("sessions"),
                     F.coalesce("estimatedMinutesWatched", F.lit(0)).cast("bigint").alias("minutes"))
             .orderBy("date"))


# Q11
def yt_retention(w: Warehouse, start, end, limit: int = 20) -> DataFrame:
    """Minutes per view by video, most minutes first."""
    if not w.has("fact_yt_video_period"):
        return w.spark.createDataFrame([], "videoId string, minutes bigint, views bigint, min_per_view double")
    p = _periods_touching(w, start, end)
    agg = (p.groupBy("videoId")
            .agg(C.sum0("estimatedMinutesWatched").cast("bigint").alias("minutes"),
                 C.sum0("views").cast("bigint").alias("views")))
    mpv = F.when(F.col("views") > 0, F.col("minutes").cast("double") / F.col("views").cast("double")) \
           .otherwise(F.lit(0.0))
    return _top(agg.select("videoId", "minutes", "views", mpv.alias("min_per_view")), "minutes", ["videoId"], limit)


# Q12
def utm_aggregate(w: Warehouse, start, end, limit: int = 20) -> DataFrame:
    """Sessions and users per (source, medium, campaign), NULL parts as '(na)', most sessions first."""
    f = w.fact("fact_ga4_sessions_by_utm_daily", start, end)
    na = F.lit("(na)")
    agg = (f.groupBy(F.coalesce("source", na).alias("source"), F.coalesce("medium", na).alias("medium"),
                     F.coalesce("campaign", na).alias("campaign"))
            .agg(C.sum0("sessions").cast("bigint").alias("sessions"),
                 C.sum0("users").cast("bigint").alias("users")))
    return _top(agg, "sessions", ["source", "medium", "campaign"], limit)


# Q13
def comms_by_campaign(w: Warehouse, start, end, limit: int = 20) -> DataFrame:
    """Sessions and users attributed to each campaign in the window, most sessions first."""
    f = w.fact("fact_comms_impact_daily", start, end)
    agg = (f.groupBy("campaignId")
            .agg(C.sum0("sessions").cast("bigint").alias("sessions"),
                 C.sum0("users").cast("bigint").alias("users")))
    return _top(agg, "sessions", ["campaignId"], limit)


def _page_totals(w: Warehouse, start, end) -> DataFrame:
    p = w.fact("fact_ga4_pages_daily", start, end)
    return (p.groupBy("pagePath")
             .agg(F.coalesce(F.max("pageTitle"), F.col("pagePath")).alias("page_title"),
                  C.sum0("screenPageViews").cast("bigint").alias("pageviews")))


# Q14
def pages_pareto(w: Warehouse, start, end, limit: int | None = 50, rows_per_range: int = 1_000_000) -> DataFrame:
    """page_title, pageviews, cum_share (running share of all page views in the window).

    Bounded (``limit``): cut to the top rows, window over them only. Unbounded: ranges on the
    full sort key with per-range offsets (see ``operators.prefix``).
    """
    agg = _page_totals(w, start, end)
    if limit is not None:
        out = running_share_top(agg, "pageviews", "pagePath", limit)
    else:
        out = running_share_all(agg, "pageviews", "pagePath", rows_per_range)
    return out.select("page_title", "pageviews", "cum_share")


# Q15
def rd_kpis(w: Warehouse, start, end) -> DataFrame:
    """Sends, opens, clicks of the window and click rate (clicks / sends × 100, 2 decimals)."""
    f = w.fact("fact_rd_email_campaign", start, end)
    agg = f.agg(C.sum0("sends").alias("s"), C.sum0("opens").alias("o"), C.sum0("clicks").alias("c"))
    ctr = F.when(F.col("s") != 0,
                 F.round(F.col("c").cast("double") * F.lit(100.0) / F.col("s").cast("double"), 2)) \
           .otherwise(F.lit(0.0))
    return agg.select(F.col("s").cast("double").alias("sends"), F.col("o").cast("double").alias("opens"),
                      F.col("c").cast("double").alias("clicks"), ctr.alias("ctr_pct"))


# Q16
def comms_summary(w: Warehouse, limit: int = 10) -> DataFrame:
    """The latest sends of the campaign summary (send date descending, campaign as tie-break)."""
    s = w.table("fact_comms_impact_summary")
    cols = [F.col("campaignId"), F.col("send_date")]
    cols += [F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
             for c in ("ses_d_1", "ses_d0", "ses_d0_d2", "uplift_abs")]
    cols += [F.coalesce("uplift_pct", F.lit(0.0)).alias("uplift_pct")]
    cols += [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("sends", "opens", "clicks")]
    return (s.select(*cols)
             .orderBy(F.col("send_date").desc_nulls_last(), F.col("campaignId").asc_nulls_last())
             .limit(limit))


# Q17
_ENGAGEMENT_METRICS = {"sessions": "sessions", "minutes": "estimatedMinutesWatched"}


def wow(w: Warehouse, end) -> DataFrame:
    """Sessions and minutes: D-6..D against D-13..D-7."""
    cur, ref = CMP.wow_windows(end)
    return CMP.compare_periods(w.fact("fact_engagement_daily", ref[0], cur[1]), _ENGAGEMENT_METRICS, cur, ref)


def mtd_vs_prev(w: Warehouse, end, clamp_prev_month: bool = False) -> DataFrame:
    """Sessions and minutes: month to date against the previous month from its first day."""
    cur, ref = CMP.mtd_windows(end, clamp_prev_month)
    lo, hi = min(cur[0], ref[0]), max(cur[1], ref[1])
    return CMP.compare_periods(w.fact("fact_engagement_daily", lo, hi), _ENGAGEMENT_METRICS, cur, ref)


def seven_vs_28(w: Warehouse, end) -> DataFrame:
    """Sessions and minutes: the last 7 days against 7/28 of the last 28 days."""
    cur, ref = CMP.seven_vs_28_windows(end)
    return CMP.compare_periods(w.fact("fact_engagement_daily", ref[0], cur[1]), _ENGAGEMENT_METRICS, cur, ref,
                               ref_scale=7.0 / 28.0, ref_name="reference")


# Q18
# Names of the health metrics.
HEALTH_COUNTS = ("fact_sessions", "fact_events", "fact_sessions_by_country")
HEALTH_LATEST = (
    ("latest_date_fact_sessions", "fact_sessions"),
    ("latest_date_ga4_pages_daily", "fact_ga4_pages_daily"),
    ("latest_date_ga4_events_daily", "fact_ga4_events_daily"),
    ("latest_date_fact_yt_video_daily", "fact_yt_video_daily"),
    ("latest_date_fact_ga4_sessions_by_utm_daily", "fact_ga4_sessions_by_utm_daily"),
    ("latest_date_fact_rd_email_campaign", "fact_rd_email_campaign"),
    ("latest_date_fact_engagement_daily", "fact_engagement_daily"),
    ("latest_date_fact_comms_impact_daily", "fact_comms_impact_daily"),
)


def health(w: Warehouse) -> DataFrame:
    """(metric, value) text rows: row counts of 3 tables and latest date of 8.

    A missing table gives '0' / 'None'. One small aggregate per table (count and latest date
    together when both are asked), unioned: one job. A stored warehouse answers from file footers and partition folders.
    """
    wanted: dict[str, list[tuple[str, str]]] = {}
    for t in HEALTH_COUNTS:
        wanted.setdefault(t, []).append(("count", f"rows_{t}"))
    for metric, t in HEALTH_LATEST:
        wanted.setdefault(t, []).append(("latest", metric))
    parts = []
    for t, asks in wanted.items():
        if w.has(t):
            kinds = {k for k, _ in asks}
            one = w.table_facts(t, "count" in kinds, "latest" in kinds)
        else:
            one = w.spark.range(1).select(F.lit("0").alias("count"), F.lit("None").alias("latest"))
        for kind, metric in asks:
            parts.append(one.select(F.lit(metric).alias("metric"), F.col(kind).alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# Q21 / Q22
def weekly_report(w: Warehouse, start, end, top_n: int = 10, with_countries: bool = True) -> DataFrame:
    """Report sections as rows: (section, rank, label, value, display).

    KPIs (users, sessions, page views), top pages, video funnel and top countries; the
    display column carries the '.'-thousands text the report prints. Two reads of the events: all totals
    come from one aggregate (``Warehouse.report_totals``), the pages from another, which also tells whether there are any.
    """
    totals = w.report_totals(start, end, with_countries)
    place = F.row_number().over(Window.partitionBy("by_country").orderBy(F.col("users").desc_nulls_last(), F.col("country_id").asc_nulls_last()))
    line = lambda section, rank, label, value: F.struct(
        F.lit(section).alias("section"), F.lit(rank).alias("rank") if isinstance(rank, int) else rank.alias("rank"),
        (F.lit(label) if isinstance(label, str) else label).alias("label"), value.cast("double").alias("value"),
        F.lit(section == "top_pages").alias("instead"))
    rate = F.when(F.col("start") > 0, F.round(F.col("progress").cast("double") / F.col("start").cast("double") * F.lit(100.0), 2)) \
            .otherwise(F.lit(0.0))
    sums = F.array(*[line("kpis", i, c, F.col(c)) for i, c in enumerate(("users", "sessions", "pageviews"), 1)],
                   *[line("funnel", i, c, v) for i, (c, v) in enumerate(
                       (("start", F.col("start")), ("progress", F.col("progress")), ("completion_rate", rate)), 1)],
                   line("top_pages", 1, "Total", F.col("pageviews")))
    country = F.array(line("top_countries", F.col("place"), F.coalesce("country_id", F.lit("NA")), F.col("users")))
    # one row of totals and one per country, ranked; no more than the countries there are
    rows = (totals.withColumn("place", place).where(~F.col("by_country") | (F.col("place") <= top_n))
            .select(F.inline(F.when(F.col("by_country"), country).otherwise(sums))))
    if w.has("fact_ga4_pages_daily"):
        top = _top(_page_rows(w, start, end), "pageviews", ["page_path"], top_n)
        rk = Window.orderBy(F.col("pageviews").desc_nulls_last(), F.col("page_path").asc_nulls_last())
        pg = top.select(F.lit("top_pages").alias("section"), F.row_number().over(rk).cast("int").alias("rank"),
                        F.coalesce("page_title", "page_path", F.lit(UNTITLED_LABEL)).alias("label"),
                        F.col("pageviews").cast("double").alias("value"), F.lit(False).alias("instead"))
        rows = rows.unionByName(pg)
    pages = F.col("section") == "top_pages"
    found = F.count_if(pages & ~F.col("instead")).over(Window.partitionBy(F.lit(0)))
    out = rows.withColumn("found", found).where(~F.col("instead") | (F.col("found") == 0)).select("section", "rank", "label", "value")
    display = F.when(F.col("label") == "completion_rate", F.concat(F.col("value").cast("string"), F.lit("%"))) \
               .otherwise(C.thousands_dot("value"))
    return out.withColumn("display", display)


def weekly_summary(w: Warehouse, today=None) -> DataFrame:
    """Last 7 days back from ``today`` (default: the current date) inclusive (8 days), 5 pages,
    no countries."""
    d_end = C.as_date(today) if today is not None else _dt.date.today()
    d_start = d_end - _dt.timedelta(days=7)
    return weekly_report(w, d_start, d_end, top_n=5, with_countries=False)
