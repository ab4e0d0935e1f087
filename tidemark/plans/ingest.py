"""Refresh and import marts: landed responses / exports → warehouse tables.

Each function reads landed files, normalises them (rename, safe casts, ``yyyyMMdd`` dates)
and applies the table operator of its kind: window replace (K2), period replace (K3), full
rebuild (K4), append + key upsert (K5 + U3). All of them are idempotent except the CSV
appends, which are append-only by definition.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import columns as C
from tidemark.operators import tables as K
from tidemark.sources import exports as X
from tidemark.sources import landed as L
from tidemark.sources.adapters import with_utm_norm


def refresh_window(as_of, days: int = 30) -> tuple[_dt.date, _dt.date]:
    """The last ``days`` days up to ``as_of``: ``days + 1`` dates, both ends included."""
    end = C.as_date(as_of)
    return end - _dt.timedelta(days=days), end


@dataclass(frozen=True)
class ReportSpec:
    """One analytics pull: requested names and their warehouse columns."""
    table: str
    dimensions: tuple[str, ...]
    metrics: tuple[str, ...]
    rename: tuple[tuple[str, str], ...]
    columns: tuple[str, ...]


# The four analytics pulls (request names → warehouse names).
SESSIONS = ReportSpec("fact_sessions", ("date",), ("totalUsers", "sessions", "screenPageViews"),
                      (("totalUsers", "users"), ("screenPageViews", "pageviews")),
                      ("date", "pageviews", "sessions", "users"))
SESSIONS_BY_UTM = ReportSpec("fact_ga4_sessions_by_utm_daily",
                             ("date", "sessionSource", "sessionMedium", "sessionCampaignName"),
                             ("sessions", "totalUsers"),
                             (("sessionSource", "source"), ("sessionMedium", "medium"),
                              ("sessionCampaignName", "campaign"), ("totalUsers", "users")),
                             ("date", "source", "medium", "campaign", "sessions", "users"))
EVENTS = ReportSpec("fact_ga4_events_daily", ("date", "eventName"), ("eventCount", "activeUsers"), (),
                    ("date", "eventName", "eventCount", "activeUsers"))
PAGES = ReportSpec("fact_ga4_pages_daily", ("date", "pagePath", "pageTitle"),
                   ("screenPageViews", "sessions", "totalUsers"), (),
                   ("date", "pagePath", "pageTitle", "screenPageViews", "sessions", "totalUsers"))
REPORTS = {s.table: s for s in (SESSIONS, SESSIONS_BY_UTM, EVENTS, PAGES)}


def report_batch(spark: SparkSession, report_path: str, spec: ReportSpec) -> DataFrame:
    """S3 → P2 → F7 → F4: the flattened, renamed, typed batch of one analytics report."""
    raw = L.read_report(spark, report_path, spec.dimensions, spec.metrics)
    ren = dict(spec.rename)
    cols = []
    for d in spec.dimensions:
        c = C.ymd_date(d) if d == "date" else F.col(d).cast("string")
        cols.append(c.alias(ren.get(d, d)))
    for m in spec.metrics:
        cols.append(F.col(m).try_cast("bigint").alias(ren.get(m, m)))
    return raw.select(*cols).select(*spec.columns)


def report_rejects(spark: SparkSession, report_path: str, spec: ReportSpec, start, end) -> DataFrame:
    """(reason, rows) of a landed report: what a refresh of [start, end] leaves out (``bad_date``,
    ``out_of_window``), and the metric values that are no numbers and become NULL (``bad_number``)."""
    raw = L.read_report_text(spark, report_path, spec.dimensions, spec.metrics)
    day = C.ymd_date("date")
    outside = day.isNotNull() & ~day.between(C.date_lit(start), C.date_lit(end))
    no_number = [(F.col(m).isNotNull() & C.safe_double(m).isNull()).cast("bigint") for m in spec.metrics]
    counts = raw.agg(F.count_if(day.isNull()).alias("bad_date"), F.count_if(outside).alias("out_of_window"),
                     F.coalesce(F.sum(sum(no_number[1:], no_number[0])), F.lit(0)).alias("bad_number"))
    return counts.select(F.explode(F.create_map(*[x for c in counts.columns for x in (F.lit(c), F.col(c))]))
                         .alias("reason", "rows"))


def report_quarantine(spark: SparkSession, report_path: str, spec: ReportSpec, start, end) -> DataFrame:
    """The landed rows behind ``report_rejects``, one by one: reason, whether the row is ``kept`` in the table all the same (with
    NULL for a value that is no number), the file it stands in and its values as landed, as JSON."""
    raw = L.read_report_text(spark, report_path, spec.dimensions, spec.metrics, file_column="_file")
    day = C.ymd_date("date")
    no_number = F.lit(False)
    for m in spec.metrics:
        no_number = no_number | (F.col(m).isNotNull() & C.safe_double(m).isNull())
    reason = (F.when(day.isNull(), "bad_date").when(~day.between(C.date_lit(start), C.date_lit(end)), "out_of_window")
              .when(no_number, "bad_number"))
    rows = raw.withColumn("reason", reason).where("reason is not null")
    return rows.select(F.lit(spec.table).alias("table_name"), F.lit(landing_id(report_path)).alias("landing"), "reason",
                       (F.col("reason") == "bad_number").alias("kept"), F.col("_file").alias("source_file"),
                       F.to_json(F.struct(*spec.dimensions, *spec.metrics)).alias("record"))


def landing_id(path: str) -> str:
    """Names a landing in the quarantine: the same path is the same landing."""
    return "landing-" + hashlib.sha256(path.rstrip("/").encode()).hexdigest()[:16]


def quarantine_report(spark: SparkSession, report_path: str, root: str, spec: ReportSpec, start, end) -> None:
    """Keep the rejected rows of one landing in ``<root>/quarantine``; those of an earlier run of the same landing go."""
    rows = report_quarantine(spark, report_path, spec, start, end).drop("table_name")
    K.replace_partitions(spark, rows, f"{root.rstrip('/')}/quarantine/table_name={spec.table}", [landing_id(report_path)], "landing")


# M1–M4
def refresh_report(spark: SparkSession, report_path: str, table_path: str, spec: ReportSpec,
                   start, end, quarantine_root: str | None = None) -> bool:
    """Replace the window [start, end] of ``spec.table`` with the landed report. With ``quarantine_root`` the rows that it
    leaves out are kept there first."""
    if quarantine_root:
        quarantine_report(spark, report_path, quarantine_root, spec, start, end)
    return K.replace_window(spark, report_batch(spark, report_path, spec), table_path, start, end)


def refresh_reports(spark: SparkSession, reports: dict[str, str], root: str, as_of, days: int = 30) -> dict[str, bool]:
    """Refresh several analytics facts from their landed reports over the same window (the
    "refresh all" action): ``reports`` maps a fact table to its landed report path."""
    start, end = refresh_window(as_of, days)
    return {t: refresh_report(spark, path, f"{root}/{t}", REPORTS[t], start, end, root) for t, path in reports.items()}


# M5a
def yt_channel_batch(spark: SparkSession, path: str) -> DataFrame:
    r = L.read_video_report(spark, path, ("day", "views", "estimatedMinutesWatched", "averageViewDuration"))
    return r.select(F.try_to_date(F.col("day"), "yyyy-MM-dd").alias("date"),
                    C.safe_long("views").alias("views"),
                    C.safe_long("estimatedMinutesWatched").alias("estimatedMinutesWatched"),
                    C.safe_double("averageViewDuration").alias("averageViewDuration"))


def refresh_yt_channel(spark: SparkSession, path: str, table_path: str, start, end) -> bool:
    return K.replace_window(spark, yt_channel_batch(spark, path), table_path, start, end)


# M5b
def yt_videos_batch(spark: SparkSession, path: str, max_results: int = 50, start=None, end=None) -> DataFrame:
    """Video × period rows, the ``max_results`` most viewed per period (ties by videoId).

    ``start``/``end`` give the period of a single-period landing; without them the landing
    is partitioned by ``startDate``/``endDate`` folders and every period is handled at once.
    The per-period top-N is a row_number filter, which Spark plans with a partial group
    limit before the shuffle (at most N rows per period leave each task).
    """
    cols = ("video", "views", "estimatedMinutesWatched", "averageViewDuration")
    if start is not None:
        r = L.read_video_report(spark, path, cols).select(
            *cols, C.date_lit(start).alias("startDate"), C.date_lit(end).alias("endDate"))
    else:
        schema = T.StructType(L.VIDEO_REPORT_SCHEMA.fields + [T.StructField("startDate", T.DateType()),
                                                               T.StructField("endDate", T.DateType())])
        pages = spark.read.schema(schema).json(path)
        rows = pages.select("startDate", "endDate", F.col("columnHeaders.name").alias("h"), F.explode("rows").alias("r"))
        r = rows.select(*[L.value_of(c, "h", F.col("r")).alias(c) for c in cols], "startDate", "endDate")
    typed = r.select(F.col("video").cast("string").alias("videoId"),
                     C.safe_long("views").alias("views"),
                     C.safe_long("estimatedMinutesWatched").alias("estimatedMinutesWatched"),
                     C.safe_double("averageViewDuration").alias("averageViewDuration"),
                     "startDate", "endDate")
    w = Window.partitionBy("startDate", "endDate").orderBy(F.col("views").desc_nulls_last(), F.col("videoId"))
    return typed.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= max_results).drop("_rn")


def refresh_yt_videos(spark: SparkSession, path: str, table_path: str, max_results: int = 50,
                      start=None, end=None) -> bool:
    return K.replace_period(yt_videos_batch(spark, path, max_results, start, end), table_path)


def refresh_yt_channel_and_videos(spark: SparkSession, channel_path: str, videos_path: str, root: str,
                                  as_of, days: int = 30, max_results: int = 50) -> tuple[bool, bool]:
    """M5 as one job entry: channel days of the last ``days`` days (window replace) and the
    top ``max_results`` videos of that same period (period replace). Either report may be
    empty, which leaves its table untouched."""
    start, end = refresh_window(as_of, days)
    return (refresh_yt_channel(spark, channel_path, f"{root}/fact_yt_channel_daily", start, end),
            refresh_yt_videos(spark, videos_path, f"{root}/fact_yt_video_period", max_results, start, end))


# M11
def email_campaign_batch(spark: SparkSession, campaigns_path: str, metrics_path: str, end) -> DataFrame:
    """Campaign records ⟕ their metrics (one row per campaign id), send date from the first
    present time field (first 10 characters), window end when none; empty ids skipped."""
    c = L.read_campaigns(spark, campaigns_path)
    cid = C.first_truthy("id", "campaignId", "uuid")
    sent = C.first_truthy("send_datetime", "sent_at", "scheduled_at", "created_at")
    camp = (c.select(cid.alias("campaignId"),
                     C.iso_prefix_date(F.coalesce(sent, F.lit(C.as_date(end).isoformat()))).alias("date"))
             .where(F.col("campaignId").isNotNull()))
    m = (L.read_campaign_metrics(spark, metrics_path).groupBy("campaignId")
          .agg(F.max("sends").alias("sends"), F.max("opens").alias("opens"), F.max("clicks").alias("clicks")))
    j = camp.join(m, "campaignId", "left")
    return j.select("date", "campaignId",
                    *[F.coalesce(F.col(x), F.lit(0)).cast("bigint").alias(x) for x in ("sends", "opens", "clicks")])


def refresh_email_campaigns(spark: SparkSession, campaigns_path: str, metrics_path: str, table_path: str,
                            start, end) -> bool:
    """Out-of-window campaigns (a pull without date filter returns them) are not inserted,
    so re-runs do not pile them up."""
    return K.replace_window(spark, email_campaign_batch(spark, campaigns_path, metrics_path, end),
                            table_path, start, end)


# M12
def lead_stage_batch(spark: SparkSession, contacts_path: str, start, end) -> DataFrame:
    """Contacts updated in the window, counted per stage (first present stage field, else
    'unknown'), dated the window end."""
    c = L.read_contacts(spark, contacts_path, start, end)
    stage = F.coalesce(C.first_truthy("lifecycle_stage", "funnel_stage", "status"), F.lit("unknown"))
    return (c.groupBy(stage.alias("stage")).agg(F.count(F.lit(1)).alias("count"))
             .select(C.date_lit(end).alias("date"), "stage", "count"))


def refresh_lead_stage(spark: SparkSession, contacts_path: str, table_path: str, start, end) -> bool:
    """Snapshot of the window end; the snapshot day is replaced, so a re-run does not double it."""
    return K.replace_window(spark, lead_stage_batch(spark, contacts_path, start, end), table_path, end, end)


# M13
def import_utm_map(spark: SparkSession, csv_path: str | None, table_path: str) -> None:
    """Full replace of the UTM map, with the normalised key columns; no file → empty map."""
    K.rebuild(with_utm_norm(X.read_utm_map(spark, csv_path)), table_path)


# M14
def import_pages_csv(spark: SparkSession, paths: list[str], root: str, import_date, buckets: int | None = None) -> bool:
    df = X.import_exports(spark, paths)
    if df is None:
        return False
    dim, fact = X.pages_export(df, import_date)
    K.upsert_table(spark, dim, f"{root}/dim_page", "dim_page", "page_path", buckets)
    K.append(fact, f"{root}/fact_sessions", ["date"])
    return True


def import_videos_csv(spark: SparkSession, paths_by_event: dict[str, list[str]], root: str, import_date) -> bool:
    done = False
    for event_name, paths in paths_by_event.items():
        df = X.import_exports(spark, paths)
        if df is None:
            continue
        dim, fact = X.videos_export(df, event_name, import_date)
        K.upsert_table(spark, dim, f"{root}/dim_video", "dim_video", "video_title")
        K.append(fact, f"{root}/fact_events", ["date"])
        done = True
    return done


def import_countries_csv(spark: SparkSession, paths: list[str], root: str, import_date) -> bool:
    df = X.import_exports(spark, paths)
    if df is None:
        return False
    dim, fact = X.countries_export(df, import_date)
    K.upsert_table(spark, dim, f"{root}/dim_country", "dim_country", "country_id")
    K.append(fact, f"{root}/fact_sessions_by_country", ["date"])
    return True
