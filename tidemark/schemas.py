"""Fixed schemas of the warehouse tables and the dataset registry.

Facts are daily ("tidy": dimensions + numeric metrics). At rest they are Parquet partitioned
by ``date`` (period facts by ``startDate``/``endDate``) so that every date-range read prunes
partitions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

S, L, D, DT, I, B = T.StringType(), T.LongType(), T.DoubleType(), T.DateType(), T.IntegerType(), T.BooleanType()


def _st(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


TABLES: dict[str, T.StructType] = {
    "dim_date": _st(("date", DT), ("year", I), ("month", I), ("week", I)),
    "dim_page": _st(("page_path", S), ("page_title", S)),
    "dim_video": _st(("video_title", S)),
    "dim_country": _st(("country_id", S)),
    "fact_sessions": _st(("date", DT), ("pageviews", L), ("sessions", L), ("users", L),
                         ("avg_session_duration", D)),
    "fact_events": _st(("date", DT), ("event_name", S), ("event_count", L), ("video_title", S)),
    "fact_sessions_by_country": _st(("date", DT), ("country_id", S), ("users", L)),
    "fact_ga4_events_daily": _st(("date", DT), ("eventName", S), ("eventCount", L), ("activeUsers", L)),
    "fact_ga4_pages_daily": _st(("date", DT), ("pagePath", S), ("pageTitle", S),
                                ("screenPageViews", L), ("sessions", L), ("totalUsers", L)),
    "fact_ga4_sessions_by_utm_daily": _st(("date", DT), ("source", S), ("medium", S), ("campaign", S),
                                          ("sessions", L), ("users", L)),
    "map_utm_campaign": _st(("utm_source", S), ("utm_medium", S), ("utm_campaign", S),
                            ("campaignId", S), ("campaign_name", S), ("utm_source_norm", S),
                            ("utm_medium_norm", S), ("utm_campaign_norm", S)),
    "fact_rd_email_campaign": _st(("date", DT), ("campaignId", S), ("sends", L), ("opens", L), ("clicks", L)),
    "fact_rd_lead_stage_daily": _st(("date", DT), ("stage", S), ("count", L)),
    "fact_yt_channel_daily": _st(("date", DT), ("views", L), ("estimatedMinutesWatched", L),
                                 ("averageViewDuration", D)),
    "fact_yt_video_period": _st(("videoId", S), ("views", L), ("estimatedMinutesWatched", L),
                                ("averageViewDuration", D), ("startDate", DT), ("endDate", DT)),
    "fact_engagement_daily": _st(("date", DT), ("sessions", L), ("pageviews", L), ("views", L),
                                 ("estimatedMinutesWatched", L), ("averageViewDuration", D)),
    "fact_comms_impact_daily": _st(("date", DT), ("campaignId", S), ("sessions", L), ("users", L)),
    "fact_comms_impact_summary": _st(("campaignId", S), ("send_date", DT), ("ses_d_1", L), ("ses_d0", L),
                                     ("ses_d0_d2", L), ("uplift_abs", L), ("uplift_pct", D),
                                     ("sends", L), ("opens", L), ("clicks", L)),
    "table_profile": _st(("dataset", S), ("date", DT), ("kind", S), ("name", S), ("rows", L), ("nulls", L),
                         ("duplicate_keys", L), ("duplicate_rows", L)),
    "quarantine": _st(("table_name", S), ("landing", S), ("reason", S), ("kept", B), ("source_file", S), ("record", S)),
    "datasets_catalog": _st(("source", S), ("dataset", S), ("type", S), ("name", S), ("description", S)),
}

# Partition columns at rest.
PARTITION_COLS: dict[str, list[str]] = {
    "fact_sessions": ["date"],
    "fact_events": ["date"],
    "fact_sessions_by_country": ["date"],
    "fact_ga4_events_daily": ["date"],
    "fact_ga4_pages_daily": ["date"],
    "fact_ga4_sessions_by_utm_daily": ["date"],
    "fact_rd_email_campaign": ["date"],
    "fact_rd_lead_stage_daily": ["date"],
    "fact_yt_channel_daily": ["date"],
    "fact_yt_video_period": ["startDate", "endDate"],
    "fact_engagement_daily": ["date"],
    "fact_comms_impact_daily": ["date"],
    "fact_comms_impact_summary": ["send_date"],
    "table_profile": ["dataset", "date"],
    "quarantine": ["table_name", "landing"],
}

# Column by whose days a table without a ``date`` is profiled.
PROFILE_DATE = {"fact_yt_video_period": "startDate", "fact_comms_impact_summary": "send_date"}

# Which source each table comes from (field catalog, M10).
TABLE_SOURCE = {
    "fact_sessions": "GA4",
    "fact_ga4_events_daily": "GA4",
    "fact_ga4_pages_daily": "GA4",
    "fact_ga4_sessions_by_utm_daily": "GA4",
    "fact_yt_channel_daily": "YouTube",
    "fact_yt_video_period": "YouTube",
    "fact_sessions_by_country": "GA4/CSV",
    "fact_events": "GA4/CSV",
    "fact_rd_email_campaign": "RD",
    "fact_rd_lead_stage_daily": "RD",
    "map_utm_campaign": "CSV",
    "fact_engagement_daily": "mart",
    "fact_comms_impact_daily": "mart",
    "fact_comms_impact_summary": "mart",
}


@dataclass(frozen=True)
class Dataset:
    """One entry of the dataset registry: grain, freshness and declared checks."""
    id: str
    table: str
    source: str
    entity: str
    dimensions: tuple[str, ...]
    metrics: tuple[str, ...]
    granularity: str = "daily"
    freshness_ttl_minutes: int = 60
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    description: str = ""


# The registry entries (ids, dimensions, metrics, TTLs and declared checks).
REGISTRY: tuple[Dataset, ...] = (
    Dataset("ga4_events_daily", "fact_ga4_events_daily", "GA4", "events",
            ("date", "eventName"), ("eventCount", "activeUsers"), "daily", 60,
            not_null=("date", "eventName"), unique=("date", "eventName")),
    Dataset("ga4_pages_daily", "fact_ga4_pages_daily", "GA4", "pages",
            ("date", "pagePath", "pageTitle"), ("screenPageViews", "sessions", "totalUsers"), "daily", 60,
            not_null=("date", "pagePath"), unique=("date", "pagePath")),
    Dataset("ga4_sessions_by_utm_daily", "fact_ga4_sessions_by_utm_daily", "GA4", "sessions_utm",
            ("date", "source", "medium", "campaign"), ("sessions", "users"), "daily", 60,
            not_null=("date",)),
    Dataset("rd_email_campaign", "fact_rd_email_campaign", "RD", "email_campaign",
            ("date", "campaignId"), ("sends", "opens", "clicks"), "daily", 120,
            not_null=("date", "campaignId")),
)


def load_registry(source: str, table_of: dict[str, str] | None = None) -> tuple[Dataset, ...]:
    """Dataset registry from YAML (a path or the text itself), read on the driver.

    Each entry: id, source, entity, description, dimensions[], metrics[], granularity,
    freshness_ttl_minutes, quality_checks{not_null[], unique[]}. The warehouse table of an
    entry is ``table_of[id]`` when given, else ``fact_<id>``.
    """
    import os

    import yaml

    text = open(source, encoding="utf-8").read() if os.path.exists(source) else source
    out = []
    for e in yaml.safe_load(text) or []:
        checks = e.get("quality_checks") or {}
        out.append(Dataset(
            id=e["id"], table=(table_of or {}).get(e["id"], f"fact_{e['id']}"), source=e.get("source", ""),
            entity=e.get("entity", ""), dimensions=tuple(e.get("dimensions") or ()),
            metrics=tuple(e.get("metrics") or ()), granularity=e.get("granularity", "daily"),
            freshness_ttl_minutes=int(e.get("freshness_ttl_minutes", 60)),
            not_null=tuple(checks.get("not_null") or ()), unique=tuple(checks.get("unique") or ()),
            description=e.get("description", "")))
    return tuple(out)
