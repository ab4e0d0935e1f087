"""Materialise the warehouse: facts and marts written once, then served from Parquet.

At scale the served queries should not rebuild facts from raw events on every call. This
job writes every fact (partitioned by ``date`` or by period) and every mart into a
warehouse root; ``StoredWarehouse(spark, root)`` then answers the same queries with
partition pruning on ``date``.

Order follows the dependencies: facts from the sources first, then the marts that read the
*stored* facts (engagement from sessions + video days; campaign impact from UTM sessions +
map; summary from impact + sends).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators import tables as K
from tidemark.operators.calendar import calendar
from tidemark.plans import marts as M
from tidemark.schemas import PARTITION_COLS, TABLES
from tidemark.sources.warehouse import DerivedWarehouse, StoredWarehouse

SOURCE_FACTS = ("fact_sessions", "fact_ga4_events_daily", "fact_ga4_pages_daily", "fact_sessions_by_country",
                "fact_ga4_sessions_by_utm_daily", "map_utm_campaign", "fact_rd_email_campaign",
                "fact_yt_channel_daily", "fact_yt_video_period", "dim_date")


def _write(df, root: str, name: str) -> None:
    """Write ``df`` with the table's fixed schema; columns it lacks (e.g. the CSV-only
    session duration) are written as NULL."""
    out = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                      for f in TABLES[name].fields])
    K.rebuild(out, f"{root.rstrip('/')}/{name}", PARTITION_COLS.get(name))


def materialize(spark: SparkSession, sf_dir: str, root: str) -> StoredWarehouse:
    """Write all facts and marts derived from the driver tables under ``root``."""
    src = DerivedWarehouse(spark, sf_dir)
    for name in SOURCE_FACTS:
        _write(src.table(name), root, name)
    stored = StoredWarehouse(spark, root)
    _write(M.engagement_daily(stored.table("dim_date"), stored.table("fact_sessions"),
                              stored.table("fact_yt_channel_daily")), root, "fact_engagement_daily")
    build_comms(spark, root)
    return stored


def build_comms(spark: SparkSession, root: str) -> None:
    """Write the campaign impact per day, and per send, from the stored facts."""
    w = StoredWarehouse(spark, root)
    _write(M.comms_impact_daily(w.table("fact_ga4_sessions_by_utm_daily"), w.table("map_utm_campaign")),
           root, "fact_comms_impact_daily")
    _write(M.comms_impact_summary(w.table("fact_comms_impact_daily"), w.table("fact_rd_email_campaign")),
           root, "fact_comms_impact_summary")


def extend_calendar(spark: SparkSession, root: str) -> None:
    """Let the stored ``dim_date`` reach the day after the last day of any stored daily fact.

    The facts' last days come from their partition folders; no fact is read."""
    days = [C.as_date(v) for t in ("fact_sessions", "fact_yt_channel_daily")
            for v in K.partition_values(spark, f"{root}/{t}", "date") if v[:1].isdigit()]
    if not days:
        return
    first, last = StoredWarehouse(spark, root).table("dim_date").agg(F.min("date"), F.max("date")).first()
    end = max(days) + _dt.timedelta(days=1)
    if last is None or last < end or min(days) < first:
        _write(calendar(spark, min([*days, *([first] if first else [])]), max([end, *([last] if last else [])])),
               root, "dim_date")


def refresh_marts_window(spark: SparkSession, root: str, start, end) -> None:
    """After source windows were refreshed, bring the marts up to date for [start, end] only, instead of
    rebuilding them from all history.

    The same as a full rebuild for those days: an engagement day depends only on that day's
    sessions and video rows (and the calendar, which is extended first), a campaign-impact day only
    on that day's UTM sessions and the map; a window without rows becomes empty.
    """
    from tidemark.functions.columns import date_lit
    extend_calendar(spark, root)
    w = StoredWarehouse(spark, root)
    in_win = F.col("date").between(date_lit(start), date_lit(end))
    eng = M.engagement_daily(w.table("dim_date").where(in_win), w.fact("fact_sessions", start, end),
                             w.fact("fact_yt_channel_daily", start, end))
    K.replace_window(spark, eng, f"{root}/fact_engagement_daily", start, end, empty_clears=True)
    refresh_comms_window(spark, root, start, end)


def refresh_comms_window(spark: SparkSession, root: str, start, end) -> None:
    """The campaign days of [start, end] again, then the send summary (``refresh_comms_summary``). The map must be the one
    that the other days were made with; after a new map, ``build_comms``."""
    w = StoredWarehouse(spark, root)
    daily = M.comms_impact_daily(w.fact("fact_ga4_sessions_by_utm_daily", start, end), w.table("map_utm_campaign"))
    K.replace_window(spark, daily, f"{root}/fact_comms_impact_daily", start, end, empty_clears=True)
    refresh_comms_summary(spark, root, start, end)


def refresh_comms_summary(spark: SparkSession, root: str, start, end) -> None:
    """Merge into the stored send summary what new campaign days, and new sends, of [start, end] change.

    * Sends whose band D-1..D+2 meets the window, dated start-2 .. end+1, are computed again, from the days of these bands.
    * A campaign with a send in the window, before or after the refresh, has new totals: its rows outside keep their
      sessions and get them.

    Only the send dates of such rows are written again. A summary that isn't kept by send date yet is built whole.
    """
    s, e = C.as_date(start), C.as_date(end)
    first, last = s - _dt.timedelta(days=2), e + _dt.timedelta(days=1)
    w = StoredWarehouse(spark, root)
    path = w.path("fact_comms_impact_summary")
    K.recover(spark, path)
    if not K.partition_values(spark, path, "send_date"):
        build_comms(spark, root)
        return
    fresh, outside, totals = summary_changes(w, s, e, first, last)
    # at most one value per calendar day
    days = [r.send_date for r in outside.select("send_date").distinct().collect()]
    kept = w.table("fact_comms_impact_summary").where(F.col("send_date").isin(days))
    metrics = ("sends", "opens", "clicks")
    new = totals.select(F.col("campaignId").alias("_id"), F.lit(True).alias("_new"), *[F.col(c).alias(f"_{c}") for c in metrics])
    kept = kept.join(new, F.col("campaignId") == F.col("_id"), "left").select(
        *[(F.when(F.col("_new"), F.col(f"_{c}")).otherwise(F.col(c)) if c in metrics else F.col(c)).alias(c)
          for c in TABLES["fact_comms_impact_summary"].fieldNames()])
    band = [first + _dt.timedelta(days=i) for i in range((last - first).days + 1)]
    K.replace_partitions(spark, fresh.unionByName(kept), path, [*band, *days], "send_date")


def summary_changes(w: StoredWarehouse, start: _dt.date, end: _dt.date, first: _dt.date, last: _dt.date):
    """(summary rows of the send dates first..last, stored rows of other dates whose campaign's totals moved, these totals)."""
    sends, stored = w.table("fact_rd_email_campaign"), w.table("fact_comms_impact_summary")
    within = lambda c: F.col(c).between(F.lit(start), F.lit(end))
    moved = (sends.where(within("date")).select("campaignId")
             .unionByName(stored.where(within("send_date")).select("campaignId")).distinct())
    fresh = M.comms_impact_summary(w.table("fact_comms_impact_daily"), sends, send_dates=(first, last))
    outside = (stored.where(~F.col("send_date").between(F.lit(first), F.lit(last))).select("campaignId", "send_date")
               .join(moved, "campaignId", "left_semi"))
    return fresh, outside, M.send_totals(sends.join(moved, "campaignId", "left_semi"))
