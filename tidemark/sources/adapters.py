"""Warehouse facts derived from the driver's tables.

The driver ships TPC-H-style tables plus an ``events`` stream; these builders project them
onto the warehouse schemas (web sessions, page views, UTM sessions, e-mail campaigns, video
days and periods). Each one is a lazy DataFrame; nothing is collected.

Scale notes (what each plan does at 100 TB of events):

* Events are always aggregated (with map-side partial aggregation) *before* any join, so a
  hot key (one user, one page key holding a third of the rows) is collapsed before the
  shuffle and joins see at most one row per (day, key).
* Date-grain facts accept a date window; the window becomes a range predicate on the raw
  ``ts`` column, which Parquet can push down (``PushedFilters``) and a ``date``-partitioned
  layout turns into partition pruning.
* No explicit broadcast: dimension sides (nation, the page-key set) are joined plainly and
  AQE broadcasts them only after measuring them at runtime.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators.distinct import sessions_and_users

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                 "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

VIEW_LIKE = ("view", "click")


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as it is now: files and schema are listed at every call."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def event_rows(events: DataFrame, start=None, end=None) -> DataFrame:
    """``ev``: one row per event with its day, session key (user × hour, so ``hour`` is the
    session's slot within its user), whole value and page key ``k``.

    ``ts`` is TIMESTAMP_NTZ, so the day does not depend on the session time zone.
    """
    if start is not None:
        events = events.where(F.col("ts") >= C.ts_floor_lit(start))
    if end is not None:
        events = events.where(F.col("ts") < C.ts_floor_lit(C.as_date(end) + _dt.timedelta(days=1)))
    return events.select(
        "event_id",
        F.to_date("ts").alias("date"),
        "user_id",
        "event_type",
        (F.col("user_id") * 24 + F.hour("ts")).alias("session_key"),
        F.hour("ts").alias("hour"),
        F.floor("value").alias("val"),
        F.get_json_object("props", "$.k").try_cast("int").alias("k"),
    )


def _flag(cond) -> F.Column:
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def fact_sessions(ev: DataFrame) -> DataFrame:
    """date → pageviews (view events), sessions, users."""
    out = sessions_and_users(ev, ["date"], sums={"pageviews": _flag(F.col("event_type") == "view")},
                             session_slot="hour")
    return out.select("date", "pageviews", "sessions", "users")


def fact_ga4_events_daily(ev: DataFrame) -> DataFrame:
    """date × eventName → eventCount, activeUsers (one distinct column: no Expand)."""
    name = (F.when(F.col("event_type") == "view", F.lit("video_start"))
             .when(F.col("event_type") == "click", F.lit("video_progress"))
             .otherwise(F.col("event_type")))
    return (ev.groupBy("date", "event_type")
              .agg(F.count(F.lit(1)).alias("eventCount"), F.countDistinct("user_id").alias("activeUsers"))
              .select("date", name.alias("eventName"), "eventCount", "activeUsers"))


def fact_ga4_pages_daily(ev: DataFrame, pages: DataFrame) -> DataFrame:
    """date × pagePath × pageTitle → screenPageViews, sessions, totalUsers.

    Events are aggregated per (date, k) first; only then is the page table consulted, so the join
    sees one row per day and page. AQE broadcasts whichever measured side is small. A page id
    listed twice with one url counts twice, as a row-level join would.
    """
    agg = sessions_and_users(ev, ["date", "k"], users_name="totalUsers", session_slot="hour",
                             sums={"screenPageViews": _flag(F.col("event_type").isin(*VIEW_LIKE))})
    page_urls = pages.select("page_id", "url").groupBy("page_id", "url").agg(F.count(F.lit(1)).alias("_copies"))
    j = agg.join(page_urls, agg["k"] == page_urls["page_id"], "left")
    copies = F.coalesce(F.col("_copies"), F.lit(1))
    return j.select(
        "date",
        F.concat(F.lit("/p/"), F.col("k").cast("string")).alias("pagePath"),
        F.when(F.col("k") % 10 != 0, F.col("url")).alias("pageTitle"),
        (F.col("screenPageViews") * copies).alias("screenPageViews"),
        "sessions",
        "totalUsers",
    )


def fact_sessions_by_country(ev: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """date × country → distinct users. (date, user) pairs are made distinct before the join."""
    day_users = ev.select("date", "user_id").where(F.col("user_id").isNotNull()).distinct()
    cust = customer.select(F.col("c_custkey").alias("user_id"), "c_nationkey")
    nat = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country_id"))
    return (day_users.join(cust, "user_id").join(nat, "c_nationkey")
                     .groupBy("date", "country_id")
                     .agg(F.countDistinct("user_id").alias("users")))


REPORT_SUMS = ("users", "sessions", "pageviews", "start", "progress")


def report_totals(ev: DataFrame, customer: DataFrame | None = None, nation: DataFrame | None = None) -> DataFrame:
    """(by_country, country_id, users, sessions, pageviews, start, progress) in one pass over the events: one row with the window's
    totals (``by_country`` false, also without events) and, with ``customer`` and ``nation``, one row of users per country.

    What ``fact_sessions``, ``fact_ga4_events_daily`` and ``fact_sessions_by_country`` give when added up: events are reduced
    to one row per day and user first; a user's countries, at most the nations there are, then ride on that row.
    """
    mask = F.bit_count(F.bit_or(F.expr("shiftleft(CAST(1 AS BIGINT), hour)")))
    known = F.col("user_id").isNotNull()
    count = lambda *types: F.count_if(F.col("event_type").isin(*types))
    days = ev.groupBy("date", "user_id").agg(mask.alias("slots"), count("view").alias("pageviews"),
                                             count("view", "video_start").alias("start"), count("click", "video_progress").alias("progress"))
    total = F.struct(F.lit(False).alias("by_country"), F.lit(None).cast("string").alias("country_id"), known.cast("bigint").alias("users"),
                     F.when(known, F.coalesce("slots", F.lit(0))).otherwise(F.lit(0)).cast("bigint").alias("sessions"),
                     *[F.col(c) for c in REPORT_SUMS[2:]])
    lines = F.array(total)
    if customer is not None:
        nat = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country_id"))
        homes = (customer.select(F.col("c_custkey").alias("user_id"), "c_nationkey").join(nat, "c_nationkey")
                 .groupBy("user_id").agg(F.collect_set(F.struct("country_id")).alias("homes")))
        days = days.join(homes, "user_id", "left")
        zero = F.lit(0).cast("bigint")
        lines = F.concat(lines, F.coalesce(F.transform("homes", lambda h: F.struct(
            F.lit(True).alias("by_country"), h.country_id.alias("country_id"), F.lit(1).cast("bigint").alias("users"),
            zero.alias("sessions"), *[zero.alias(c) for c in REPORT_SUMS[2:]])), F.array().cast("array<struct<by_country:boolean,"
            "country_id:string,users:bigint,sessions:bigint,pageviews:bigint,start:bigint,progress:bigint>>")))
    rows = days.select(F.inline(lines))
    none = rows.sparkSession.range(1).select(F.lit(False).alias("by_country"), F.lit(None).cast("string").alias("country_id"),
                                             *[F.lit(0).cast("bigint").alias(c) for c in REPORT_SUMS])
    return rows.unionByName(none).groupBy("by_country", "country_id").agg(*[F.sum(c).alias(c) for c in REPORT_SUMS])


def utm_rows(ev: DataFrame) -> DataFrame:
    """Events with their (messy on purpose) UTM source, medium and campaign."""
    k = F.col("k")
    source = (F.when(k % 2 == 0, F.upper("event_type"))
               .otherwise(F.concat(F.lit(" "), F.col("event_type"))))
    medium = F.when(k % 3 == 0, F.lit("Email ")).when(k % 3 == 1, F.lit("cpc"))
    campaign = F.concat(F.lit(" Camp-"), (k % 8).cast("string"))
    return ev.select("date", "session_key", "hour", "user_id", source.alias("source"),
                     medium.alias("medium"), campaign.alias("campaign"))


def fact_ga4_sessions_by_utm_daily(ev: DataFrame) -> DataFrame:
    out = sessions_and_users(utm_rows(ev), ["date", "source", "medium", "campaign"], session_slot="hour")
    return out.select("date", "source", "medium", "campaign", "sessions", "users")


def map_utm_campaign(ev: DataFrame) -> DataFrame:
    """UTM triple → campaign mapping with the normalised key columns."""
    b = (F.col("k") % 8).cast("string")
    raw = (ev.where(F.col("k").isNotNull())
             .select(F.concat(F.col("event_type"), F.lit(" ")).alias("utm_source"),
                     F.lit("EMAIL").alias("utm_medium"),
                     F.concat(F.lit("camp-"), b).alias("utm_campaign"),
                     F.concat(F.lit("C"), b).alias("campaignId"),
                     F.concat(F.lit("Campaign "), b).alias("campaign_name"))
             .distinct())
    return with_utm_norm(raw)


def with_utm_norm(m: DataFrame) -> DataFrame:
    return m.select("utm_source", "utm_medium", "utm_campaign", "campaignId", "campaign_name",
                    C.norm_key("utm_source").alias("utm_source_norm"),
                    C.norm_key("utm_medium").alias("utm_medium_norm"),
                    C.norm_key("utm_campaign").alias("utm_campaign_norm"))


def fact_rd_email_campaign(ev: DataFrame) -> DataFrame:
    """Campaign sends: a campaign is a bucket k % 8, sent once a week, dated its first event of the week."""
    per_send = (ev.where(F.col("k").isNotNull())
                  .groupBy((F.col("k") % 8).alias("b"), C.week_start("date").alias("week"))
                  .agg(F.min("date").alias("date"), F.count(F.lit(1)).alias("sends"),
                       F.sum(_flag(F.col("event_type").isin(*VIEW_LIKE))).cast("bigint").alias("opens"),
                       F.sum(_flag(F.col("event_type") == "click")).cast("bigint").alias("clicks")))
    return per_send.select("date", F.concat(F.lit("C"), F.col("b").cast("string")).alias("campaignId"),
                           "sends", "opens", "clicks")


def _video_events(ev: DataFrame) -> DataFrame:
    return ev.where(F.col("event_type").isin(*VIEW_LIKE))


def fact_yt_channel_daily(ev: DataFrame) -> DataFrame:
    """Video day: views, minutes, mean seconds."""
    v = _video_events(ev)
    return (v.groupBy("date")
             .agg(F.count(F.lit(1)).alias("views"), F.sum("val").alias("_m"))
             .select("date", "views", F.col("_m").cast("bigint").alias("estimatedMinutesWatched"),
                     (F.col("_m").cast("double") / F.col("views").cast("double")).alias("averageViewDuration")))


def engagement_days(ev: DataFrame) -> DataFrame:
    """Per day with events: web sessions and page views, video views, minutes and mean seconds, in one pass over the
    events (``fact_sessions`` and ``fact_yt_channel_daily`` side by side)."""
    video = F.col("event_type").isin(*VIEW_LIKE)
    days = sessions_and_users(ev, ["date"], session_slot="hour", sums={
        "pageviews": _flag(F.col("event_type") == "view"), "views": _flag(video), "minutes": F.when(video, F.col("val"))})
    zero = F.lit(0).cast("bigint")
    return days.select("date", "sessions", "pageviews", "views", F.coalesce("minutes", zero).alias("estimatedMinutesWatched"),
                       F.coalesce(F.col("minutes").cast("double") / F.nullif(F.col("views"), zero).cast("double"), F.lit(0.0))
                       .alias("averageViewDuration"))


def fact_yt_video_period(ev: DataFrame) -> DataFrame:
    """Video × Monday-to-Sunday period."""
    v = _video_events(ev).withColumn("startDate", C.week_start("date"))
    return (v.groupBy("k", "startDate")
             .agg(F.count(F.lit(1)).alias("views"), F.sum("val").alias("_m"))
             .select(F.concat(F.lit("v"), F.col("k").cast("string")).alias("videoId"),
                     "views",
                     F.col("_m").cast("bigint").alias("estimatedMinutesWatched"),
                     (F.col("_m").cast("double") / F.col("views").cast("double")).alias("averageViewDuration"),
                     "startDate",
                     F.date_add("startDate", 6).alias("endDate")))
