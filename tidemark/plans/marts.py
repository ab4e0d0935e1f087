"""Derived marts: calendar, engagement per day, campaign impact per day and per send.

Pure functions DataFrame → DataFrame; writing them is the caller's choice
(``operators.tables.rebuild``).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators.calendar import calendar, calendar_from_bounds


def dim_date_from_events(events: DataFrame, days_after: int = 1) -> DataFrame:
    """Calendar from the first event day to ``days_after`` days past the last one.

    The bounds are a min/max over ``ts`` only (a one-column scan).
    """
    bounds = events.agg(F.to_date(F.min("ts")).alias("lo"),
                        F.date_add(F.to_date(F.max("ts")), days_after).alias("hi"))
    return calendar_from_bounds(bounds)


ENGAGEMENT = ("sessions", "pageviews", "views", "estimatedMinutesWatched", "averageViewDuration")


def _filled() -> list:
    """The engagement columns, zeros for missing days."""
    return [F.coalesce(c, F.lit(0.0) if c == "averageViewDuration" else F.lit(0).cast("bigint")).alias(c) for c in ENGAGEMENT]


def engagement_from_days(days: DataFrame) -> DataFrame:
    """Calendar spine ⟕ ``days`` (one row per day with events). The calendar runs from the first of these days to the
    day after the last one, so its bounds come from the same aggregate and no other read of the events."""
    bounds = days.agg(F.min("date").alias("lo"), F.date_add(F.max("date"), 1).alias("hi")).where("lo is not null")
    return calendar_from_bounds(bounds).select("date").join(days, "date", "left").select("date", *_filled())


def engagement_window(days: DataFrame, events: DataFrame, start, end) -> DataFrame:
    """The rows of ``engagement_from_days`` inside [start, end], from the days of the window and the day before it.

    Every day of the window is laid out beside ``days``; the first and last day with events then bound
    the calendar (over at most one row per day of the window), unless history goes on outside: that takes one event on
    either side, found in the files whose ``ts`` statistics allow it.
    """
    s, e = C.as_date(start), C.as_date(end)
    one = _dt.timedelta(days=1)
    earlier = events.where(F.col("ts") < C.ts_floor_lit(s)).select(F.lit(1)).limit(1)
    later = events.where(F.col("ts") >= C.ts_floor_lit(e + one)).select(F.lit(1)).limit(1)
    spine = calendar(days.sparkSession, s - one, e).select("date")
    seen = days.withColumnRenamed("date", "day")
    whole = Window.partitionBy(F.lit(0))
    laid = (spine.join(seen, spine["date"] == seen["day"], "left")
            .withColumn("first", F.min("day").over(whole)).withColumn("last", F.max("day").over(whole)))
    kept = laid.where((F.col("date") >= F.lit(s)) & (earlier.exists() | (F.col("date") >= F.col("first")))
                      & (later.exists() | (F.col("date") <= F.date_add("last", 1))))
    return kept.select("date", *_filled())


def engagement_daily(dim_date: DataFrame, sessions: DataFrame, yt_daily: DataFrame) -> DataFrame:
    """Calendar spine ⟕ web sessions ⟕ video day, zeros for missing days.

    Each side is reduced to one row per date before the joins (several session rows on one
    date — CSV imports — are summed; video mean is weighted by views when a date has more
    than one row, and taken as is when it has one). The joins are then 1:1 on ``date``.
    """
    s = (sessions.groupBy("date")
                 .agg(F.sum("sessions").alias("sessions"), F.sum("pageviews").alias("pageviews")))
    y = (yt_daily.groupBy("date")
                 .agg(F.sum("views").alias("views"),
                      F.sum("estimatedMinutesWatched").alias("estimatedMinutesWatched"),
                      F.when(F.count(F.lit(1)) == 1, F.max("averageViewDuration"))
                       .otherwise(F.sum(F.col("averageViewDuration") * F.col("views"))
                                  / F.nullif(F.sum("views").cast("double"), F.lit(0.0)))
                       .alias("averageViewDuration")))
    spine = dim_date.select("date")
    j = spine.join(s, "date", "left").join(y, "date", "left")
    return j.select(
        "date",
        F.coalesce("sessions", F.lit(0)).cast("bigint").alias("sessions"),
        F.coalesce("pageviews", F.lit(0)).cast("bigint").alias("pageviews"),
        F.coalesce("views", F.lit(0)).cast("bigint").alias("views"),
        F.coalesce("estimatedMinutesWatched", F.lit(0)).cast("bigint").alias("estimatedMinutesWatched"),
        F.coalesce("averageViewDuration", F.lit(0.0)).cast("double").alias("averageViewDuration"),
    )


def comms_impact_daily(utm_daily: DataFrame, utm_map: DataFrame) -> DataFrame:
    """Sessions and users per date × campaign through the UTM map (normalised 3-part key).

    A UTM key mapped twice to one campaign counts twice (no dedup; D4 reports duplicate map
    keys). The map side is joined plainly: AQE broadcasts it after measuring it.
    """
    g = utm_daily.select("date", "sessions", "users",
                         C.norm_key("source").alias("_s"), C.norm_key("medium").alias("_m"),
                         C.norm_key("campaign").alias("_c"))
    m = (utm_map.where(F.col("campaignId").isNotNull())
                .select(F.col("utm_source_norm").alias("_s"), F.col("utm_medium_norm").alias("_m"),
                        F.col("utm_campaign_norm").alias("_c"), "campaignId"))
    return (g.join(m, ["_s", "_m", "_c"], "inner")
             .groupBy("date", "campaignId")
             .agg(F.sum("sessions").cast("bigint").alias("sessions"),
                  F.sum("users").cast("bigint").alias("users")))


def send_totals(sends: DataFrame) -> DataFrame:
    """Per campaign: sends, opens and clicks over all its sends."""
    return sends.groupBy("campaignId").agg(*[F.sum(c).cast("bigint").alias(c) for c in ("sends", "opens", "clicks")])


def comms_impact_summary(daily: DataFrame, sends: DataFrame, faithful_fanout: bool = False,
                         send_dates: tuple[_dt.date, _dt.date] | None = None) -> DataFrame:
    """Per campaign × send date: sessions on D-1, D0, D0..D+2, uplift, campaign totals.

    The band D-1..D+2 is an interval join. Each send is expanded to its four band days and
    joined on the equi-key (campaignId, date): a hash/merge join with no range condition, so
    a campaign with many days or sends spreads over tasks instead of comparing all pairs.

    ``faithful_fanout=True`` keeps the double counting of a campaign sent more than once
    (each daily row repeated once per send row in D0..D+2); the default counts it once.
    ``send_dates`` (first, last) leaves out the other send dates, and the days outside their bands; the
    campaign totals still cover all sends.
    """
    pairs = sends.select("campaignId", F.col("date").cast("date").alias("send_date"))
    if send_dates is not None:
        first, last = send_dates
        pairs = pairs.where(F.col("send_date").between(F.lit(first), F.lit(last)))
        daily = daily.where(F.col("date").between(F.lit(first - _dt.timedelta(days=1)), F.lit(last + _dt.timedelta(days=2))))
    if not faithful_fanout:
        pairs = pairs.distinct()
    band = pairs.select("campaignId", "send_date",
                        F.explode(F.sequence(F.date_sub("send_date", 1), F.date_add("send_date", 2)))
                         .alias("date"))
    d = daily.select("campaignId", "date", "sessions")
    if faithful_fanout:
        mult = sends.groupBy("campaignId").agg(F.count(F.lit(1)).alias("_n"))
        d = d.join(mult, "campaignId").select("campaignId", "date",
                                              F.col("sessions"), F.col("_n"))
    else:
        d = d.withColumn("_n", F.lit(1))
    hits = band.join(d, ["campaignId", "date"], "left")
    sd = F.col("send_date")
    pvt = (hits.groupBy("campaignId", "send_date")
               .agg(F.max(F.when(F.col("date") == F.date_sub(sd, 1), F.col("sessions"))).alias("d_1"),
                    F.max(F.when(F.col("date") == sd, F.col("sessions"))).alias("d0"),
                    F.sum(F.when(F.col("date").between(sd, F.date_add(sd, 2)),
                                 F.col("sessions") * F.col("_n"))).alias("d0_d2")))
    totals = send_totals(sends)
    d_1 = F.coalesce("d_1", F.lit(0))
    d0 = F.coalesce("d0", F.lit(0))
    return (pvt.join(totals, "campaignId", "left")
               .select("campaignId", "send_date",
                       d_1.cast("bigint").alias("ses_d_1"),
                       d0.cast("bigint").alias("ses_d0"),
                       F.coalesce("d0_d2", F.lit(0)).cast("bigint").alias("ses_d0_d2"),
                       (d0 - d_1).cast("bigint").alias("uplift_abs"),
                       F.when(d_1 > 0, (d0 - d_1).cast("double") * F.lit(100.0) / d_1.cast("double"))
                        .otherwise(F.lit(0.0)).alias("uplift_pct"),
                       "sends", "opens", "clicks"))
