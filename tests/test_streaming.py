"""Manifest-driven refresh stream: late corrections replace their window, restarts resume."""

import datetime as dt

from tidemark.sources import landed as L
from tidemark.streaming.refresh import post_manifest, start_refresh_stream

D = dt.date
SCHEMA = "date date, screenPageViews bigint, sessions bigint, totalUsers bigint"


def _table(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).select("date", "pageviews", "sessions", "users").collect())


def test_refresh_stream_applies_windows_in_order_and_resumes(spark, tmpdir_spark):
    manifests, wh, ckpt = f"{tmpdir_spark}/manifests", f"{tmpdir_spark}/wh", f"{tmpdir_spark}/ckpt"
    first = spark.createDataFrame([(D(2024, 1, d), d, d, d) for d in range(1, 11)], SCHEMA)
    L.land_report(first, f"{tmpdir_spark}/r1", ["date"], ["totalUsers", "sessions", "screenPageViews"])
    post_manifest(spark, manifests, "report", "fact_sessions", f"{tmpdir_spark}/r1", "2024-01-01", "2024-01-10")
    q = start_refresh_stream(spark, manifests, wh, ckpt)
    q.awaitTermination(120)
    assert len(_table(spark, f"{wh}/fact_sessions")) == 10

    # A re-pull of the last 5 days: two days corrected, one day gone.
    second = spark.createDataFrame([(D(2024, 1, 6), 60, 60, 60), (D(2024, 1, 7), 70, 70, 70),
                                    (D(2024, 1, 9), 9, 9, 9), (D(2024, 1, 10), 10, 10, 10)], SCHEMA)
    L.land_report(second, f"{tmpdir_spark}/r2", ["date"], ["totalUsers", "sessions", "screenPageViews"])
    post_manifest(spark, manifests, "report", "fact_sessions", f"{tmpdir_spark}/r2", "2024-01-06", "2024-01-10")
    q = start_refresh_stream(spark, manifests, wh, ckpt)
    q.awaitTermination(120)
    got = _table(spark, f"{wh}/fact_sessions")
    assert (D(2024, 1, 8), 8, 8, 8) not in got
    assert (D(2024, 1, 6), 60, 60, 60) in got and (D(2024, 1, 1), 1, 1, 1) in got
    assert len(got) == 9


def test_refresh_stream_also_refreshes_marts(spark, tmpdir_spark):
    from pyspark.sql import functions as F

    from tidemark.plans import marts as M
    from tidemark.plans.build import materialize
    from tidemark.sources.warehouse import StoredWarehouse
    root, manifests = f"{tmpdir_spark}/wh_m", f"{tmpdir_spark}/manifests_m"
    stored = materialize(spark, "/root/testdata/sf0.001", root)
    repull = (stored.fact("fact_sessions", "2024-01-05", "2024-01-06")
              .select("date", (F.col("pageviews") * 3).alias("screenPageViews"), "sessions",
                      F.col("users").alias("totalUsers")))
    L.land_report(repull, f"{tmpdir_spark}/r3", ["date"], ["totalUsers", "sessions", "screenPageViews"])
    post_manifest(spark, manifests, "report", "fact_sessions", f"{tmpdir_spark}/r3", "2024-01-05", "2024-01-06")
    start_refresh_stream(spark, manifests, root, f"{tmpdir_spark}/ckpt_m", refresh_marts=True).awaitTermination(180)
    w = StoredWarehouse(spark, root)
    full = M.engagement_daily(w.table("dim_date"), w.table("fact_sessions"), w.table("fact_yt_channel_daily"))
    assert sorted(map(tuple, w.table("fact_engagement_daily").collect())) == sorted(map(tuple, full.collect()))


def test_refresh_stream_video_manifests(spark, tmpdir_spark):
    from pyspark.sql import functions as F

    from tidemark.sources.warehouse import DerivedWarehouse
    src = DerivedWarehouse(spark, "/root/testdata/sf0.001")
    wh, manifests = f"{tmpdir_spark}/wh_v", f"{tmpdir_spark}/manifests_v"
    day = src.fact("fact_yt_channel_daily", "2024-01-08", "2024-01-14").withColumnRenamed("date", "day")
    L.land_video_report(day, f"{tmpdir_spark}/v_day", ("day", "views", "estimatedMinutesWatched", "averageViewDuration"))
    vids = (src.table("fact_yt_video_period").where(F.col("startDate") == F.lit(D(2024, 1, 8)))
            .withColumnRenamed("videoId", "video"))
    L.land_video_report(vids, f"{tmpdir_spark}/v_vid", ("video", "views", "estimatedMinutesWatched",
                                                        "averageViewDuration"))
    post_manifest(spark, manifests, "yt_channel", "fact_yt_channel_daily", f"{tmpdir_spark}/v_day",
                  "2024-01-08", "2024-01-14")
    post_manifest(spark, manifests, "yt_videos", "fact_yt_video_period", f"{tmpdir_spark}/v_vid",
                  "2024-01-08", "2024-01-14")
    start_refresh_stream(spark, manifests, wh, f"{tmpdir_spark}/ckpt_v").awaitTermination(180)
    ch = spark.read.parquet(f"{wh}/fact_yt_channel_daily")
    assert ch.count() == day.count()
    vp = spark.read.parquet(f"{wh}/fact_yt_video_period")
    assert vp.count() == min(50, vids.count())
    assert {tuple(r) for r in vp.select("startDate", "endDate").distinct().collect()} == {(D(2024, 1, 8), D(2024, 1, 14))}


def test_refresh_stream_crm_manifests(spark, tmpdir_spark):
    import json
    import os
    base = str(tmpdir_spark)
    local = base[5:] if base.startswith("file:") else base
    for folder, records in (("camp/campaigns", [{"id": "C1", "sent_at": "2024-01-05"}]), ("camp/metrics", [{"campaign_id": "C1", "sends": 5}]),
                            ("contacts", [{"id": "1", "updated_at": "2024-01-03", "status": "lead"}])):
        os.makedirs(f"{local}/{folder}")
        with open(f"{local}/{folder}/a.json", "w") as f:
            f.write(json.dumps(records) + "\n")
    post_manifest(spark, f"{base}/m", "rd_campaigns", "fact_rd_email_campaign", f"{base}/camp", "2024-01-01", "2024-01-10")
    post_manifest(spark, f"{base}/m", "rd_leads", "fact_rd_lead_stage_daily", f"{base}/contacts", "2024-01-01", "2024-01-10")
    start_refresh_stream(spark, f"{base}/m", f"{base}/wh", f"{base}/ckpt").awaitTermination(120)
    sent = spark.read.parquet(f"{base}/wh/fact_rd_email_campaign").select("date", "campaignId", "sends").collect()
    assert [tuple(r) for r in sent] == [(D(2024, 1, 5), "C1", 5)]
    stages = spark.read.parquet(f"{base}/wh/fact_rd_lead_stage_daily").select("date", "stage", "count").collect()
    assert [tuple(r) for r in stages] == [(D(2024, 1, 10), "lead", 1)]
