"""The command line runs the warehouse jobs end to end on a stored warehouse."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.__main__ import main
from tidemark.plans import ingest as I
from tidemark.sources import landed as L
from tidemark.sources.warehouse import DerivedWarehouse

SF = "/root/testdata/sf0.001"


def test_cli_init_refresh_materialize_query(spark, tmpdir_spark):
    root = f"{tmpdir_spark}/wh"
    main(["init", "--root", root, "--start", "2024-01-01", "--as-of", "2024-01-31"], spark)
    assert spark.read.parquet(f"{root}/dim_date").count() == 31

    src = DerivedWarehouse(spark, SF)
    for table in ("fact_sessions", "fact_ga4_pages_daily", "fact_ga4_events_daily"):
        spec = I.REPORTS[table]
        ren = dict(spec.rename)
        fact = src.table(table).select(*[F.col(ren.get(c, c)).alias(c) for c in spec.dimensions + spec.metrics])
        L.land_report(fact, f"{tmpdir_spark}/landed/{table}", spec.dimensions, spec.metrics)
    main(["refresh-report", "--table", "fact_sessions", "--report", f"{tmpdir_spark}/landed/fact_sessions",
          "--root", root, "--days", "30", "--as-of", "2024-01-31"], spark)
    main(["refresh-analytics", "--pages", f"{tmpdir_spark}/landed/fact_ga4_pages_daily",
          "--events", f"{tmpdir_spark}/landed/fact_ga4_events_daily", "--root", root, "--as-of", "2024-01-31"],
         spark)
    yt = src.table("fact_yt_channel_daily").withColumnRenamed("date", "day")
    L.land_video_report(yt, f"{tmpdir_spark}/landed/yt", ("day", "views", "estimatedMinutesWatched",
                                                          "averageViewDuration"))
    main(["refresh-yt-channel", "--report", f"{tmpdir_spark}/landed/yt", "--root", root, "--as-of", "2024-01-31"],
         spark)
    main(["materialize-engagement", "--root", root], spark)

    got = main(["query", "kpis", "--root", root, "--start", "2024-01-08", "--end", "2024-01-28"], spark).first()
    want = src.fact("fact_sessions", "2024-01-08", "2024-01-28").agg(F.sum("users"), F.sum("sessions")).first()
    assert (got.users, got.sessions) == (float(want[0]), float(want[1]))
    eng = main(["query", "engagement_kpis", "--root", root, "--start", "2024-01-08", "--end", "2024-01-28"], spark)
    assert eng.first().sessions == got.sessions
    pareto = main(["query", "pages_pareto", "--root", root, "--start", "2024-01-08", "--end", "2024-01-28",
                   "--limit", "5"], spark).collect()
    assert len(pareto) == 5 and pareto[-1].cum_share <= 1.0
    main(["catalog", "--root", root, "--out", f"{tmpdir_spark}/catalog_csv"], spark)
    cat = spark.read.option("header", True).csv(f"{tmpdir_spark}/catalog_csv")
    assert cat.where((F.col("dataset") == "fact_sessions") & (F.col("name") == "pageviews:BIGINT")).count() == 1
    assert main(["query", "partial_day", "--root", root, "--end", "2024-01-28", "--as-of", "2024-01-28"],
                spark).first().latest_date == dt.date(2024, 1, 30)


def test_cli_materialize_all_then_query(spark, tmpdir_spark):
    root = f"{tmpdir_spark}/wh_all"
    main(["materialize-all", "--sf-dir", SF, "--root", root], spark)
    got = main(["query", "comms_summary", "--root", root, "--limit", "3"], spark).collect()
    assert len(got) == 3 and got[0].send_date >= got[-1].send_date


def test_cli_refresh_yt_combined(spark, tmpdir_spark):
    root = f"{tmpdir_spark}/wh_yt"
    src = DerivedWarehouse(spark, SF)
    day = src.table("fact_yt_channel_daily").withColumnRenamed("date", "day")
    L.land_video_report(day, f"{tmpdir_spark}/yt_day", ("day", "views", "estimatedMinutesWatched",
                                                        "averageViewDuration"))
    vids = (src.table("fact_yt_video_period").where(F.col("startDate") == F.lit(dt.date(2024, 1, 8)))
            .withColumnRenamed("videoId", "video"))
    L.land_video_report(vids, f"{tmpdir_spark}/yt_vid", ("video", "views", "estimatedMinutesWatched",
                                                         "averageViewDuration"))
    main(["refresh-yt", "--channel-report", f"{tmpdir_spark}/yt_day", "--videos-report", f"{tmpdir_spark}/yt_vid",
          "--root", root, "--days", "7", "--as-of", "2024-01-14", "--max-results", "5"], spark)
    ch = spark.read.parquet(f"{root}/fact_yt_channel_daily")
    assert ch.agg(F.min("date"), F.max("date")).first() == (dt.date(2024, 1, 7), dt.date(2024, 1, 14))
    vp = spark.read.parquet(f"{root}/fact_yt_video_period")
    assert vp.count() == 5 and {tuple(r) for r in vp.select("startDate", "endDate").distinct().collect()} == \
        {(dt.date(2024, 1, 7), dt.date(2024, 1, 14))}


def test_cli_imports_and_crm_refresh(spark, tmpdir_spark):
    import json
    import os
    root = f"{tmpdir_spark}/wh_imp"
    local = lambda p: p[5:] if p.startswith("file:") else p
    main(["import-utm-map", "--root", root], spark)  # no file: empty map
    assert spark.read.parquet(f"{root}/map_utm_campaign").count() == 0
    m = local(f"{tmpdir_spark}/map.csv")
    with open(m, "w", encoding="utf-8") as f:
        f.write("utm_source,utm_medium,utm_campaign,campaignId,campaign_name\n Email ,EMAIL,Camp-1,C1,One\n")
    main(["import-utm-map", "--path", m, "--root", root], spark)
    row = spark.read.parquet(f"{root}/map_utm_campaign").first()
    assert (row.utm_source_norm, row.utm_medium_norm, row.utm_campaign_norm) == ("email", "email", "camp-1")
    c = local(f"{tmpdir_spark}/contacts")
    os.makedirs(c, exist_ok=True)
    with open(f"{c}/p.json", "w") as f:
        f.write(json.dumps({"items": [{"id": "1", "updated_at": "2024-01-20", "status": "lead"},
                                      {"id": "2", "updated_at": "2024-01-21"}]}) + "\n")
    main(["refresh-rd-leads", "--contacts", c, "--root", root, "--as-of", "2024-01-31"], spark)
    main(["refresh-rd-leads", "--contacts", c, "--root", root, "--as-of", "2024-01-31"], spark)  # re-run: no double
    leads = {(r.stage, r["count"]) for r in spark.read.parquet(f"{root}/fact_rd_lead_stage_daily").collect()}
    assert leads == {("lead", 1), ("unknown", 1)}
    k = local(f"{tmpdir_spark}/countries.csv")
    with open(k, "w", encoding="utf-8") as f:
        f.write("ID do país,Usuários ativos\nBrasil,7\nChile,x\n")
    main(["import-csv-countries", "--paths", k, "--root", root, "--as-of", "2024-01-28"], spark)
    got = {(r.country_id, r.users) for r in spark.read.parquet(f"{root}/fact_sessions_by_country").collect()}
    assert got == {("Brasil", 7), ("Chile", None)}
    assert {r.country_id for r in spark.read.parquet(f"{root}/dim_country").collect()} == {"Brasil", "Chile"}


def test_cli_remaining_subcommands(spark, tmpdir_spark):
    import json
    import os
    local = lambda p: p[5:] if p.startswith("file:") else p
    root = f"{tmpdir_spark}/wh_rest"
    main(["materialize-all", "--sf-dir", SF, "--root", root], spark)
    camp, met = local(f"{tmpdir_spark}/camp"), local(f"{tmpdir_spark}/met")
    os.makedirs(camp, exist_ok=True)
    os.makedirs(met, exist_ok=True)
    with open(f"{camp}/a.json", "w") as f:
        f.write(json.dumps([{"id": "C9", "sent_at": "2024-01-25T10:00:00Z"}]) + "\n")
    with open(f"{met}/a.json", "w") as f:
        f.write(json.dumps({"campaign_id": "C9", "sends": 5, "opens": 2, "clicks": 1}) + "\n")
    main(["refresh-rd-campaigns", "--campaigns", camp, "--metrics", met, "--root", root, "--as-of", "2024-01-31"],
         spark)
    rd = spark.read.parquet(f"{root}/fact_rd_email_campaign")
    assert [(r.campaignId, r.sends) for r in rd.collect()] == [("C9", 5)]  # the window was replaced
    main(["materialize-comms-impact", "--root", root], spark)
    assert {r.campaignId for r in spark.read.parquet(f"{root}/fact_comms_impact_summary").collect()} == {"C9"}
    pages = local(f"{tmpdir_spark}/pages.csv")
    with open(pages, "w", encoding="utf-8") as f:
        f.write("Título da página,Caminho da página e classe da tela,Visualizações,Usuários ativos\n"
                "Home,/,10,3\nTotal,,10,3\n")
    main(["import-csv-pages", "--paths", pages, "--root", root, "--as-of", "2024-02-01"], spark)
    assert [tuple(r) for r in spark.read.parquet(f"{root}/dim_page").collect()] == [("/", "Home")]
    vs = local(f"{tmpdir_spark}/vs.csv")
    with open(vs, "w", encoding="utf-8") as f:
        f.write("Título do vídeo,Contagem de eventos\nAula 1,12\n")
    main(["import-csv-videos", "--start-paths", vs, "--root", root, "--as-of", "2024-02-01"], spark)
    ev = spark.read.parquet(f"{root}/fact_events").collect()
    assert [(r.event_name, r.event_count, r.video_title) for r in ev] == [("video_start", 12, "Aula 1")]
