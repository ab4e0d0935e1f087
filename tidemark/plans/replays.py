"""End-to-end ingestion runs over the driver tables.

Each replay lands warehouse facts (derived from the driver tables) in the shape a pull or an
export has — analytics report pages, video reports, CRM record pages, localised CSV exports —
under a fresh folder of the shared checkpoint location, runs the refresh/import mart on it
into a fresh warehouse folder, and returns the resulting table. Flattening and refreshing
must give the facts back, so the oracle is the fact's own SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators import tables as K
from tidemark.plans import ingest as I
from tidemark.session import scratch_dir
from tidemark.sources import exports as X
from tidemark.sources import landed as L
from tidemark.sources.warehouse import DerivedWarehouse, StoredWarehouse

VANISHED_DAY = "2023-12-30"       # no event is as old
DAY_PAST_CALENDAR = "2024-02-15"  # no calendar day is as new
AS_OF = "2024-01-31"  # "today" of the replays: the day after the last event
IMPORT_DATE = "2024-01-28"


def _dirs(spark: SparkSession, purpose: str) -> tuple[str, str]:
    base = scratch_dir(spark, purpose)
    return f"{base}/landed", f"{base}/warehouse"


def replay_report(spark: SparkSession, sf_dir: str, table: str, days: int = 30) -> DataFrame:
    """M1–M4: land the fact as an analytics report (request names, text values, yyyyMMdd
    dates) plus the junk rows below, refresh the last ``days`` days of an empty table, read
    the table back."""
    spec = I.REPORTS[table]
    landed, root = _land_fact(spark, sf_dir, table)
    start, end = I.refresh_window(AS_OF, days)
    I.refresh_report(spark, landed, f"{root}/{table}", spec, start, end)
    return StoredWarehouse(spark, root).table(table).select(*spec.columns)


def _land_fact(spark: SparkSession, sf_dir: str, table: str) -> tuple[str, str]:
    """Land a fact as an analytics report with the junk rows; the report's folder and a fresh warehouse."""
    spec = I.REPORTS[table]
    ren = dict(spec.rename)
    fact = DerivedWarehouse(spark, sf_dir).table(table).select(
        *[(F.date_format(ren.get(c, c), "yyyyMMdd") if c == "date" else F.col(ren.get(c, c)).cast("string")).alias(c)
          for c in spec.dimensions + spec.metrics])
    landed, root = _dirs(spark, f"report-{table}")
    L.land_report(fact.unionByName(_junk_rows(spark, spec)), landed, spec.dimensions, spec.metrics)
    return landed, root


def replay_report_rejects(spark: SparkSession, sf_dir: str, table: str, start, end) -> DataFrame:
    """What a refresh of [start, end] from the whole landed fact leaves out, by reason."""
    landed, _ = _land_fact(spark, sf_dir, table)
    return I.report_rejects(spark, landed, I.REPORTS[table], start, end)


def replay_report_corrected(spark: SparkSession, sf_dir: str, table: str, start, end) -> DataFrame:
    """K2 over a filled table: it holds the whole fact with wrong numbers, and a day of the window that the
    pull doesn't have. The window is refreshed twice, then an empty pull is tried: inside the window
    the table is the fact, outside it keeps what it had."""
    spec = I.REPORTS[table]
    landed, root = _land_fact(spark, sf_dir, table)
    metrics = [c for c in spec.columns if c not in {dict(spec.rename).get(d, d) for d in spec.dimensions}]
    stale = DerivedWarehouse(spark, sf_dir).table(table).select(
        *[(F.col(c) + 1 if c in metrics else F.col(c)).alias(c) for c in spec.columns])
    gone = stale.where(F.col("date") == C.date_lit(start)).withColumn("date", C.date_lit(VANISHED_DAY))
    K.write_partitioned(stale.unionByName(gone), f"{root}/{table}", ["date"])
    pulled = I.report_batch(spark, landed, spec)
    lo, hi = min(C.as_date(start), C.as_date(VANISHED_DAY)), C.as_date(end)
    for _ in range(2):
        K.replace_window(spark, pulled, f"{root}/{table}", lo, hi)
    K.replace_window(spark, pulled.limit(0), f"{root}/{table}", lo, hi)
    return StoredWarehouse(spark, root).table(table).select(*spec.columns)


def replay_yt_videos_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 over a filled table: stale rows of every period (and videos that the pull doesn't have) are
    replaced period by period, twice."""
    fact = DerivedWarehouse(spark, sf_dir).table("fact_yt_video_period")
    _, root = _dirs(spark, "yt-videos-corrected")
    path = f"{root}/fact_yt_video_period"
    stale = fact.withColumn("views", F.col("views") + 1)
    K.write_partitioned(stale.unionByName(stale.withColumn("videoId", F.concat(F.lit("old-"), "videoId"))), path,
                        ["startDate", "endDate"])
    for _ in range(2):
        K.replace_period(fact, path)
    return StoredWarehouse(spark, root).table("fact_yt_video_period")


def replay_pages_csv_twice(spark: SparkSession, sf_dir: str, buckets: int | None = None) -> DataFrame:
    """U3 over a filled dimension: every page is there under an old title, and one that no export has;
    the export is imported twice. With ``buckets`` the dimension is kept in so many: the first import lays
    them out, the second merges into them."""
    w = DerivedWarehouse(spark, sf_dir)
    landed, root = _dirs(spark, "csv-pages-twice")
    export = _page_export(w)
    X.write_csv(export, landed)
    path = "Caminho da página e classe da tela"
    old = export.where(F.col(path).isNotNull()).select(F.col(path).alias("page_path"), F.lit("old title").alias("page_title"))
    kept = old.limit(1).select(F.lit("/p/kept").alias("page_path"), F.lit("kept").alias("page_title"))
    K.rebuild(old.unionByName(kept), f"{root}/dim_page")
    for _ in range(2):
        I.import_pages_csv(spark, [landed], root, IMPORT_DATE, buckets)
    return StoredWarehouse(spark, root).table("dim_page")


def replay_marts_window(spark: SparkSession, sf_dir: str, start, end) -> DataFrame:
    """Marts after a re-pull that maps no UTM session any more and brings a day past the calendar: the
    window's engagement and campaign rows, and the calendar's last day."""
    from tidemark.plans.build import materialize, refresh_marts_window
    _, root = _dirs(spark, "marts-window")
    w = materialize(spark, sf_dir, root)
    utm = w.fact("fact_ga4_sessions_by_utm_daily", start, end).withColumn("campaign", F.lit("unmapped"))
    K.replace_window(spark, utm.checkpoint(), f"{root}/fact_ga4_sessions_by_utm_daily", start, end)
    sessions = w.fact("fact_sessions", start, start).withColumn("date", C.date_lit(DAY_PAST_CALENDAR)).checkpoint()
    K.replace_window(spark, sessions, f"{root}/fact_sessions", DAY_PAST_CALENDAR, DAY_PAST_CALENDAR)
    refresh_marts_window(spark, root, start, DAY_PAST_CALENDAR)
    w = StoredWarehouse(spark, root)
    part = lambda df, name: df.select(F.lit(name).alias("part"), "date", F.col("sessions").cast("bigint").alias("sessions"))
    calendar = w.table("dim_date").agg(F.max("date").alias("date")).withColumn("sessions", F.lit(None))
    return (part(w.fact("fact_engagement_daily", start, DAY_PAST_CALENDAR), "engagement")
            .unionByName(part(w.table("fact_comms_impact_daily"), "campaigns")).unionByName(part(calendar, "calendar")))


def replay_comms_window(spark: SparkSession, sf_dir: str, start, end) -> DataFrame:
    """M8 merged by window: a warehouse holds the campaign marts of all days; then the window's UTM sessions are pulled again with
    other numbers, its sends too, and the campaigns sent on its first day are gone. The send summary after the
    window's refresh must be the one of a rebuild."""
    from tidemark.plans.build import build_comms, refresh_comms_window
    src = DerivedWarehouse(spark, sf_dir)
    _, root = _dirs(spark, "comms-window")
    utm, sends = "fact_ga4_sessions_by_utm_daily", "fact_rd_email_campaign"
    for t in (utm, sends):
        K.rebuild(src.table(t), f"{root}/{t}", ["date"])
    K.rebuild(src.table("map_utm_campaign"), f"{root}/map_utm_campaign")
    build_comms(spark, root)
    w = StoredWarehouse(spark, root)
    pulled = w.fact(utm, start, end).withColumn("sessions", F.col("sessions") * 2)
    K.replace_window(spark, pulled, f"{root}/{utm}", start, end)
    sent = w.fact(sends, start, end).where(F.col("date") > C.date_lit(start)).withColumn("sends", F.col("sends") + 1)
    K.replace_window(spark, sent, f"{root}/{sends}", start, end)
    refresh_comms_window(spark, root, start, end)
    return StoredWarehouse(spark, root).table("fact_comms_impact_summary")


def replay_quarantine(spark: SparkSession, sf_dir: str, table: str, start, end) -> DataFrame:
    """What becomes of every landed row when [start, end] is refreshed twice from one landing: rows per part ('landed', 'accepted',
    or the reason of a row in the quarantine) and day as landed. The landed rows are the accepted and the rejected ones."""
    spec = I.REPORTS[table]
    landed, root = _land_fact(spark, sf_dir, table)
    for _ in range(2):
        I.refresh_report(spark, landed, f"{root}/{table}", spec, start, end, root)
    w = StoredWarehouse(spark, root)
    count = lambda df, part, day: df.groupBy(part.alias("part"), day.alias("day")).agg(F.count(F.lit(1)).alias("rows"))
    raw = L.read_report_text(spark, landed, spec.dimensions, spec.metrics)
    held = w.table("quarantine").where(~F.col("kept"))
    return (count(raw, F.lit("landed"), F.col("date"))
            .unionByName(count(w.table(table), F.lit("accepted"), F.date_format("date", "yyyyMMdd")))
            .unionByName(count(held, F.col("reason"), F.get_json_object("record", "$.date"))))


UNKNOWN_TO_THE_SOURCE = ("sessionMedium", "totalUsers")  # names that the replayed metadata lack


def replay_metadata(spark: SparkSession, sf_dir: str, query: str) -> DataFrame:
    """M10 and D5 against landed metadata: the response names what the pulls ask for, but for two names, and a
    custom dimension per event type of the events."""
    from tidemark.plans import quality as QA
    w = DerivedWarehouse(spark, sf_dir)
    landed, _ = _dirs(spark, "metadata")
    asked = spark.createDataFrame([r for r in QA.report_requests() if r[2] not in UNKNOWN_TO_THE_SOURCE],
                                  "dataset string, type string, name string").select("type", "name").distinct()
    custom = w.driver("events").where("event_type is not null").select(
        F.lit("dimension").alias("type"), F.concat(F.lit("customEvent:"), "event_type").alias("name")).distinct()
    L.land_metadata(asked.unionByName(custom).withColumn("description", F.lit("as landed")), landed)
    metadata = L.read_metadata(spark, f"{landed}/*")
    if query == "invalid_fields":
        return QA.invalid_fields(w, QA.report_requests(), metadata)
    return QA.datasets_catalog(w, ("fact_sessions",), metadata)


def replay_pages_fallback(spark: SparkSession, sf_dir: str, start, end) -> DataFrame:
    """P10: a warehouse whose page fact was created but never filled."""
    from tidemark.plans import queries as Q
    _, root = _dirs(spark, "pages-fallback")
    K.rebuild(DerivedWarehouse(spark, sf_dir).table("fact_sessions"), f"{root}/fact_sessions", ["date"])
    K.ensure_table(spark, f"{root}/fact_ga4_pages_daily", "fact_ga4_pages_daily")
    return Q.top_pages(StoredWarehouse(spark, root), start, end, 10)


def replay_report_cache(spark: SparkSession, sf_dir: str, start, end) -> DataFrame:
    """K1: a report is cached under its request; the same request with an empty answer finds the first one, unless it is forced:
    that one is asked for other dates."""
    report = DerivedWarehouse(spark, sf_dir).fact("fact_sessions", start, end).select(*I.SESSIONS.columns)
    _, root = _dirs(spark, "report-cache")
    names = (list(I.SESSIONS.dimensions), list(I.SESSIONS.metrics))
    first = K.cache_report(report, root, *names, start, end)
    again = K.cache_report(report.limit(0), root, *names, start, end)
    other = K.cache_report(report, root, *names, start, start)
    K.cache_report(report.limit(0), root, *names, start, start, force=True)
    read = lambda part, path: spark.read.parquet(path).select(F.lit(part).alias("part"), "*")
    return read("first", first).unionByName(read("again", again)).unionByName(read("forced", other))


def replay_csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7, K8, K5: a fact exported as CSV, read back by its schema and appended to a table that was created before, twice."""
    from tidemark.schemas import TABLES
    t = "fact_sessions_by_country"
    landed, root = _dirs(spark, "csv-export")
    K.export_csv(DerivedWarehouse(spark, sf_dir).table(t).select(*TABLES[t].fieldNames()), landed)
    K.ensure_table(spark, f"{root}/{t}", t)
    K.append(spark.read.schema(TABLES[t]).option("header", True).csv(landed), f"{root}/{t}", ["date"])
    K.ensure_table(spark, f"{root}/{t}", t)
    return StoredWarehouse(spark, root).table(t)


# A registry as a user writes it: other datasets, keys and limits than the built-in one.
REGISTRY_YAML = """
- id: ga4_pages_daily
  source: GA4
  entity: pages
  dimensions: [date, pagePath]
  metrics: [screenPageViews]
  freshness_ttl_minutes: 4320
  quality_checks: {not_null: [pageTitle, date], unique: [pagePath]}
- id: sessions
  source: GA4
  entity: sessions
  dimensions: [date]
  metrics: [sessions]
  quality_checks: {not_null: [users], unique: [date]}
"""


def registry_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The not-null and unique checks that a YAML registry declares, as (check, dataset, target, violations, violated)."""
    from tidemark.plans import quality as QA
    from tidemark.schemas import load_registry
    w, registry = DerivedWarehouse(spark, sf_dir), load_registry(REGISTRY_YAML)
    nn = QA.check_not_null(w, registry).select(F.lit("not_null").alias("check"), "dataset", F.col("column_name").alias("target"),
                                               F.col("nulls").alias("violations"), "violated")
    un = QA.check_unique(w, registry).select(F.lit("unique").alias("check"), "dataset", F.col("key_columns").alias("target"),
                                             F.col("duplicate_rows").alias("violations"), "violated")
    return nn.unionByName(un)


def replay_profile(spark: SparkSession, sf_dir: str, start, end, query: str) -> DataFrame:
    """A stored warehouse whose profile was built while the window's days of three facts were still wrong (rows twice, a NULL key, no
    rows), then refreshed for these days: ``query`` ('quality_alerts' or 'datasets_catalog') answers from partition
    folders and the profile."""
    from tidemark.plans import profile as P
    from tidemark.plans import quality as QA
    from tidemark.plans.build import materialize
    _, root = _dirs(spark, "profile")
    w = materialize(spark, sf_dir, root)
    wrong = {"fact_ga4_events_daily": lambda df: df.unionByName(df),
             "fact_ga4_pages_daily": lambda df: df.withColumn("pagePath", F.lit(None).cast("string")),
             "fact_rd_email_campaign": lambda df: df.limit(0)}
    right = {t: w.fact(t, start, end).checkpoint() for t in wrong}
    for t, spoil in wrong.items():
        K.replace_window(spark, spoil(right[t]), w.path(t), start, end, empty_clears=True)
    P.build_profile(spark, root)
    for t, rows in right.items():
        K.replace_window(spark, rows, w.path(t), start, end)
        P.refresh_profile(spark, root, t, start, end)
    w = StoredWarehouse(spark, root)
    return QA.quality_alerts(w, IMPORT_DATE) if query == "quality_alerts" else QA.datasets_catalog(w)


# Rows every landed report carries on purpose — an impossible date, a date
# outside the refresh window, and a malformed date with a malformed number. None may reach
# the table.
JUNK_DATES = ("20240230", "20231215", "2024-01-0x")


def _junk_rows(spark: SparkSession, spec: I.ReportSpec) -> DataFrame:
    rows = []
    for i, d in enumerate(JUNK_DATES):
        dims = [d] + ["junk"] * (len(spec.dimensions) - 1)
        mets = ["n/a" if i == 2 else "1"] * len(spec.metrics)
        rows.append(tuple(dims + mets))
    cols = ", ".join(f"`{c}` string" for c in spec.dimensions + spec.metrics)
    return spark.createDataFrame(rows, cols)


def replay_yt_channel(spark: SparkSession, sf_dir: str, days: int = 30) -> DataFrame:
    w = DerivedWarehouse(spark, sf_dir)
    fact = w.table("fact_yt_channel_daily").withColumnRenamed("date", "day")
    landed, root = _dirs(spark, "yt-channel")
    L.land_video_report(fact, landed, ("day", "views", "estimatedMinutesWatched", "averageViewDuration"))
    start, end = I.refresh_window(AS_OF, days)
    I.refresh_yt_channel(spark, landed, f"{root}/fact_yt_channel_daily", start, end)
    return StoredWarehouse(spark, root).table("fact_yt_channel_daily")


def replay_yt_videos(spark: SparkSession, sf_dir: str, max_results: int = 50) -> DataFrame:
    """One video report per period folder; the top ``max_results`` per period are kept."""
    w = DerivedWarehouse(spark, sf_dir)
    fact = w.table("fact_yt_video_period").withColumnRenamed("videoId", "video")
    landed, root = _dirs(spark, "yt-videos")
    L.land_video_report(fact, landed, ("video", "views", "estimatedMinutesWatched", "averageViewDuration"),
                        group_cols=("startDate", "endDate"))
    I.refresh_yt_videos(spark, landed, f"{root}/fact_yt_video_period", max_results)
    return StoredWarehouse(spark, root).table("fact_yt_video_period")


def replay_email_campaigns(spark: SparkSession, sf_dir: str, days: int = 30) -> DataFrame:
    """Campaign records with their id and send time under rotating alternative keys
    (bare lists and wrapped pages), metrics per campaign id under alternative keys."""
    w = DerivedWarehouse(spark, sf_dir)
    sends = w.table("fact_rd_email_campaign")
    h = F.pmod(F.xxhash64("campaignId", "date"), F.lit(3))
    ts = F.concat(F.date_format("date", "yyyy-MM-dd"), F.lit("T09:30:00Z"))
    rec = sends.select(
        F.when(h == 0, F.col("campaignId")).alias("id"),
        F.when(h == 1, F.col("campaignId")).alias("campaignId"),
        F.when(h == 2, F.col("campaignId")).alias("uuid"),
        F.when(h == 0, ts).alias("send_datetime"),
        F.when(h == 1, ts).alias("sent_at"),
        F.when(h == 2, F.date_format("date", "yyyy-MM-dd")).alias("created_at"))
    per_campaign = sends.groupBy("campaignId").agg(F.sum("sends").alias("s"), F.sum("opens").alias("o"),
                                                   F.sum("clicks").alias("c"))
    g = F.pmod(F.xxhash64("campaignId"), F.lit(2))
    metrics = per_campaign.select(
        F.col("campaignId").alias("campaign_id"),
        F.when(g == 0, F.col("s")).alias("sends"), F.when(g == 1, F.col("s")).alias("delivered"),
        F.when(g == 0, F.col("o")).alias("opens"), F.when(g == 1, F.col("o")).alias("unique_opens"),
        F.when(g == 0, F.col("c")).alias("clicks"), F.when(g == 1, F.col("c")).alias("unique_clicks"))
    landed, root = _dirs(spark, "rd-campaigns")
    L.land_records(rec.where(h != 1), f"{landed}/campaigns/bare")
    L.land_records(rec.where(h == 1), f"{landed}/campaigns/wrapped", wrapper="items")
    L.land_records(metrics, f"{landed}/metrics")
    start, end = I.refresh_window(AS_OF, days)
    I.refresh_email_campaigns(spark, f"{landed}/campaigns/*", f"{landed}/metrics", f"{root}/fact_rd_email_campaign",
                              start, end)
    return StoredWarehouse(spark, root).table("fact_rd_email_campaign")


def contacts_from_customers(customer: DataFrame) -> DataFrame:
    """CRM contacts from the customer table: stage under a rotating key (or missing/empty),
    updated on 2024-01-01 + (key mod 40) days."""
    k = F.col("c_custkey")
    upd = F.date_add(F.lit(C.as_date("2024-01-01")), (k % 40).cast("int"))
    return customer.select(
        k.cast("string").alias("id"),
        F.concat(F.date_format(upd, "yyyy-MM-dd"), F.lit("T12:00:00Z")).alias("updated_at"),
        F.when(k % 4 == 0, F.col("c_mktsegment")).alias("lifecycle_stage"),
        F.when(k % 4 == 1, F.lower("c_mktsegment")).alias("funnel_stage"),
        F.when(k % 4 == 2, F.lit("")).alias("status"))


def replay_lead_stage(spark: SparkSession, sf_dir: str, days: int = 30) -> DataFrame:
    """Contacts landed as bare pages and as ``{"contacts": [...]}`` pages."""
    w = DerivedWarehouse(spark, sf_dir)
    contacts = contacts_from_customers(w.driver("customer"))
    landed, root = _dirs(spark, "rd-contacts")
    half = F.pmod(F.xxhash64("id"), F.lit(2))
    L.land_records(contacts.where(half == 0), f"{landed}/bare")
    L.land_records(contacts.where(half == 1), f"{landed}/wrapped", wrapper="contacts")
    start, end = I.refresh_window(AS_OF, days)
    I.refresh_lead_stage(spark, f"{landed}/*", f"{root}/fact_rd_lead_stage_daily", start, end)
    return StoredWarehouse(spark, root).table("fact_rd_lead_stage_daily")


def replay_utm_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mapping as a header CSV (whitespace kept, columns in another order and one more), imported with a
    full replace."""
    w = DerivedWarehouse(spark, sf_dir)
    m = w.table("map_utm_campaign").select("campaignId", F.lit("x").alias("note"), *reversed(X.UTM_MAP_COLUMNS[:3]), "campaign_name")
    landed, root = _dirs(spark, "utm-map")
    X.write_csv(m, landed)
    I.import_utm_map(spark, landed, f"{root}/map_utm_campaign")
    return StoredWarehouse(spark, root).table("map_utm_campaign")


def _page_export(w: DerivedWarehouse) -> DataFrame:
    p = w.table("fact_ga4_pages_daily")
    per = (p.groupBy("pagePath")
            .agg(F.max("pageTitle").alias("t"), F.sum("screenPageViews").alias("pv"),
                 F.sum("totalUsers").alias("u"), F.sum("sessions").alias("s")))
    rows = per.select(F.col("t").alias("Título da página"), F.col("pagePath").alias("Caminho da página e classe da tela"),
                      F.col("pv").cast("string").alias("Visualizações"), F.col("u").cast("string").alias("Usuários ativos"),
                      F.round(F.col("s") / F.col("u"), 3).cast("string").alias("Tempo médio de engajamento por sessão"))
    total = per.agg(F.sum("pv").alias("pv"), F.sum("u").alias("u")).select(
        F.lit("Total geral").alias("Título da página"), F.lit(None).cast("string").alias("Caminho da página e classe da tela"),
        F.col("pv").cast("string").alias("Visualizações"), F.col("u").cast("string").alias("Usuários ativos"),
        F.lit(None).cast("string").alias("Tempo médio de engajamento por sessão"))
    return rows.unionByName(total)


def replay_pages_csv(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """M14 (pages): export of all page totals (with a 'Total geral' footer and untitled pages),
    imported into dim_page (upsert) and fact_sessions (append)."""
    w = DerivedWarehouse(spark, sf_dir)
    landed, root = _dirs(spark, "csv-pages")
    X.write_csv(_page_export(w), landed)
    I.import_pages_csv(spark, [landed], root, IMPORT_DATE)
    return StoredWarehouse(spark, root).table(table)


def replay_videos_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M14 (videos): one export per event (starts = views, progress = minutes, over all periods),
    imported into dim_video and fact_events."""
    w = DerivedWarehouse(spark, sf_dir)
    per = (w.table("fact_yt_video_period").groupBy(F.col("videoId").alias("Título do vídeo"))
            .agg(F.sum("views").alias("views"), F.sum("estimatedMinutesWatched").alias("estimatedMinutesWatched")))
    landed, root = _dirs(spark, "csv-videos")
    X.write_csv(per.select("Título do vídeo", F.col("views").cast("string").alias("Contagem de eventos")),
                f"{landed}/video_start")
    X.write_csv(per.select("Título do vídeo", F.col("estimatedMinutesWatched").cast("string")
                           .alias("Contagem de eventos")), f"{landed}/video_progress")
    I.import_videos_csv(spark, {"video_start": [f"{landed}/video_start"],
                                "video_progress": [f"{landed}/video_progress"]}, root, IMPORT_DATE)
    return StoredWarehouse(spark, root).table("fact_events")


def replay_countries_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M14 (countries): users per country, Latin-1 encoded export."""
    w = DerivedWarehouse(spark, sf_dir)
    per = (w.table("fact_sessions_by_country").groupBy("country_id").agg(F.sum("users").alias("u"))
            .select(F.col("country_id").alias("ID do país"), F.col("u").cast("string").alias("Usuários ativos")))
    landed, root = _dirs(spark, "csv-countries")
    X.write_csv(per, landed, encoding="latin-1")
    I.import_countries_csv(spark, [landed], root, IMPORT_DATE)
    return StoredWarehouse(spark, root).table("fact_sessions_by_country")


def replay_countries_csv_stacked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M14 over two exports at once (S9): a UTF-16 file with a byte-order mark and a Latin-1 file with its
    columns in another order and one more."""
    w = DerivedWarehouse(spark, sf_dir)
    per = (w.table("fact_sessions_by_country").groupBy("country_id").agg(F.sum("users").alias("u"))
            .select(F.col("country_id").alias("ID do país"), F.col("u").cast("string").alias("Usuários ativos")))
    landed, root = _dirs(spark, "csv-countries-stacked")
    early = F.col("ID do país") < "J"
    X.write_csv(per.where(early), f"{landed}/a", encoding="utf-16")
    X.write_csv(per.where(~early).select("Usuários ativos", F.lit("x").alias("Nota"), "ID do país"), f"{landed}/b", encoding="latin-1")
    I.import_countries_csv(spark, [f"{landed}/a", f"{landed}/b", f"{landed}/missing"], root, IMPORT_DATE)
    return StoredWarehouse(spark, root).table("fact_sessions_by_country")


def replay_countries_csv_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One export in parts, a folder with UTF-8, Latin-1 and marked UTF-16 files; every country's name gets an accent."""
    w = DerivedWarehouse(spark, sf_dir)
    per = (w.table("fact_sessions_by_country").groupBy("country_id").agg(F.sum("users").alias("u"))
            .select(F.concat("country_id", F.lit(" é")).alias("ID do país"), F.col("u").cast("string").alias("Usuários ativos")))
    landed, root = _dirs(spark, "csv-countries-mixed")
    third = F.pmod(F.ascii("ID do país"), F.lit(3))
    for n, encoding in enumerate(X.ENCODINGS):
        (per.where(third == n).coalesce(1).write.mode("append").option("header", True)
            .option("encoding", X.charset(encoding)).csv(landed))
    I.import_countries_csv(spark, [landed], root, IMPORT_DATE)
    return StoredWarehouse(spark, root).table("fact_sessions_by_country")
