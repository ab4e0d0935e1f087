"""Registered queries: name → (Spark builder over ``sf_dir``, DuckDB oracle SQL or None).

Every builder reads the driver tables through ``DerivedWarehouse``; the oracle recomputes the
same answer in one DuckDB statement. Parameters are the fixture window of the oracle runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import compare as CMP
from tidemark.plans import oracle as O
from tidemark.plans import queries as Q
from tidemark.sources.warehouse import DerivedWarehouse

START, END, ANCHOR = O.START, O.END, O.ANCHOR

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}
# The same queries as functions of any Warehouse (derived or stored).
WAREHOUSE_QUERIES: dict[str, Callable] = {}


def register(name: str, oracle: str | None):
    def deco(fn: Callable[[DerivedWarehouse], DataFrame]):
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(DerivedWarehouse(spark, sf_dir))
        build.__name__ = name
        build.__doc__ = fn.__doc__
        REGISTRY[name] = (build, oracle)
        WAREHOUSE_QUERIES[name] = fn
        return fn
    return deco


def _fact_sql(name: str) -> str:
    cols = {
        "fact_sessions": "date, pageviews, sessions, users",
    }.get(name, "*")
    return O.with_facts((name,), f"SELECT {cols} FROM {name}")


# --- facts and marts (whole tables) -------------------------------------------------------

for _t in ("fact_sessions", "fact_ga4_events_daily", "fact_ga4_pages_daily", "fact_sessions_by_country",
           "fact_ga4_sessions_by_utm_daily", "map_utm_campaign", "fact_rd_email_campaign",
           "fact_yt_channel_daily", "fact_yt_video_period", "dim_date", "fact_engagement_daily",
           "fact_comms_impact_daily", "fact_comms_impact_summary"):
    register(_t, _fact_sql(_t))(lambda w, _t=_t: w.table(_t))


# Independent formulation: the repeated-send double counting is an explicit multiplicity —
# the band sum times the send rows of the (campaign, date) pair times the campaign's send rows.
_FANOUT_SQL = O.with_facts(("fact_comms_impact_daily", "fact_rd_email_campaign"), """
    SELECT p.campaignId, p.send_date,
           CAST(COALESCE(b.d_1, 0) AS BIGINT) AS ses_d_1, CAST(COALESCE(b.d0, 0) AS BIGINT) AS ses_d0,
           CAST(COALESCE(b.d02 * p.n_pair * t.n_rows, 0) AS BIGINT) AS ses_d0_d2,
           CAST(COALESCE(b.d0, 0) - COALESCE(b.d_1, 0) AS BIGINT) AS uplift_abs,
           CASE WHEN COALESCE(b.d_1, 0) > 0
                THEN CAST(COALESCE(b.d0, 0) - COALESCE(b.d_1, 0) AS DOUBLE) * 100.0 / CAST(b.d_1 AS DOUBLE)
                ELSE 0.0 END AS uplift_pct,
           t.sends, t.opens, t.clicks
    FROM pairs p
    JOIN tot t ON t.campaignId = p.campaignId
    LEFT JOIN band b ON b.campaignId = p.campaignId AND b.send_date = p.send_date""",
    extra=(("pairs", """SELECT campaignId, CAST(date AS DATE) AS send_date, COUNT(*) AS n_pair
                        FROM fact_rd_email_campaign GROUP BY 1, 2"""),
           ("tot", """SELECT campaignId, COUNT(*) AS n_rows, CAST(SUM(sends) AS BIGINT) AS sends,
                             CAST(SUM(opens) AS BIGINT) AS opens, CAST(SUM(clicks) AS BIGINT) AS clicks
                      FROM fact_rd_email_campaign GROUP BY 1"""),
           ("band", """SELECT p.campaignId, p.send_date,
                              MAX(r.sessions) FILTER (WHERE r.date = p.send_date - 1) AS d_1,
                              MAX(r.sessions) FILTER (WHERE r.date = p.send_date) AS d0,
                              SUM(r.sessions) FILTER (WHERE r.date >= p.send_date AND r.date <= p.send_date + 2) AS d02
                       FROM pairs p JOIN fact_comms_impact_daily r
                         ON r.campaignId = p.campaignId AND r.date >= p.send_date - 1 AND r.date <= p.send_date + 2
                       GROUP BY 1, 2""")))


@register("fact_comms_impact_summary_fanout", _FANOUT_SQL)
def _summary_fanout(w):
    """The campaign summary with the fan-out of a campaign sent more than once kept
    (D0..D+2 sessions counted once per send row of the campaign)."""
    from tidemark.plans import marts as M
    return M.comms_impact_summary(w.table("fact_comms_impact_daily"), w.table("fact_rd_email_campaign"),
                                  faithful_fanout=True)


# --- served queries -------------------------------------------------------------------------

BT = O.between()


@register("kpis", O.with_facts(("fact_sessions",), f"""
    SELECT CAST(COALESCE(SUM(users), 0) AS DOUBLE) AS users,
           CAST(COALESCE(SUM(sessions), 0) AS DOUBLE) AS sessions,
           CAST(COALESCE(SUM(pageviews), 0) AS DOUBLE) AS pageviews
    FROM fact_sessions WHERE {BT}"""))
def _kpis(w):
    return Q.kpis(w, START, END)


@register("top_pages", O.with_facts(("fact_ga4_pages_daily", "fact_sessions"), f"""
    SELECT * FROM (
      SELECT pagePath AS page_path, COALESCE(MAX(pageTitle), pagePath) AS page_title,
             CAST(COALESCE(SUM(screenPageViews), 0) AS BIGINT) AS pageviews
      FROM fact_ga4_pages_daily WHERE {BT}
      GROUP BY pagePath ORDER BY pageviews DESC NULLS LAST, page_path LIMIT 10) t
    UNION ALL
    SELECT 'NA', 'Total', pv
    FROM (SELECT CAST(COALESCE(SUM(pageviews), 0) AS BIGINT) AS pv FROM fact_sessions WHERE {BT}) f
    WHERE NOT EXISTS (SELECT 1 FROM fact_ga4_pages_daily WHERE {BT})"""))
def _top_pages(w):
    return Q.top_pages(w, START, END, 10)


@register("pages_weekly", O.with_facts(("fact_sessions",), """
    SELECT * FROM (
      SELECT strftime(date, '%Y-%W') AS year_week, CAST(COALESCE(SUM(pageviews), 0) AS BIGINT) AS pageviews
      FROM fact_sessions GROUP BY 1 ORDER BY 1 DESC LIMIT 8) t
    ORDER BY year_week"""))
def _pages_weekly(w):
    return Q.pages_weekly(w, 8)


@register("video_funnel", O.with_facts(("fact_ga4_events_daily",), f"""
    SELECT start, progress,
           CASE WHEN start > 0 THEN round(CAST(progress AS DOUBLE) / CAST(start AS DOUBLE) * 100.0, 2)
                ELSE 0.0 END AS completion_rate
    FROM (SELECT CAST(COALESCE(SUM(CASE WHEN eventName = 'video_start' THEN eventCount END), 0) AS BIGINT) AS start,
                 CAST(COALESCE(SUM(CASE WHEN eventName = 'video_progress' THEN eventCount END), 0) AS BIGINT) AS progress
          FROM fact_ga4_events_daily
          WHERE {BT} AND eventName IN ('video_start', 'video_progress')) t"""))
def _video_funnel(w):
    return Q.video_funnel(w, START, END)


@register("top_countries", O.with_facts(("fact_sessions_by_country",), f"""
    SELECT country_id, CAST(COALESCE(SUM(users), 0) AS BIGINT) AS users
    FROM fact_sessions_by_country WHERE {BT}
    GROUP BY 1 ORDER BY users DESC NULLS LAST, country_id LIMIT 10"""))
def _top_countries(w):
    return Q.top_countries(w, START, END, 10)


@register("top_weekdays", O.with_facts(("fact_sessions",), f"""
    SELECT strftime(date, '%w') AS weekday, CAST(COALESCE(SUM(users), 0) AS BIGINT) AS users
    FROM fact_sessions WHERE {BT} GROUP BY 1 ORDER BY users DESC, weekday"""))
def _top_weekdays(w):
    return Q.top_weekdays(w, START, END)


@register("yt_channel_daily", O.with_facts(("fact_yt_channel_daily",), f"""
    SELECT date, CAST(COALESCE(views, 0) AS BIGINT) AS views,
           CAST(COALESCE(estimatedMinutesWatched, 0) AS BIGINT) AS estimatedMinutesWatched,
           CAST(COALESCE(averageViewDuration, 0.0) AS DOUBLE) AS averageViewDuration
    FROM fact_yt_channel_daily WHERE {BT} ORDER BY date"""))
def _yt_channel_daily(w):
    return Q.yt_channel_daily(w, START, END)


_EDGES = f"startDate = {O.d(START)} OR endDate = {O.d(END)}"


@register("yt_top_videos", O.with_facts(("fact_yt_video_period",), f"""
    SELECT videoId, CAST(COALESCE(SUM(views), 0) AS BIGINT) AS views,
           CAST(COALESCE(SUM(estimatedMinutesWatched), 0) AS BIGINT) AS estimatedMinutesWatched,
           COALESCE(round(AVG(averageViewDuration), 6), 0.0) AS averageViewDuration
    FROM fact_yt_video_period WHERE {_EDGES}
    GROUP BY 1 ORDER BY views DESC NULLS LAST, videoId LIMIT 20"""))
def _yt_top_videos(w):
    return Q.yt_top_videos(w, START, END, 20)


@register("engagement_kpis", O.with_facts(("fact_engagement_daily",), f"""
    SELECT CAST(COALESCE(SUM(sessions), 0) AS DOUBLE) AS sessions,
           CAST(COALESCE(SUM(pageviews), 0) AS DOUBLE) AS pageviews,
           CAST(COALESCE(SUM(views), 0) AS DOUBLE) AS views,
           CAST(COALESCE(SUM(estimatedMinutesWatched), 0) AS DOUBLE) AS minutes
    FROM fact_engagement_daily WHERE {BT}"""))
def _engagement_kpis(w):
    return Q.engagement_kpis(w, START, END)


@register("engagement_series", O.with_facts(("fact_engagement_daily",), f"""
    SELECT date, CAST(COALESCE(sessions, 0) AS BIGINT) AS sessions,
           CAST(COALESCE(estimatedMinutesWatched, 0) AS BIGINT) AS minutes
    FROM fact_engagement_daily WHERE {BT} ORDER BY date"""))
def _engagement_series(w):
    return Q.engagement_series(w, START, END)


@register("yt_retention", O.with_facts(("fact_yt_video_period",), f"""
    SELECT videoId, minutes, views,
           CASE WHEN views > 0 THEN CAST(minutes AS DOUBLE) / CAST(views AS DOUBLE) ELSE 0.0 END AS min_per_view
    FROM (SELECT videoId, CAST(COALESCE(SUM(estimatedMinutesWatched), 0) AS BIGINT) AS minutes,
                 CAST(COALESCE(SUM(views), 0) AS BIGINT) AS views
          FROM fact_yt_video_period WHERE {_EDGES} GROUP BY 1) t
    ORDER BY minutes DESC NULLS LAST, videoId LIMIT 20"""))
def _yt_retention(w):
    return Q.yt_retention(w, START, END, 20)


@register("utm_aggregate", O.with_facts(("fact_ga4_sessions_by_utm_daily",), f"""
    SELECT COALESCE(source, '(na)') AS source, COALESCE(medium, '(na)') AS medium,
           COALESCE(campaign, '(na)') AS campaign,
           CAST(COALESCE(SUM(sessions), 0) AS BIGINT) AS sessions, CAST(COALESCE(SUM(users), 0) AS BIGINT) AS users
    FROM fact_ga4_sessions_by_utm_daily WHERE {BT}
    GROUP BY 1, 2, 3 ORDER BY sessions DESC NULLS LAST, source, medium, campaign LIMIT 20"""))
def _utm_aggregate(w):
    return Q.utm_aggregate(w, START, END, 20)


@register("comms_by_campaign", O.with_facts(("fact_comms_impact_daily",), f"""
    SELECT campaignId, CAST(COALESCE(SUM(sessions), 0) AS BIGINT) AS sessions,
           CAST(COALESCE(SUM(users), 0) AS BIGINT) AS users
    FROM fact_comms_impact_daily WHERE {BT}
    GROUP BY 1 ORDER BY sessions DESC NULLS LAST, campaignId LIMIT 20"""))
def _comms_by_campaign(w):
    return Q.comms_by_campaign(w, START, END, 20)


def _pareto_sql(limit: int | None) -> str:
    """Definition: a page's running total is the sum over every page ranked at or before it
    (more views, or as many views and a path not after it)."""
    lim = f"LIMIT {limit}" if limit is not None else ""
    return O.with_facts(("fact_ga4_pages_daily",), f"""
    SELECT a.title AS page_title, a.pv AS pageviews,
           CAST(SUM(a.pv) OVER (ORDER BY a.pv DESC, a.path ROWS UNBOUNDED PRECEDING) AS DOUBLE)
             / NULLIF(CAST((SELECT SUM(pv) FROM agg) AS DOUBLE), 0) AS cum_share
    FROM agg a
    ORDER BY a.pv DESC, a.path {lim}""", extra=(("agg", f"""
        SELECT pagePath AS path, COALESCE(MAX(pageTitle), pagePath) AS title,
               CAST(COALESCE(SUM(screenPageViews), 0) AS BIGINT) AS pv
        FROM fact_ga4_pages_daily WHERE {BT} GROUP BY pagePath"""),))


@register("pages_pareto", _pareto_sql(50))
def _pages_pareto(w):
    return Q.pages_pareto(w, START, END, 50)


@register("pages_pareto_all", _pareto_sql(None))
def _pages_pareto_all(w):
    return Q.pages_pareto(w, START, END, None)


@register("pages_pareto_all_ranges", _pareto_sql(None))
def _pages_pareto_all_ranges(w):
    """The unbounded Pareto in many ranges, as it runs on a page set of any size."""
    return Q.pages_pareto(w, START, END, None, rows_per_range=7)


@register("rd_kpis", O.with_facts(("fact_rd_email_campaign",), f"""
    SELECT CAST(s AS DOUBLE) AS sends, CAST(o AS DOUBLE) AS opens, CAST(c AS DOUBLE) AS clicks,
           CASE WHEN s <> 0 THEN round(CAST(c AS DOUBLE) * 100.0 / CAST(s AS DOUBLE), 2) ELSE 0.0 END AS ctr_pct
    FROM (SELECT COALESCE(SUM(sends), 0) AS s, COALESCE(SUM(opens), 0) AS o, COALESCE(SUM(clicks), 0) AS c
          FROM fact_rd_email_campaign WHERE {BT}) t"""))
def _rd_kpis(w):
    return Q.rd_kpis(w, START, END)


@register("comms_summary", O.with_facts(("fact_comms_impact_summary",), """
    SELECT campaignId, send_date, COALESCE(ses_d_1, 0) AS ses_d_1, COALESCE(ses_d0, 0) AS ses_d0,
           COALESCE(ses_d0_d2, 0) AS ses_d0_d2, COALESCE(uplift_abs, 0) AS uplift_abs,
           COALESCE(uplift_pct, 0.0) AS uplift_pct, COALESCE(sends, 0) AS sends,
           COALESCE(opens, 0) AS opens, COALESCE(clicks, 0) AS clicks
    FROM fact_comms_impact_summary ORDER BY send_date DESC NULLS LAST, campaignId LIMIT 10"""))
def _comms_summary(w):
    return Q.comms_summary(w, 10)


_ENG = {"sessions": "sessions", "minutes": "estimatedMinutesWatched"}


@register("wow", O.compare_sql(_ENG, *CMP.wow_windows(ANCHOR)))
def _wow(w):
    return Q.wow(w, ANCHOR)


@register("mtd_vs_prev", O.compare_sql(_ENG, *CMP.mtd_windows(ANCHOR)))
def _mtd(w):
    return Q.mtd_vs_prev(w, ANCHOR)


@register("seven_vs_28", O.compare_sql(_ENG, *CMP.seven_vs_28_windows(ANCHOR), scale=0.25, ref_name="reference"))
def _seven_vs_28(w):
    return Q.seven_vs_28(w, ANCHOR)


# --- health, quality, catalog, report ------------------------------------------------------

from tidemark.plans import quality as QA  # noqa: E402
from tidemark.schemas import REGISTRY as DATASETS, TABLE_SOURCE, TABLES  # noqa: E402

_FRESH_TTL = {d.table: d.freshness_ttl_minutes for d in DATASETS}


def _health_sql() -> str:
    rows = []
    for t in Q.HEALTH_COUNTS:
        if t == "fact_events":
            rows.append(f"SELECT 'rows_{t}' AS metric, '0' AS value")
        else:
            rows.append(f"SELECT 'rows_{t}' AS metric, CAST(COUNT(*) AS VARCHAR) AS value FROM {t}")
    uses = ["fact_sessions", "fact_sessions_by_country"]
    for metric, t in Q.HEALTH_LATEST:
        if t == "fact_yt_video_daily":
            rows.append(f"SELECT '{metric}', 'None'")
        else:
            uses.append(t)
            rows.append(f"SELECT '{metric}', COALESCE(CAST(MAX(date) AS VARCHAR), 'None') FROM {t}")
    return O.with_facts(tuple(uses), "\nUNION ALL\n".join(rows))


@register("health", _health_sql())
def _health(w):
    return Q.health(w)


def _freshness_body(as_of=ANCHOR, end=END) -> tuple[tuple[str, ...], str]:
    parts, uses = [], []
    for label, t in QA.FRESHNESS_SIGNALS:
        uses.append(t)
        ttl = _FRESH_TTL.get(t, QA.DEFAULT_TTL_MINUTES)
        parts.append(f"SELECT '{label}' AS name, '{t}' AS table_name, MAX(date) AS latest_date, "
                     f"CAST({ttl} AS BIGINT) AS ttl_minutes FROM {t}")
    lag = f"CAST(date_diff('day', latest_date, {O.d(as_of)}) AS BIGINT)"
    body = (f"SELECT name, table_name, latest_date, {lag} AS lag_days, ttl_minutes, "
            f"(latest_date IS NULL OR {lag} * 1440 > ttl_minutes) AS stale, "
            f"{'TRUE' if str(end) == str(as_of) else 'FALSE'} AS partial_day FROM ("
            + " UNION ALL ".join(parts) + ") f")
    return tuple(uses), body


_VOL_SERIES = """
    SELECT x.date, CAST(x.sessions AS BIGINT) AS sessions, CAST(x.minutes AS BIGINT) AS minutes,
           CASE WHEN COALESCE(p.sessions, 0) = 0 THEN 0.0
                ELSE CAST(x.sessions - p.sessions AS DOUBLE) * 100.0 / CAST(p.sessions AS DOUBLE) END AS ses_dod_pct,
           CASE WHEN COALESCE(p.minutes, 0) = 0 THEN 0.0
                ELSE CAST(x.minutes - p.minutes AS DOUBLE) * 100.0 / CAST(p.minutes AS DOUBLE) END AS min_dod_pct
    FROM per_day x
    LEFT JOIN per_day p ON p.date = (SELECT MAX(q.date) FROM per_day q WHERE q.date < x.date)"""
_PER_DAY = """
    SELECT date, SUM(COALESCE(sessions, 0)) AS sessions, SUM(COALESCE(estimatedMinutesWatched, 0)) AS minutes
    FROM fact_engagement_daily GROUP BY date"""
_VOL_LATEST = "SELECT date, ses_dod_pct, min_dod_pct FROM vs ORDER BY date DESC NULLS LAST LIMIT 1"


@register("freshness", O.with_facts(_freshness_body()[0], _freshness_body()[1]))
def _freshness(w):
    return QA.freshness(w, ANCHOR, END)


@register("volumetry_series", O.with_facts(("fact_engagement_daily",), _VOL_SERIES, extra=(("per_day", _PER_DAY),)))
def _vol_series(w):
    return QA.volumetry_series(w)


@register("volumetry_dod", O.with_facts(("fact_engagement_daily",), _VOL_LATEST, extra=(("per_day", _PER_DAY), ("vs", _VOL_SERIES))))
def _vol_dod(w):
    return QA.volumetry_dod(w)


@register("volumetry_drops", O.with_facts(("fact_engagement_daily",), f"""
    SELECT date, ses_dod_pct, min_dod_pct FROM vs
    WHERE ses_dod_pct < {QA.DROP_ALERT_PCT} OR min_dod_pct < {QA.DROP_ALERT_PCT}""", extra=(("per_day", _PER_DAY), ("vs", _VOL_SERIES))))
def _vol_drops(w):
    return QA.volumetry_drops(w)


@register("quality_signals", O.with_facts(
    _freshness_body()[0] + ("fact_engagement_daily",), """
    SELECT 'freshness' AS signal, name, latest_date AS date, CAST(NULL AS DOUBLE) AS value FROM fr
    UNION ALL SELECT 'volumetry', 'ses_dod_pct', date, ses_dod_pct FROM vl
    UNION ALL SELECT 'volumetry', 'min_dod_pct', date, min_dod_pct FROM vl""",
    extra=(("fr", _freshness_body()[1]), ("per_day", _PER_DAY), ("vs", _VOL_SERIES), ("vl", _VOL_LATEST))))
def _quality_signals(w):
    return QA.quality_signals(w, ANCHOR)


def _not_null_body() -> tuple[tuple[str, ...], str]:
    parts, uses = [], []
    for d in DATASETS:
        for c in d.not_null:
            uses.append(d.table)
            parts.append(f"SELECT '{d.id}' AS dataset, '{c}' AS column_name, "
                         f"CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS nulls, "
                         f"CAST(COUNT(*) AS BIGINT) AS \"rows\", COUNT(*) FILTER (WHERE {c} IS NULL) > 0 AS violated "
                         f"FROM {d.table}")
    return tuple(dict.fromkeys(uses)), "\nUNION ALL\n".join(parts)


def _unique_body() -> tuple[tuple[str, ...], str]:
    parts, uses = [], []
    for d in DATASETS:
        if not d.unique:
            continue
        uses.append(d.table)
        keys = ", ".join(d.unique)
        parts.append(f"SELECT '{d.id}' AS dataset, '{','.join(d.unique)}' AS key_columns, "
                     f"CAST(COUNT(*) AS BIGINT) AS duplicate_keys, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS duplicate_rows, "
                     f"COUNT(*) > 0 AS violated FROM (SELECT {keys}, COUNT(*) AS n FROM {d.table} "
                     f"GROUP BY {keys} HAVING COUNT(*) > 1) t")
    return tuple(uses), "\nUNION ALL\n".join(parts)


@register("check_not_null", O.with_facts(*_not_null_body()))
def _check_not_null(w):
    return QA.check_not_null(w)


@register("check_unique", O.with_facts(*_unique_body()))
def _check_unique(w):
    return QA.check_unique(w)


_SQL_TYPE = {"LongType()": "BIGINT", "DoubleType()": "DOUBLE", "StringType()": "VARCHAR", "DateType()": "DATE",
             "IntegerType()": "INTEGER"}


def _columns_of(table: str) -> list[tuple[str, str]]:
    cols = [(f.name, _SQL_TYPE[repr(f.dataType)]) for f in TABLES[table].fields]
    if table == "fact_sessions":  # the derived table has no CSV-only duration column
        cols = [c for c in cols if c[0] != "avg_session_duration"]
    return cols


def _catalog_sql(tables=QA.CATALOG_TABLES) -> tuple[tuple[str, ...], str]:
    parts, uses = [], []
    for t in tables:
        if t in ("fact_events", "fact_rd_lead_stage_daily"):  # not derived from the driver tables
            for f in TABLES[t].fields:
                parts.append(f"SELECT '{TABLE_SOURCE[t]}', '{t}', 'planned_field', '{f.name}', 'planned', "
                             f"CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)")
            continue
        uses.append(t)
        for c, ty in _columns_of(t):
            parts.append(f"SELECT '{TABLE_SOURCE.get(t, '')}' AS source, '{t}' AS dataset, 'column' AS type, "
                         f"'{c}:{ty}' AS name, '' AS description, CAST(COUNT(*) AS BIGINT) AS \"rows\", "
                         f"CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS nulls FROM {t}")
    return tuple(uses), "\nUNION ALL\n".join(parts)


@register("datasets_catalog", O.with_facts(*_catalog_sql()))
def _datasets_catalog(w):
    return QA.datasets_catalog(w)


def _invalid_fields_sql() -> str:
    reqs = QA.registry_requests()
    tables = sorted({r[0] for r in reqs})
    prof = []
    for t in tables:
        for c, _ in _columns_of(t):
            prof.append(f"SELECT '{t}' AS dataset, '{c}' AS field FROM {t} HAVING COUNT({c}) > 0")
    values = ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in reqs)
    body = (f"SELECT r.dataset, r.kind, r.field FROM (VALUES {values}) r(dataset, kind, field) "
            f"WHERE NOT EXISTS (SELECT 1 FROM prof p WHERE p.dataset = r.dataset AND p.field = r.field)")
    return O.with_facts(tuple(tables), body, extra=(("prof", " UNION ALL ".join(prof)),))


@register("invalid_fields", _invalid_fields_sql())
def _invalid_fields(w):
    return QA.invalid_fields(w, QA.registry_requests())


def _field_matrix_sql(end=ANCHOR, days=7) -> str:
    import datetime as _dt
    from tidemark.functions.columns import as_date
    e = as_date(end)
    s = e - _dt.timedelta(days=days)
    parts = []
    for dname in QA.MATRIX_DIMENSIONS:
        for m in QA.MATRIX_METRICS:
            parts.append(f"SELECT '{dname}' AS dimension, '{m}' AS metric, CAST(COUNT(*) AS BIGINT) AS \"rows\" "
                         f"FROM (SELECT DISTINCT CAST({dname} AS VARCHAR) FROM fact_ga4_pages_daily "
                         f"WHERE date BETWEEN {O.d(s)} AND {O.d(e)} AND {m} IS NOT NULL) t")
    return O.with_facts(("fact_ga4_pages_daily",), "\nUNION ALL\n".join(parts))


@register("field_matrix", _field_matrix_sql())
def _field_matrix(w):
    return QA.field_matrix(w, ANCHOR, 7)


@register("quality_alerts", O.with_facts(
    _freshness_body()[0] + ("fact_engagement_daily",) + _not_null_body()[0] + _unique_body()[0], f"""
    SELECT 'freshness' AS "check", name AS target, CAST(lag_days AS DOUBLE) AS value, stale AS breached FROM fr
    UNION ALL SELECT 'volumetry_dod', 'sessions', ses_dod_pct, ses_dod_pct < {QA.DROP_ALERT_PCT} FROM vl
    UNION ALL SELECT 'volumetry_dod', 'minutes', min_dod_pct, min_dod_pct < {QA.DROP_ALERT_PCT} FROM vl
    UNION ALL SELECT 'not_null', dataset || '.' || column_name, CAST(nulls AS DOUBLE), violated FROM nn
    UNION ALL SELECT 'unique', dataset || '.' || key_columns, CAST(duplicate_keys AS DOUBLE), violated FROM un""",
    extra=(("fr", _freshness_body()[1]), ("per_day", _PER_DAY), ("vs", _VOL_SERIES), ("vl", _VOL_LATEST),
           ("nn", _not_null_body()[1]), ("un", _unique_body()[1]))))
def _quality_alerts(w):
    return QA.quality_alerts(w, ANCHOR)


@register("partial_day", O.with_facts(("fact_sessions",), f"""
    SELECT {O.d(END)} AS end_date, {O.d(ANCHOR)} AS as_of, MAX(date) AS latest_date,
           {'TRUE' if END == ANCHOR else 'FALSE'} AS is_partial FROM fact_sessions"""))
def _partial_day(w):
    return QA.partial_day(w, END, ANCHOR)


def _report_sql(start, end, top_n: int, with_countries: bool) -> str:
    bt = O.between(start, end)
    uses = ["fact_sessions", "fact_ga4_pages_daily", "fact_ga4_events_daily"]
    k = (f"SELECT CAST(COALESCE(SUM(users), 0) AS DOUBLE) AS users, CAST(COALESCE(SUM(sessions), 0) AS DOUBLE) AS sessions, "
         f"CAST(COALESCE(SUM(pageviews), 0) AS DOUBLE) AS pageviews FROM fact_sessions WHERE {bt}")
    pg = (f"SELECT * FROM (SELECT pagePath AS page_path, COALESCE(MAX(pageTitle), pagePath) AS page_title, "
          f"CAST(COALESCE(SUM(screenPageViews), 0) AS BIGINT) AS pageviews FROM fact_ga4_pages_daily WHERE {bt} "
          f"GROUP BY pagePath ORDER BY pageviews DESC NULLS LAST, page_path LIMIT {top_n}) t "
          f"UNION ALL SELECT 'NA', 'Total', pv FROM (SELECT CAST(COALESCE(SUM(pageviews), 0) AS BIGINT) AS pv "
          f"FROM fact_sessions WHERE {bt}) f WHERE NOT EXISTS (SELECT 1 FROM fact_ga4_pages_daily WHERE {bt})")
    fn = (f"SELECT CAST(COALESCE(SUM(CASE WHEN eventName = 'video_start' THEN eventCount END), 0) AS BIGINT) AS start, "
          f"CAST(COALESCE(SUM(CASE WHEN eventName = 'video_progress' THEN eventCount END), 0) AS BIGINT) AS progress "
          f"FROM fact_ga4_events_daily WHERE {bt} AND eventName IN ('video_start', 'video_progress')")
    rows = [
        "SELECT 'kpis' AS section, 1 AS rank, 'users' AS label, users AS value FROM k",
        "SELECT 'kpis', 2, 'sessions', sessions FROM k",
        "SELECT 'kpis', 3, 'pageviews', pageviews FROM k",
        "SELECT 'top_pages', CAST(row_number() OVER (ORDER BY pageviews DESC NULLS LAST, page_path) AS INTEGER), "
        "COALESCE(page_title, page_path, '(sem título)'), CAST(pageviews AS DOUBLE) FROM pg",
        "SELECT 'funnel', 1, 'start', CAST(start AS DOUBLE) FROM fn",
        "SELECT 'funnel', 2, 'progress', CAST(progress AS DOUBLE) FROM fn",
        "SELECT 'funnel', 3, 'completion_rate', CASE WHEN start > 0 THEN "
        "round(CAST(progress AS DOUBLE) / CAST(start AS DOUBLE) * 100.0, 2) ELSE 0.0 END FROM fn",
    ]
    extra = [("k", k), ("pg", pg), ("fn", fn)]
    if with_countries:
        uses.append("fact_sessions_by_country")
        extra.append(("ct", f"SELECT country_id, CAST(COALESCE(SUM(users), 0) AS BIGINT) AS users "
                            f"FROM fact_sessions_by_country WHERE {bt} GROUP BY 1 "
                            f"ORDER BY users DESC NULLS LAST, country_id LIMIT {top_n}"))
        rows.append("SELECT 'top_countries', CAST(row_number() OVER (ORDER BY users DESC NULLS LAST, country_id) "
                    "AS INTEGER), COALESCE(country_id, 'NA'), CAST(users AS DOUBLE) FROM ct")
    body = ("SELECT section, CAST(rank AS INTEGER) AS rank, label, value, "
            "CASE WHEN label = 'completion_rate' THEN CAST(value AS VARCHAR) || '%' "
            "ELSE format('{:t.}', CAST(trunc(COALESCE(value, 0.0)) AS BIGINT)) END AS display FROM ("
            + "\nUNION ALL\n".join(rows) + ") r")
    return O.with_facts(tuple(uses), body, extra=tuple(extra))


@register("weekly_report", _report_sql(START, END, 10, True))
def _weekly_report(w):
    return Q.weekly_report(w, START, END, 10)


def _summary_window():
    import datetime as _dt
    from tidemark.functions.columns import as_date
    e = as_date(ANCHOR)
    return e - _dt.timedelta(days=7), e


@register("weekly_summary", _report_sql(*_summary_window(), 5, False))
def _weekly_summary(w):
    return Q.weekly_summary(w, ANCHOR)


# --- ingestion replays (landed files → refresh/import → table) ----------------------------

from tidemark.plans import replays as RP  # noqa: E402


def _register_plain(name: str, oracle: str | None, fn):
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(spark, sf_dir)
    build.__name__ = name
    build.__doc__ = fn.__doc__
    REGISTRY[name] = (build, oracle)


_RW = "date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'"  # refresh window: 30 days up to 2024-01-31

for _name, _table, _cols in (
        ("refresh_sessions", "fact_sessions", "date, pageviews, sessions, users"),
        ("refresh_sessions_by_utm", "fact_ga4_sessions_by_utm_daily", "*"),
        ("refresh_events", "fact_ga4_events_daily", "*"),
        ("refresh_pages", "fact_ga4_pages_daily", "*")):
    _register_plain(_name, O.with_facts((_table,), f"SELECT {_cols} FROM {_table} WHERE {_RW}"),
                    lambda spark, sf_dir, _t=_table: RP.replay_report(spark, sf_dir, _t))

_register_plain("refresh_yt_channel",
                O.with_facts(("fact_yt_channel_daily",), f"SELECT * FROM fact_yt_channel_daily WHERE {_RW}"),
                RP.replay_yt_channel)
_register_plain("refresh_yt_videos", O.with_facts(("fact_yt_video_period",), """
    SELECT videoId, views, estimatedMinutesWatched, averageViewDuration, startDate, endDate
    FROM fact_yt_video_period
    QUALIFY row_number() OVER (PARTITION BY startDate, endDate ORDER BY views DESC NULLS LAST, videoId) <= 50"""),
                RP.replay_yt_videos)
_register_plain("refresh_rd_email_campaign", O.with_facts(("fact_rd_email_campaign",), f"""
    SELECT date, campaignId,
           CAST(SUM(sends) OVER (PARTITION BY campaignId) AS BIGINT) AS sends,
           CAST(SUM(opens) OVER (PARTITION BY campaignId) AS BIGINT) AS opens,
           CAST(SUM(clicks) OVER (PARTITION BY campaignId) AS BIGINT) AS clicks
    FROM fact_rd_email_campaign WHERE {_RW}"""), RP.replay_email_campaigns)
_register_plain("refresh_rd_lead_stage", """
    SELECT DATE '2024-01-31' AS date, stage, COUNT(*) AS "count"
    FROM (SELECT CASE c_custkey % 4 WHEN 0 THEN COALESCE(NULLIF(c_mktsegment, ''), 'unknown')
                                    WHEN 1 THEN COALESCE(NULLIF(lower(c_mktsegment), ''), 'unknown')
                                    ELSE 'unknown' END AS stage,
                 DATE '2024-01-01' + CAST(c_custkey % 40 AS INTEGER) AS upd
          FROM customer) t
    WHERE upd BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'
    GROUP BY stage""", RP.replay_lead_stage)
_register_plain("import_map_utm_campaign", O.with_facts(("map_utm_campaign",), "SELECT * FROM map_utm_campaign"),
                RP.replay_utm_map)

_PAGE_EXPORT = """
    SELECT pagePath, MAX(pageTitle) AS t, SUM(screenPageViews) AS pv, SUM(totalUsers) AS u, SUM(sessions) AS s
    FROM fact_ga4_pages_daily GROUP BY pagePath"""
_register_plain("csv_pages_import", O.with_facts(("fact_ga4_pages_daily",), """
    SELECT pagePath AS page_path, t AS page_title FROM per
    WHERE t IS NOT NULL AND lower(trim(t)) NOT IN ('total geral', 'total')""", extra=(("per", _PAGE_EXPORT),)),
                lambda spark, sf_dir: RP.replay_pages_csv(spark, sf_dir, "dim_page"))
_register_plain("csv_pages_facts", O.with_facts(("fact_ga4_pages_daily",), """
    SELECT DATE '2024-01-28' AS date, CAST(pv AS BIGINT) AS pageviews, CAST(NULL AS BIGINT) AS sessions,
           CAST(u AS BIGINT) AS users, round(CAST(s AS DOUBLE) / CAST(u AS DOUBLE), 3) AS avg_session_duration
    FROM per WHERE t IS NOT NULL AND lower(trim(t)) NOT IN ('total geral', 'total')""",
    extra=(("per", _PAGE_EXPORT),)),
                lambda spark, sf_dir: RP.replay_pages_csv(spark, sf_dir, "fact_sessions"))
_register_plain("csv_videos_import", O.with_facts(("fact_yt_video_period",), """
    SELECT DATE '2024-01-28' AS date, 'video_start' AS event_name, CAST(SUM(views) AS BIGINT) AS event_count,
           videoId AS video_title
    FROM fact_yt_video_period GROUP BY videoId
    UNION ALL
    SELECT DATE '2024-01-28', 'video_progress', CAST(SUM(estimatedMinutesWatched) AS BIGINT), videoId
    FROM fact_yt_video_period GROUP BY videoId"""), RP.replay_videos_csv)
_register_plain("csv_countries_import", O.with_facts(("fact_sessions_by_country",), """
    SELECT DATE '2024-01-28' AS date, country_id, CAST(SUM(users) AS BIGINT) AS users
    FROM fact_sessions_by_country GROUP BY country_id"""), RP.replay_countries_csv)


_register_plain("csv_countries_import_stacked", REGISTRY["csv_countries_import"][1], RP.replay_countries_csv_stacked)
_register_plain("refresh_sessions_rejects", O.with_facts(("fact_sessions",), f"""
    SELECT 'bad_date' AS reason, CAST(2 AS BIGINT) AS "rows"
    UNION ALL SELECT 'out_of_window', 1 + COUNT(*) FILTER (WHERE NOT ({BT})) FROM fact_sessions
    UNION ALL SELECT 'bad_number', 3"""),
                lambda spark, sf_dir: RP.replay_report_rejects(spark, sf_dir, "fact_sessions", START, END))

# up to the refreshed window's end the fact, behind it the stale rows
for _name, _table, _dims, _metrics in (
        ("refresh_sessions_corrected", "fact_sessions", ("date",), ("pageviews", "sessions", "users")),
        ("refresh_pages_corrected", "fact_ga4_pages_daily", ("date", "pagePath", "pageTitle"),
         ("screenPageViews", "sessions", "totalUsers"))):
    _stale = ", ".join([*_dims, *(f"{m} + CASE WHEN date <= {O.d(END)} THEN 0 ELSE 1 END AS {m}" for m in _metrics)])
    _register_plain(_name, O.with_facts((_table,), f"SELECT {_stale} FROM {_table}"),
                    lambda spark, sf_dir, _t=_table: RP.replay_report_corrected(spark, sf_dir, _t, START, END))
_register_plain("refresh_yt_videos_corrected", O.with_facts(("fact_yt_video_period",), """
    SELECT videoId, views, estimatedMinutesWatched, averageViewDuration, startDate, endDate FROM fact_yt_video_period"""),
                RP.replay_yt_videos_corrected)
_register_plain("csv_pages_import_twice", O.with_facts(("fact_ga4_pages_daily",), """
    SELECT pagePath AS page_path, CASE WHEN t IS NOT NULL AND lower(trim(t)) NOT IN ('total geral', 'total')
                                       THEN t ELSE 'old title' END AS page_title FROM per WHERE pagePath IS NOT NULL
    UNION ALL SELECT '/p/kept', 'kept'""", extra=(("per", _PAGE_EXPORT),)), RP.replay_pages_csv_twice)
_register_plain("refresh_marts_window", O.with_facts(("fact_engagement_daily", "fact_comms_impact_daily", "fact_sessions"), f"""
    SELECT 'engagement' AS part, CAST(g.d AS DATE) AS date, CAST(COALESCE(e.sessions, x.sessions, 0) AS BIGINT) AS sessions
    FROM (SELECT unnest(generate_series({O.d(START)}, {O.d(RP.DAY_PAST_CALENDAR)}, INTERVAL 1 DAY)) AS d) g
    LEFT JOIN fact_engagement_daily e ON e.date = CAST(g.d AS DATE)
    LEFT JOIN fact_sessions x ON x.date = {O.d(START)} AND CAST(g.d AS DATE) = {O.d(RP.DAY_PAST_CALENDAR)}
    UNION ALL SELECT 'campaigns', date, sessions FROM fact_comms_impact_daily
    WHERE NOT ({BT})
    UNION ALL SELECT 'calendar', {O.d(RP.DAY_PAST_CALENDAR)} + 1, NULL"""),
                lambda spark, sf_dir: RP.replay_marts_window(spark, sf_dir, START, END))


_register_plain("csv_countries_import_mixed", O.with_facts(("fact_sessions_by_country",), """
    SELECT DATE '2024-01-28' AS date, country_id || ' é' AS country_id, CAST(SUM(users) AS BIGINT) AS users
    FROM fact_sessions_by_country GROUP BY country_id"""), RP.replay_countries_csv_mixed)
_register_plain("csv_pages_import_buckets", REGISTRY["csv_pages_import_twice"][1],
                lambda spark, sf_dir: RP.replay_pages_csv_twice(spark, sf_dir, 8))

# the campaign days and the sends as they are after the window's refresh, then the summary of all of them
_COMMS_WINDOW = (START, "2024-01-16")
_IN_COMMS_WINDOW = O.between(*_COMMS_WINDOW)
_register_plain("refresh_comms_window", O.with_facts(
    ("fact_comms_impact_daily", "fact_rd_email_campaign"),
    O.CTES["fact_comms_impact_summary"][1].replace("fact_comms_impact_daily", "days").replace("fact_rd_email_campaign", "sent"),
    extra=(("days", f"""SELECT date, campaignId, sessions * CASE WHEN {_IN_COMMS_WINDOW} THEN 2 ELSE 1 END AS sessions
                        FROM fact_comms_impact_daily"""),
           ("sent", f"""SELECT date, campaignId, sends + CASE WHEN {_IN_COMMS_WINDOW} THEN 1 ELSE 0 END AS sends, opens, clicks
                        FROM fact_rd_email_campaign WHERE date <> {O.d(START)}"""))),
                lambda spark, sf_dir: RP.replay_comms_window(spark, sf_dir, *_COMMS_WINDOW))

_LANDED_DAYS = f"""SELECT strftime(date, '%Y%m%d') AS day, {BT} AS inside FROM fact_ga4_pages_daily
    UNION ALL SELECT * FROM (VALUES ('{RP.JUNK_DATES[1]}', FALSE)) v(day, inside)"""
_BAD_DAYS = " UNION ALL ".join(f"SELECT '{d}' AS day" for d in (RP.JUNK_DATES[0], RP.JUNK_DATES[2]))
_register_plain("refresh_pages_quarantine", O.with_facts(("fact_ga4_pages_daily",), """
    SELECT 'landed' AS part, day, COUNT(*) AS "rows" FROM (SELECT day FROM landed UNION ALL SELECT day FROM bad) x GROUP BY day
    UNION ALL SELECT 'accepted', day, COUNT(*) FROM landed WHERE inside GROUP BY day
    UNION ALL SELECT 'out_of_window', day, COUNT(*) FROM landed WHERE NOT inside GROUP BY day
    UNION ALL SELECT 'bad_date', day, COUNT(*) FROM bad GROUP BY day""", extra=(("landed", _LANDED_DAYS), ("bad", _BAD_DAYS))),
                lambda spark, sf_dir: RP.replay_quarantine(spark, sf_dir, "fact_ga4_pages_daily", START, END))

_UNKNOWN = ", ".join(f"'{x}'" for x in RP.UNKNOWN_TO_THE_SOURCE)
_ASKED = "SELECT * FROM (VALUES " + ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in QA.report_requests()) + ") r(dataset, kind, field)"
_register_plain("metadata_invalid_fields", f"""
    WITH asked AS ({_ASKED}) SELECT dataset, kind, field FROM asked
    WHERE field IN ({_UNKNOWN}) AND EXISTS (SELECT 1 FROM events)""",
                lambda spark, sf_dir: RP.replay_metadata(spark, sf_dir, "invalid_fields"))
_register_plain("metadata_datasets_catalog", O.with_facts(("fact_sessions",), _catalog_sql(("fact_sessions",))[1] + f"""
    UNION ALL SELECT 'GA4', 'ga4_metadata', kind, name, '', NULL, NULL
    FROM (SELECT DISTINCT kind, field AS name FROM asked WHERE field NOT IN ({_UNKNOWN})
          UNION ALL SELECT DISTINCT 'dimension', 'customEvent:' || event_type FROM events WHERE event_type IS NOT NULL) m""",
    extra=(("asked", _ASKED),)), lambda spark, sf_dir: RP.replay_metadata(spark, sf_dir, "datasets_catalog"))

_register_plain("top_pages_fallback", O.with_facts(("fact_sessions",), f"""
    SELECT 'NA' AS page_path, 'Total' AS page_title, CAST(COALESCE(SUM(pageviews), 0) AS BIGINT) AS pageviews
    FROM fact_sessions WHERE {BT}"""), lambda spark, sf_dir: RP.replay_pages_fallback(spark, sf_dir, START, END))
_register_plain("report_cache", O.with_facts(("fact_sessions",), f"""
    SELECT part, date, pageviews, sessions, users FROM fact_sessions, (VALUES ('first'), ('again')) v(part) WHERE {BT}"""),
                lambda spark, sf_dir: RP.replay_report_cache(spark, sf_dir, START, END))
_register_plain("csv_export_and_append", O.with_facts(("fact_sessions_by_country",), """
    SELECT date, country_id, users FROM fact_sessions_by_country"""), RP.replay_csv_export)
_register_plain("registry_checks", O.with_facts(("fact_ga4_pages_daily", "fact_sessions"), """
    SELECT 'not_null' AS "check", 'ga4_pages_daily' AS dataset, 'pageTitle' AS target, COUNT(*) AS violations, COUNT(*) > 0 AS violated
    FROM fact_ga4_pages_daily WHERE pageTitle IS NULL
    UNION ALL SELECT 'not_null', 'ga4_pages_daily', 'date', COUNT(*), COUNT(*) > 0 FROM fact_ga4_pages_daily WHERE date IS NULL
    UNION ALL SELECT 'not_null', 'sessions', 'users', COUNT(*), COUNT(*) > 0 FROM fact_sessions WHERE users IS NULL
    UNION ALL SELECT 'unique', 'ga4_pages_daily', 'pagePath', CAST(COALESCE(SUM(n), 0) AS BIGINT), COUNT(*) > 0
    FROM (SELECT COUNT(*) AS n FROM fact_ga4_pages_daily GROUP BY pagePath HAVING COUNT(*) > 1) x
    UNION ALL SELECT 'unique', 'sessions', 'date', CAST(COALESCE(SUM(n), 0) AS BIGINT), COUNT(*) > 0
    FROM (SELECT COUNT(*) AS n FROM fact_sessions GROUP BY date HAVING COUNT(*) > 1) x"""), RP.registry_checks)


# a stored fact_sessions has the duration column of the CSV imports, empty here
_STORED_CATALOG = O.with_facts(_catalog_sql()[0], _catalog_sql()[1] + """
    UNION ALL SELECT 'GA4', 'fact_sessions', 'column', 'avg_session_duration:DOUBLE', '', CAST(COUNT(*) AS BIGINT), CAST(COUNT(*) AS BIGINT)
    FROM fact_sessions""")
for _name in ("quality_alerts", "datasets_catalog"):
    _register_plain(f"refresh_profile_{_name}", _STORED_CATALOG if _name == "datasets_catalog" else REGISTRY[_name][1],
                    lambda spark, sf_dir, _n=_name: RP.replay_profile(spark, sf_dir, START, END, _n))


def queries() -> dict[str, Builder]:
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}
