"""Oracle SQL (DuckDB dialect) for the registered queries.

Each oracle is one statement over the driver's tables: the warehouse facts are put in front
of it as CTEs, written independently of the Spark plans from the definitions of the facts.
Rules: integer sums are cast to BIGINT (DuckDB widens them), quotients are DOUBLE ÷ DOUBLE,
top-k orders carry the key as tie-break, '%Y-%W' / '%w' come from strftime.
"""

from __future__ import annotations

# Fixed query window of the oracle runs (both ends hit video-period week edges).
START, END, ANCHOR = "2024-01-08", "2024-01-28", "2024-01-28"


def d(x) -> str:
    return f"DATE '{x}'"


CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "ev": ((), """
        SELECT event_id, CAST(ts AS DATE) AS date, user_id, event_type,
               user_id * 24 + extract(hour FROM ts) AS session_key,
               CAST(floor(value) AS BIGINT) AS val,
               TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
        FROM events"""),
    "fact_sessions": (("ev",), """
        SELECT date,
               CAST(SUM(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS pageviews,
               COUNT(DISTINCT session_key) AS sessions, COUNT(DISTINCT user_id) AS users
        FROM ev GROUP BY date"""),
    "fact_ga4_events_daily": (("ev",), """
        SELECT date,
               CASE event_type WHEN 'view' THEN 'video_start' WHEN 'click' THEN 'video_progress'
                    ELSE event_type END AS eventName,
               COUNT(*) AS eventCount, COUNT(DISTINCT user_id) AS activeUsers
        FROM ev GROUP BY date, event_type"""),
    "fact_ga4_pages_daily": (("ev",), """
        SELECT e.date, concat('/p/', CAST(e.k AS VARCHAR)) AS pagePath,
               CASE WHEN e.k % 10 <> 0 THEN p.url END AS pageTitle,
               CAST(SUM(CASE WHEN e.event_type IN ('view', 'click') THEN 1 ELSE 0 END) AS BIGINT) AS screenPageViews,
               COUNT(DISTINCT e.session_key) AS sessions, COUNT(DISTINCT e.user_id) AS totalUsers
        FROM ev e LEFT JOIN pages p ON p.page_id = e.k
        GROUP BY e.date, e.k, p.url"""),
    "fact_sessions_by_country": (("ev",), """
        SELECT e.date, n.n_name AS country_id, COUNT(DISTINCT e.user_id) AS users
        FROM ev e JOIN customer c ON c.c_custkey = e.user_id JOIN nation n ON n.n_nationkey = c.c_nationkey
        GROUP BY e.date, n.n_name"""),
    "fact_ga4_sessions_by_utm_daily": (("ev",), """
        SELECT date, source, medium, campaign,
               COUNT(DISTINCT session_key) AS sessions, COUNT(DISTINCT user_id) AS users
        FROM (SELECT date, session_key, user_id,
                     CASE WHEN k % 2 = 0 THEN upper(event_type) ELSE concat(' ', event_type) END AS source,
                     CASE k % 3 WHEN 0 THEN 'Email ' WHEN 1 THEN 'cpc' END AS medium,
                     concat(' Camp-', CAST(k % 8 AS VARCHAR)) AS campaign
              FROM ev) t
        GROUP BY date, source, medium, campaign"""),
    "map_utm_campaign": (("ev",), """
        SELECT utm_source, utm_medium, utm_campaign, campaignId, campaign_name,
               lower(trim(utm_source)) AS utm_source_norm, lower(trim(utm_medium)) AS utm_medium_norm,
               lower(trim(utm_campaign)) AS utm_campaign_norm
        FROM (SELECT DISTINCT concat(event_type, ' ') AS utm_source, 'EMAIL' AS utm_medium,
                     concat('camp-', CAST(k % 8 AS VARCHAR)) AS utm_campaign,
                     concat('C', CAST(k % 8 AS VARCHAR)) AS campaignId,
                     concat('Campaign ', CAST(k % 8 AS VARCHAR)) AS campaign_name
              FROM ev WHERE k IS NOT NULL) t"""),
    "fact_rd_email_campaign": (("ev",), """
        SELECT MIN(date) AS date, concat('C', CAST(k % 8 AS VARCHAR)) AS campaignId, COUNT(*) AS sends,
               COUNT(*) FILTER (WHERE event_type IN ('view', 'click')) AS opens,
               COUNT(*) FILTER (WHERE event_type = 'click') AS clicks
        FROM ev WHERE k IS NOT NULL GROUP BY k % 8, date_trunc('week', date)"""),
    "fact_yt_channel_daily": (("ev",), """
        SELECT date, COUNT(*) AS views, CAST(SUM(val) AS BIGINT) AS estimatedMinutesWatched,
               CAST(SUM(val) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS averageViewDuration
        FROM ev WHERE event_type IN ('view', 'click') GROUP BY date"""),
    "fact_yt_video_period": (("ev",), """
        SELECT concat('v', CAST(k AS VARCHAR)) AS videoId, COUNT(*) AS views,
               CAST(SUM(val) AS BIGINT) AS estimatedMinutesWatched,
               CAST(SUM(val) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS averageViewDuration,
               CAST(date_trunc('week', date) AS DATE) AS startDate,
               CAST(CAST(date_trunc('week', date) AS DATE) + 6 AS DATE) AS endDate
        FROM ev WHERE event_type IN ('view', 'click') GROUP BY k, date_trunc('week', date)"""),
    "dim_date": ((), """
        SELECT CAST(g.d AS DATE) AS date, CAST(year(g.d) AS INTEGER) AS year,
               CAST(month(g.d) AS INTEGER) AS month, CAST(strftime(g.d, '%W') AS INTEGER) AS week
        FROM (SELECT unnest(generate_series(
                  (SELECT CAST(min(ts) AS DATE) FROM events),
                  (SELECT CAST(max(ts) AS DATE) FROM events) + 1,
                  INTERVAL 1 DAY)) AS d) g"""),
    "fact_engagement_daily": (("dim_date", "fact_sessions", "fact_yt_channel_daily"), """
        SELECT dd.date,
               CAST(COALESCE(s.sessions, 0) AS BIGINT) AS sessions,
               CAST(COALESCE(s.pageviews, 0) AS BIGINT) AS pageviews,
               CAST(COALESCE(y.views, 0) AS BIGINT) AS views,
               CAST(COALESCE(y.estimatedMinutesWatched, 0) AS BIGINT) AS estimatedMinutesWatched,
               CAST(COALESCE(y.averageViewDuration, 0.0) AS DOUBLE) AS averageViewDuration
        FROM dim_date dd
        LEFT JOIN fact_sessions s ON s.date = dd.date
        LEFT JOIN fact_yt_channel_daily y ON y.date = dd.date"""),
    "fact_comms_impact_daily": (("fact_ga4_sessions_by_utm_daily", "map_utm_campaign"), """
        SELECT g.date, m.campaignId,
               CAST(SUM(g.sessions) AS BIGINT) AS sessions, CAST(SUM(g.users) AS BIGINT) AS users
        FROM (SELECT date, sessions, users, lower(trim(source)) AS ks, lower(trim(medium)) AS km,
                     lower(trim(campaign)) AS kc
              FROM fact_ga4_sessions_by_utm_daily) g
        JOIN (SELECT campaignId, utm_source_norm, utm_medium_norm, utm_campaign_norm
              FROM map_utm_campaign WHERE campaignId IS NOT NULL) m
          ON g.ks = m.utm_source_norm AND g.km = m.utm_medium_norm AND g.kc = m.utm_campaign_norm
        GROUP BY g.date, m.campaignId"""),
    # A send's band is looked up by day; the campaign's totals are added over all its sends.
    "fact_comms_impact_summary": (("fact_comms_impact_daily", "fact_rd_email_campaign"), """
        SELECT campaignId, send_date, before AS ses_d_1, same_day AS ses_d0, three_days AS ses_d0_d2,
               same_day - before AS uplift_abs,
               CASE WHEN before > 0 THEN 100.0 * CAST(same_day - before AS DOUBLE) / CAST(before AS DOUBLE)
                    ELSE 0.0 END AS uplift_pct,
               sends, opens, clicks
        FROM (SELECT s.campaignId, s.date AS send_date,
                     CAST(COALESCE(SUM(i.sessions) FILTER (WHERE i.date < s.date), 0) AS BIGINT) AS before,
                     CAST(COALESCE(SUM(i.sessions) FILTER (WHERE i.date = s.date), 0) AS BIGINT) AS same_day,
                     CAST(COALESCE(SUM(i.sessions) FILTER (WHERE i.date >= s.date), 0) AS BIGINT) AS three_days
              FROM (SELECT DISTINCT campaignId, date FROM fact_rd_email_campaign) s
              LEFT JOIN fact_comms_impact_daily i
                ON i.campaignId = s.campaignId AND i.date - s.date BETWEEN -1 AND 2
              GROUP BY ALL) band
        JOIN (SELECT campaignId, CAST(SUM(sends) AS BIGINT) AS sends, CAST(SUM(opens) AS BIGINT) AS opens,
                     CAST(SUM(clicks) AS BIGINT) AS clicks
              FROM fact_rd_email_campaign GROUP BY ALL) USING (campaignId)"""),
}


def _closure(names) -> list[str]:
    seen: list[str] = []

    def visit(n):
        if n in seen:
            return
        for dep in CTES[n][0]:
            visit(dep)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def with_facts(uses: tuple[str, ...], body: str, extra: tuple[tuple[str, str], ...] = ()) -> str:
    """Prefix ``body`` with the CTEs it uses (and their dependencies, in order), then ``extra``."""
    parts = [f"{n} AS ({CTES[n][1].rstrip()}\n)" for n in _closure(uses)]
    parts += [f"{n} AS ({q.strip()})" for n, q in extra]
    if not parts:
        return body.strip()
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


def between(start=START, end=END) -> str:
    return f"date BETWEEN {d(start)} AND {d(end)}"


def pct_sql(c: str, r: str) -> str:
    return (f"CASE WHEN {r} = 0 THEN (CASE WHEN {c} = 0 THEN 0.0 ELSE 100.0 END) "
            f"ELSE ({c} - {r}) / {r} * 100.0 END")


def compare_sql(metrics: dict[str, str], cur, ref, scale: float = 1.0, ref_name: str = "previous") -> str:
    lo, hi = min(cur[0], ref[0]), max(cur[1], ref[1])
    sums = []
    for n, col in metrics.items():
        sums.append(f"SUM(CASE WHEN date BETWEEN {d(cur[0])} AND {d(cur[1])} THEN {col} END) AS c_{n}")
        sums.append(f"SUM(CASE WHEN date BETWEEN {d(ref[0])} AND {d(ref[1])} THEN {col} END) AS r_{n}")
    rows = []
    for n in metrics:
        c = f"CAST(COALESCE(c_{n}, 0) AS DOUBLE)"
        r = f"(CAST(COALESCE(r_{n}, 0) AS DOUBLE) * {float(scale)!r})"
        rows.append(f"SELECT '{n}' AS metric, {c} AS current, {r} AS {ref_name}, {c} - {r} AS delta_abs, "
                    f"round({pct_sql(c, r)}, 1) AS delta_pct FROM p")
    p = (f"SELECT {', '.join(sums)} FROM fact_engagement_daily "
         f"WHERE date BETWEEN {d(lo)} AND {d(hi)}")
    return with_facts(("fact_engagement_daily",), "\nUNION ALL\n".join(rows), extra=(("p", p),))
