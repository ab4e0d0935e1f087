"""Custom operators against brute force on small fixtures."""

import datetime as dt
import random

import pytest

from pyspark.sql import functions as F

from tidemark.operators import compare as CMP
from tidemark.operators.distinct import sessions_and_users
from tidemark.operators.prefix import running_share_all, running_share_top
from tidemark.plans import marts as M


def _brute_pareto(rows):
    ordered = sorted(rows, key=lambda r: (-r[1], r[0]))
    total = sum(v for _, v in ordered)
    out, acc = [], 0
    for k, v in ordered:
        acc += v
        out.append((k, v, acc / total if total else None))
    return out


def test_running_share_all_matches_brute_force_with_ties(spark):
    rnd = random.Random(7)
    rows = [(f"/p/{i:04d}", rnd.choice([1, 1, 1, 2, 5, 50])) for i in range(2000)]
    df = spark.createDataFrame(rows, "key string, v bigint")
    got = {r.key: (r.v, r.cum_share) for r in running_share_all(df, "v", "key", rows_per_range=137).collect()}
    for k, v, share in _brute_pareto(rows):
        assert got[k][0] == v
        assert abs(got[k][1] - share) < 1e-12
    assert abs(max(s for _, s in got.values()) - 1.0) < 1e-12


def test_running_share_top_is_prefix_of_all(spark):
    rnd = random.Random(3)
    rows = [(f"k{i}", rnd.randint(0, 9)) for i in range(300)]
    df = spark.createDataFrame(rows, "key string, v bigint")
    top = [(r.key, r.cum_share) for r in running_share_top(df, "v", "key", 25).collect()]
    full = _brute_pareto(rows)[:25]
    assert sorted(k for k, _ in top) == sorted(k for k, _, _ in full)
    ref = {k: s for k, _, s in full}
    for k, s in top:
        assert abs(s - ref[k]) < 1e-12


@pytest.mark.parametrize("slot", [None, "hour"])
def test_sessions_and_users_equals_count_distinct(spark, slot):
    rnd = random.Random(1)
    rows = [(rnd.choice(["a", "b"]), rnd.choice([1, 2, 3, None]), rnd.choice([0, 5, 23, None]))
            for _ in range(500)]
    rows = [(g, u, None if u is None or h is None else u * 24 + h, h) for g, u, h in rows]
    df = spark.createDataFrame(rows, "g string, user_id bigint, session_key bigint, hour int")
    got = {r.g: (r.sessions, r.users) for r in sessions_and_users(df, ["g"], session_slot=slot).collect()}
    for g in ("a", "b"):
        sub = [r for r in rows if r[0] == g]
        assert got[g] == (len({r[2] for r in sub if r[2] is not None}), len({r[1] for r in sub if r[1] is not None}))


def test_compare_periods_equals_separate_scans(spark):
    days = [dt.date(2024, 3, 1) + dt.timedelta(days=i) for i in range(31)]
    df = spark.createDataFrame([(d, i * 3, i % 4) for i, d in enumerate(days)], "date date, a bigint, b bigint")
    cur, ref = CMP.wow_windows("2024-03-31")
    out = {r.metric: r for r in CMP.compare_periods(df, {"a": "a", "b": "b"}, cur, ref).collect()}

    def s(col, w):
        return df.where(F.col("date").between(F.lit(w[0]), F.lit(w[1]))).agg(F.sum(col)).first()[0]
    for m in ("a", "b"):
        assert out[m].current == float(s(m, cur)) and out[m].previous == float(s(m, ref))


def test_mtd_window_overruns_short_month():
    (cs, ce), (ps, pe) = CMP.mtd_windows("2024-03-31")
    assert (cs, ce) == (dt.date(2024, 3, 1), dt.date(2024, 3, 31))
    assert (ps, pe) == (dt.date(2024, 2, 1), dt.date(2024, 3, 2))
    assert CMP.mtd_windows("2024-03-31", clamp_prev_month=True)[1] == (dt.date(2024, 2, 1), dt.date(2024, 2, 29))


def test_seven_vs_28_windows_include_current_week():
    (cs, ce), (rs, re) = CMP.seven_vs_28_windows("2024-01-28")
    assert (cs, ce, rs, re) == (dt.date(2024, 1, 22), dt.date(2024, 1, 28), dt.date(2024, 1, 1), dt.date(2024, 1, 28))


def test_engagement_reduces_duplicate_dates(spark):
    cal = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (1, 2, 3)], "date date")
    s = spark.createDataFrame([(dt.date(2024, 1, 1), 10, 5), (dt.date(2024, 1, 1), 1, None),
                               (dt.date(2024, 1, 2), 3, 3)], "date date, pageviews bigint, sessions bigint")
    y = spark.createDataFrame([(dt.date(2024, 1, 2), 4, 40, 2.5), (dt.date(2024, 1, 2), 6, 10, 5.0),
                               (dt.date(2024, 1, 3), 1, 1, 1.0 / 3)],
                              "date date, views bigint, estimatedMinutesWatched bigint, averageViewDuration double")
    got = {r.date.day: r for r in M.engagement_daily(cal, s, y).collect()}
    assert len(got) == 3
    assert (got[1].sessions, got[1].pageviews, got[1].views) == (5, 11, 0)
    assert abs(got[2].averageViewDuration - 4.0) < 1e-12 and got[2].views == 10
    assert got[3].averageViewDuration == 1.0 / 3 and got[3].sessions == 0


def test_comms_summary_campaign_sent_twice(spark):
    d = dt.date
    daily = spark.createDataFrame([(d(2024, 1, 2), "C0", 5), (d(2024, 1, 3), "C0", 20), (d(2024, 1, 4), "C0", 30),
                                   (d(2024, 1, 5), "C0", 10), (d(2024, 1, 19), "C0", 7), (d(2024, 1, 20), "C0", 8),
                                   (d(2024, 1, 3), "C9", 99)], "date date, campaignId string, sessions bigint")
    sends = spark.createDataFrame([(d(2024, 1, 3), "C0", 10, 4, 1), (d(2024, 1, 20), "C0", 5, 2, 1),
                                   (d(2024, 1, 8), "C1", 3, 1, 0)],
                                  "date date, campaignId string, sends bigint, opens bigint, clicks bigint")
    clean = {(r.campaignId, r.send_date.day): r for r in M.comms_impact_summary(daily, sends).collect()}
    r = clean[("C0", 3)]
    assert (r.ses_d_1, r.ses_d0, r.ses_d0_d2, r.uplift_abs, r.sends) == (5, 20, 60, 15, 15)
    assert r.uplift_pct == 300.0
    r2 = clean[("C0", 20)]
    assert (r2.ses_d_1, r2.ses_d0, r2.ses_d0_d2) == (7, 8, 8)
    c1 = clean[("C1", 8)]
    assert (c1.ses_d_1, c1.ses_d0, c1.ses_d0_d2, c1.uplift_pct) == (0, 0, 0, 0.0)
    faithful = {(r.campaignId, r.send_date.day): r
                for r in M.comms_impact_summary(daily, sends, faithful_fanout=True).collect()}
    assert faithful[("C0", 3)].ses_d0_d2 == 120 and faithful[("C0", 3)].ses_d0 == 20


def test_utm_null_medium_never_matches(spark):
    g = spark.createDataFrame([(dt.date(2024, 1, 1), " Email", None, "Camp-1", 3, 2),
                               (dt.date(2024, 1, 1), "email ", " CPC", " camp-1", 5, 4)],
                              "date date, source string, medium string, campaign string, sessions bigint, users bigint")
    from tidemark.sources.adapters import with_utm_norm
    m = with_utm_norm(spark.createDataFrame([("EMAIL", "cpc", "CAMP-1", "C1", "c")],
                                            "utm_source string, utm_medium string, utm_campaign string, "
                                            "campaignId string, campaign_name string"))
    rows = M.comms_impact_daily(g, m).collect()
    assert [(r.campaignId, r.sessions, r.users) for r in rows] == [("C1", 5, 4)]


from hypothesis import given, settings, strategies as st  # noqa: E402

from tidemark.operators.tables import upsert_by_key  # noqa: E402


@settings(max_examples=20, deadline=None)
@given(old=st.dictionaries(st.sampled_from("abcdef"), st.text("xyz", min_size=1, max_size=3), max_size=6),
       new=st.lists(st.tuples(st.sampled_from("abcdefgh"), st.text("xyz", min_size=1, max_size=3)), max_size=8))
def test_upsert_matches_dictionary_model(spark, old, new):
    schema = "page_path string, page_title string"
    got = dict(tuple(r) for r in upsert_by_key(spark.createDataFrame(list(old.items()), schema),
                                               spark.createDataFrame(new, schema), "page_path").collect())
    model = dict(old)
    batch: dict[str, str] = {}
    for k, v in new:
        batch[k] = max(batch.get(k, v), v)  # a key twice in one batch: the greatest value
    model.update(batch)
    assert got == model


@settings(max_examples=15, deadline=None)
@given(day=st.integers(0, 365), kind=st.sampled_from(["wow", "mtd", "7v28"]))
def test_compare_periods_matches_brute_force(spark, day, kind):
    base = dt.date(2023, 12, 1)
    days = [base + dt.timedelta(days=i) for i in range(420)]
    rows = [(d, (i * 7919) % 97) for i, d in enumerate(days)]
    df = spark.createDataFrame(rows, "date date, v bigint")
    end = dt.date(2024, 1, 1) + dt.timedelta(days=day)
    cur, ref = {"wow": CMP.wow_windows, "mtd": CMP.mtd_windows, "7v28": CMP.seven_vs_28_windows}[kind](end)
    scale = 0.25 if kind == "7v28" else 1.0
    r = CMP.compare_periods(df, {"v": "v"}, cur, ref, ref_scale=scale).first()
    cs = float(sum(v for d, v in rows if cur[0] <= d <= cur[1]))
    rs = float(sum(v for d, v in rows if ref[0] <= d <= ref[1])) * scale
    assert (r.current, r.previous, r.delta_abs) == (cs, rs, cs - rs)
    want = (0.0 if cs == 0 else 100.0) if rs == 0 else (cs - rs) / rs * 100.0
    assert abs(r.delta_pct - want) <= 0.05 + 1e-9


def test_running_share_in_many_ranges_with_a_title_column(spark):
    n = 200_000
    df = spark.range(n).selectExpr("concat('/p/', lpad(id, 7, '0')) key", "pmod(xxhash64(id), 500) v", "concat('title ', id) title")
    got = running_share_all(df, "v", "key", rows_per_range=15_000).select("key", "cum_value", "cum_share", "title").toPandas()
    want = df.toPandas().sort_values(["v", "key"], ascending=[False, True])
    want["cum"] = want.v.cumsum()
    both = got.merge(want, on="key")
    assert len(got) == n and (both.cum_value == both.cum).all() and (both.title_x == both.title_y).all()
    assert abs(got.cum_share.max() - 1.0) < 1e-12


@pytest.mark.parametrize("window", [("2024-01-02", "2024-01-20"), ("2023-12-01", "2024-01-05"), ("2024-01-25", "2024-03-01"),
                                    ("2024-01-31", "2024-02-05"), ("2024-02-05", "2024-02-09"), ("2023-11-01", "2023-11-05"), ("2023-01-01", "2025-01-01")])
def test_windowed_engagement_equals_the_engagement_of_all_events(spark, window):
    from tidemark.functions import columns as C
    from tidemark.sources import adapters as A
    from tidemark.sources.warehouse import DerivedWarehouse
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events = events.where(~F.to_date("ts").between(C.date_lit("2024-01-12"), C.date_lit("2024-01-14")))  # days without events
    day_before = C.as_date(window[0]) - dt.timedelta(days=1)
    got = M.engagement_window(A.engagement_days(A.event_rows(events, day_before, window[1])), events, *window)
    ev = A.event_rows(events)
    whole = M.engagement_daily(M.dim_date_from_events(events), A.fact_sessions(ev), A.fact_yt_channel_daily(ev))
    inside = whole.where(F.col("date").between(C.date_lit(window[0]), C.date_lit(window[1])))
    assert sorted(got.collect()) == sorted(inside.collect())
    assert sorted(M.engagement_from_days(A.engagement_days(ev)).collect()) == sorted(whole.collect())
    w = DerivedWarehouse(spark, "/root/testdata/sf0.001")
    heavy = w.fact("fact_engagement_daily", *window)._jdf.queryExecution().optimizedPlan().toString()
    assert heavy.count("bit_or") == 1  # one aggregate of the events
