"""Window refresh, upsert, landed reports and CSV exports on hand-made edge cases."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from tidemark.operators import tables as K
from tidemark.plans import ingest as I
from tidemark.sources import exports as X
from tidemark.sources import landed as L
from tidemark.sources.warehouse import StoredWarehouse

D = dt.date
FS = "date date, pageviews bigint, sessions bigint, users bigint"


def _local(p):
    return p[5:] if p.startswith("file:") else p


def _rows(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).select("date", "pageviews", "sessions", "users").collect())


def test_replace_window_drops_emptied_days_and_is_idempotent(spark, tmpdir_spark):
    path = f"{tmpdir_spark}/fact_sessions"
    old = spark.createDataFrame([(D(2024, 1, d), d, d, d) for d in range(1, 11)], FS)
    K.write_partitioned(old, path, ["date"])
    new = spark.createDataFrame([(D(2024, 1, 5), 50, 50, 50), (D(2024, 1, 7), 70, 70, 70),
                                 (D(2024, 1, 30), 1, 1, 1), (None, 9, 9, 9)], FS)
    assert K.replace_window(spark, new, path, "2024-01-04", "2024-01-08")
    once = _rows(spark, path)
    expect = [(D(2024, 1, d), d, d, d) for d in (1, 2, 3, 9, 10)] + [(D(2024, 1, 5), 50, 50, 50),
                                                                       (D(2024, 1, 7), 70, 70, 70)]
    assert once == sorted(expect)
    K.replace_window(spark, new, path, "2024-01-04", "2024-01-08")
    assert _rows(spark, path) == once


def test_replace_window_empty_batch_leaves_table(spark, tmpdir_spark):
    path = f"{tmpdir_spark}/fact_sessions"
    old = spark.createDataFrame([(D(2024, 1, d), d, d, d) for d in range(1, 4)], FS)
    K.write_partitioned(old, path, ["date"])
    assert not K.replace_window(spark, spark.createDataFrame([], FS), path, "2024-01-01", "2024-01-31")
    assert len(_rows(spark, path)) == 3


def test_replace_window_df_pure_form(spark):
    old = spark.createDataFrame([(D(2024, 1, 1), 1, 1, 1), (D(2024, 1, 2), 2, 2, 2), (None, 3, 3, 3)], FS)
    new = spark.createDataFrame([(D(2024, 1, 2), 20, 20, 20)], FS)
    got = {tuple(r) for r in K.replace_window_df(old, new, "2024-01-02", "2024-01-02").collect()}
    assert got == {(D(2024, 1, 1), 1, 1, 1), (None, 3, 3, 3), (D(2024, 1, 2), 20, 20, 20)}
    assert K.replace_window_df(old, new.limit(0), "2024-01-01", "2024-01-31").count() == 3


def test_upsert_by_key_new_wins_and_batch_duplicates(spark):
    old = spark.createDataFrame([("/a", "A old"), ("/b", "B")], "page_path string, page_title string")
    new = spark.createDataFrame([("/a", "A new"), ("/c", "C1"), ("/c", "C2")], "page_path string, page_title string")
    got = dict(tuple(r) for r in K.upsert_by_key(old, new, "page_path").collect())
    assert got == {"/a": "A new", "/b": "B", "/c": "C2"}


def test_read_report_by_header_name_with_bad_values(spark, tmpdir_spark):
    p = _local(f"{tmpdir_spark}/report")
    os.makedirs(p, exist_ok=True)
    pages = [
        {"dimension_headers": [{"name": "date"}], "metric_headers": [{"name": "totalUsers"}, {"name": "sessions"},
                                                                     {"name": "screenPageViews"}],
         "rows": [{"dimension_values": [{"value": "20240105"}],
                   "metric_values": [{"value": "3"}, {"value": "4.9"}, {"value": "x"}]}]},
        {"dimension_headers": [{"name": "date"}], "metric_headers": [{"name": "screenPageViews"}, {"name": "sessions"},
                                                                     {"name": "totalUsers"}],
         "rows": [{"dimension_values": [{"value": "20240230"}],
                   "metric_values": [{"value": "7"}, {"value": "8"}, {"value": "9"}]},
                  {"dimension_values": [{"value": "20240106"}],
                   "metric_values": [{"value": "70"}, {"value": "80"}, {"value": "90"}]}]},
    ]
    with open(f"{p}/part.json", "w") as f:
        for pg in pages:
            f.write(json.dumps(pg) + "\n")
    rows = sorted(tuple(r) for r in I.report_batch(spark, p, I.SESSIONS).collect()
                  if r.date is not None)
    assert rows == [(D(2024, 1, 5), None, 4, 3), (D(2024, 1, 6), 70, 80, 90)]
    assert I.report_batch(spark, p, I.SESSIONS).where(F.col("date").isNull()).count() == 1


def test_land_and_read_report_roundtrip(spark, tmpdir_spark):
    df = spark.createDataFrame([(D(2024, 1, d), d * 10, d, d + 1) for d in range(1, 8)], FS)
    path = f"{tmpdir_spark}/landed"
    L.land_report(df.withColumnRenamed("users", "totalUsers").withColumnRenamed("pageviews", "screenPageViews"),
                  path, ["date"], ["totalUsers", "sessions", "screenPageViews"], page_size=3)
    sizes = [len(json.loads(r.value)["rows"]) for r in spark.read.text(path).collect()]
    assert max(sizes) <= 3 and sum(sizes) == 7
    back = sorted(tuple(r) for r in I.report_batch(spark, path, I.SESSIONS).collect())
    assert back == sorted(tuple(r) for r in df.collect())


def test_land_records_pages_stay_bounded_with_duplicates(spark, tmpdir_spark):
    same = spark.createDataFrame([("x", "lead")] * 1000 + [(str(i), "mql") for i in range(500)],
                                 "id string, lifecycle_stage string").repartition(3)
    path = f"{tmpdir_spark}/dups"
    L.land_records(same, path, wrapper="contacts", page_size=100)
    sizes = [len(json.loads(r.value)["contacts"]) for r in spark.read.text(path).collect()]
    assert max(sizes) <= 100 and sum(sizes) == 1500
    assert L.read_contacts(spark, path).count() == 1500


def test_records_bare_and_wrapped(spark, tmpdir_spark):
    p = _local(f"{tmpdir_spark}/contacts")
    os.makedirs(p, exist_ok=True)
    with open(f"{p}/a.json", "w") as f:
        f.write(json.dumps([{"id": "1", "updated_at": "2024-01-05T10:00:00Z", "lifecycle_stage": "lead"},
                            {"id": "2", "updated_at": "2024-01-06", "status": ""}]) + "\n")
        f.write(json.dumps({"contacts": [{"id": "3", "updated_at": "2024-01-07", "funnel_stage": "mql"},
                                         {"id": "4", "updated_at": "2023-12-01", "funnel_stage": "old"}]}) + "\n")
    got = sorted(tuple(r)[1:] for r in I.lead_stage_batch(spark, p, "2024-01-01", "2024-01-31").collect())
    assert got == [("lead", 1), ("mql", 1), ("unknown", 1)]


def test_email_campaigns_alternatives_and_empty_id(spark, tmpdir_spark):
    c = _local(f"{tmpdir_spark}/camp")
    m = _local(f"{tmpdir_spark}/met")
    os.makedirs(c, exist_ok=True)
    os.makedirs(m, exist_ok=True)
    with open(f"{c}/a.json", "w") as f:
        f.write(json.dumps({"items": [{"id": "", "uuid": "U1", "sent_at": "2024-01-09T08:00:00Z"},
                                      {"campaignId": "C2"},
                                      {"id": ""}]}) + "\n")
    with open(f"{m}/a.json", "w") as f:
        f.write(json.dumps({"campaign_id": "U1", "sends": 0, "delivered": 12, "unique_opens": 5, "clicks": 2}) + "\n")
    got = sorted(tuple(r) for r in I.email_campaign_batch(spark, c, m, "2024-01-31").collect())
    assert got == [(D(2024, 1, 9), "U1", 12, 5, 2), (D(2024, 1, 31), "C2", 0, 0, 0)]


def test_csv_exports_encodings_totals_and_headers(spark, tmpdir_spark):
    p = _local(f"{tmpdir_spark}/pages.csv")
    text = ("Título da página,Caminho da página e classe da tela,Visualizações,Usuários ativos\n"
            "Home,/,10,3\nAulas,/aulas,x,2\nTotal geral,,10,5\n,/sem,1,1\n")
    with open(p, "w", encoding="latin-1") as f:
        f.write(text)
    df = X.import_exports(spark, [p, p + ".missing"])
    dim, fact = X.pages_export(df, "2024-01-28")
    assert sorted(tuple(r) for r in dim.collect()) == [("/", "Home"), ("/aulas", "Aulas")]
    assert {(r.pageviews, r.users) for r in fact.collect()} == {(10, 3), (None, 2)}
    u16 = _local(f"{tmpdir_spark}/countries.csv")
    with open(u16, "w", encoding="utf-16") as f:
        f.write("ID do país,Usuários ativos\nBrasil,7\nPortugal,2\n")
    _, cfact = X.countries_export(X.import_exports(spark, [u16]), "2024-01-28")
    assert sorted((r.country_id, r.users) for r in cfact.collect()) == [("Brasil", 7), ("Portugal", 2)]


def test_two_headers_for_one_name_are_coalesced(spark):
    df = spark.createDataFrame([("1", None), (None, "2")], "`Usuários` string, `Usuários ativos` string")
    got = [r[0] for r in X.rename_headers(df, X.COMMON_HEADERS).collect()]
    assert got == ["1", "2"]


def test_utm_map_missing_file_gives_empty(spark, tmpdir_spark):
    path = f"{tmpdir_spark}/map"
    I.import_utm_map(spark, None, path)
    assert spark.read.parquet(path).count() == 0


def test_report_cache_reuses_unless_forced(spark, tmpdir_spark):
    df = spark.createDataFrame([(1,)], "a int")
    p1 = K.cache_report(df, tmpdir_spark, ["date"], ["sessions"], "2024-01-01", "2024-01-31")
    p2 = K.cache_report(spark.createDataFrame([(2,)], "a int"), tmpdir_spark, ["date"], ["sessions"],
                        "2024-01-01", "2024-01-31")
    assert p1 == p2 and spark.read.parquet(p1).first().a == 1
    K.cache_report(spark.createDataFrame([], "a int"), tmpdir_spark, ["date"], ["sessions"],
                   "2024-01-01", "2024-01-31", force=True)
    assert spark.read.parquet(p1).count() == 0


def test_stored_warehouse_missing_tables_in_health(spark, tmpdir_spark):
    from tidemark.plans import queries as Q
    root = f"{tmpdir_spark}/wh"
    K.write_partitioned(spark.createDataFrame([(D(2024, 1, 2), 1, 2, 3)], FS), f"{root}/fact_sessions", ["date"])
    w = StoredWarehouse(spark, root)
    got = dict(tuple(r) for r in Q.health(w).collect())
    assert got["rows_fact_sessions"] == "1" and got["rows_fact_events"] == "0"
    assert got["latest_date_fact_sessions"] == "2024-01-02" and got["latest_date_ga4_pages_daily"] == "None"
    tp = {tuple(r) for r in Q.top_pages(w, "2024-01-01", "2024-01-31").collect()}
    assert tp == {("NA", "Total", 1)}


def test_export_csv_and_ensure_table(spark, tmpdir_spark):
    df = spark.createDataFrame([("GA4", "fact_sessions", "column", "date:DATE", "")],
                               "source string, dataset string, type string, name string, description string")
    K.export_csv(df, f"{tmpdir_spark}/catalog_csv")
    back = spark.read.option("header", True).csv(f"{tmpdir_spark}/catalog_csv")
    assert back.columns == df.columns and back.first().name == "date:DATE"
    path = f"{tmpdir_spark}/wh/fact_ga4_events_daily"
    K.ensure_table(spark, path, "fact_ga4_events_daily")
    t = StoredWarehouse(spark, f"{tmpdir_spark}/wh").table("fact_ga4_events_daily")
    assert t.count() == 0 and t.columns == ["date", "eventName", "eventCount", "activeUsers"]
    K.ensure_table(spark, path, "fact_ga4_events_daily")  # exists: untouched


def test_video_funnel_falls_back_to_csv_events(spark, tmpdir_spark):
    from tidemark.plans import queries as Q
    root = f"{tmpdir_spark}/wh2"
    ev = spark.createDataFrame([(D(2024, 1, 5), "video_start", 40, "A"), (D(2024, 1, 5), "video_progress", 10, "A"),
                                (D(2024, 1, 6), "video_start", 10, "B"), (D(2024, 2, 1), "video_start", 99, "A")],
                               "date date, event_name string, event_count bigint, video_title string")
    K.append(ev, f"{root}/fact_events", ["date"])
    r = Q.video_funnel(StoredWarehouse(spark, root), "2024-01-01", "2024-01-31").first()
    assert (r.start, r.progress, r.completion_rate) == (50, 10, 20.0)


from hypothesis import given, settings, strategies as st  # noqa: E402

_day = st.integers(min_value=1, max_value=12).map(lambda d: D(2024, 1, d))


@settings(max_examples=25, deadline=None)
@given(old=st.lists(st.tuples(st.one_of(st.none(), _day), st.integers(0, 9)), max_size=12),
       new=st.lists(st.tuples(_day, st.integers(0, 9)), max_size=8),
       lo=st.integers(1, 12), span=st.integers(0, 5))
def test_replace_window_df_matches_model(spark, old, new, lo, span):
    start, end = D(2024, 1, lo), D(2024, 1, min(12, lo + span))
    schema = "date date, v int"
    got = K.replace_window_df(spark.createDataFrame(old, schema), spark.createDataFrame(new, schema), start, end)
    if new:
        model = [r for r in old if r[0] is None or not (start <= r[0] <= end)] + new
    else:
        model = old
    key = lambda r: (r[0] is not None, r[0] or D(1, 1, 1), r[1])
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(model, key=key)


def test_field_matrix_reports_empty_windows_as_zero(spark):
    from tidemark.plans import quality as QA
    from tidemark.sources.warehouse import DerivedWarehouse
    w = DerivedWarehouse(spark, "/root/testdata/sf0.001")
    rows = QA.field_matrix(w, "2023-06-30", 7).collect()
    assert len(rows) == 9 and all(r.rows == 0 for r in rows)


def test_created_empty_table_exists_without_rows(spark, tmpdir_spark):
    from tidemark.plans import queries as Q
    root = f"{tmpdir_spark}/wh3"
    K.ensure_table(spark, f"{root}/fact_ga4_events_daily", "fact_ga4_events_daily")
    ev = spark.createDataFrame([(D(2024, 1, 5), "video_start", 40, "A")],
                               "date date, event_name string, event_count bigint, video_title string")
    K.append(ev, f"{root}/fact_events", ["date"])
    w = StoredWarehouse(spark, root)
    assert w.has("fact_ga4_events_daily") and not w.has("fact_sessions")
    r = Q.video_funnel(w, "2024-01-01", "2024-01-31").first()   # existing GA4 table wins, even empty
    assert (r.start, r.progress, r.completion_rate) == (0, 0, 0.0)


def test_import_exports_stacks_different_headers(spark, tmpdir_spark):
    a = _local(f"{tmpdir_spark}/a.csv")
    b = _local(f"{tmpdir_spark}/b.csv")
    with open(a, "w", encoding="utf-8") as f:
        f.write("Data,Usuários,Sessões\n20240105,3,4\n")
    with open(b, "w", encoding="utf-8") as f:
        f.write("Data,Usuários ativos,Visualizações de tela\n20240106,7,9\n")
    got = {r.date: r.asDict() for r in X.import_exports(spark, [a, b]).collect()}
    assert got["20240105"]["users"] == "3" and got["20240105"]["sessions"] == "4" and got["20240105"]["pageviews"] is None
    assert got["20240106"]["users"] == "7" and got["20240106"]["pageviews"] == "9" and got["20240106"]["sessions"] is None


def test_a_stop_between_the_renames_loses_nothing(spark, tmpdir_spark):
    from tidemark.operators import tables as K
    path = f"{tmpdir_spark}/dim_page"
    page = lambda *keys: spark.createDataFrame([(k, "t" + k) for k in keys], "page_path string, page_title string")
    K.upsert_table(spark, page("/a", "/b"), path, "dim_page", "page_path")
    K._move(spark, path, K._aside(path))  # the job stopped here
    K.upsert_table(spark, page("/c"), path, "dim_page", "page_path")
    assert sorted(r.page_path for r in spark.read.parquet(path).collect()) == ["/a", "/b", "/c"]


def test_a_stop_between_the_days_of_a_window_loses_nothing(spark, tmpdir_spark):
    from tidemark.operators import tables as K
    path = f"{tmpdir_spark}/fact"
    day = lambda *ds: spark.createDataFrame([(d, 1) for d in ds], "d string, v int").selectExpr("to_date(d) date", "v")
    K.replace_window(spark, day("2024-01-01", "2024-01-02", "2024-01-03"), path, "2024-01-01", "2024-01-03")
    K._move(spark, f"{path}/date=2024-01-02", f"{K._days_aside(path)}/date=2024-01-02")  # the job stopped here
    assert K.replace_window(spark, day("2024-01-03", "2024-01-04"), path, "2024-01-03", "2024-01-03")
    assert sorted(str(r.date) for r in spark.read.parquet(path).collect()) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert not K.replace_window(spark, day("2024-02-01"), path, "2024-01-01", "2024-01-03")
    assert spark.read.parquet(path).count() == 3
    K.replace_window(spark, day("2024-02-01"), path, "2024-01-02", "2024-01-03", empty_clears=True)
    assert [str(r.date) for r in spark.read.parquet(path).collect()] == ["2024-01-01"]


def test_an_unfinished_report_is_not_cached(spark, tmpdir_spark):
    from tidemark.operators import tables as K
    df = spark.createDataFrame([("2024-01-01", 1)], "date string, sessions int")
    path = K.cache_report(df, tmpdir_spark, ["date"], ["sessions"], "2024-01-01", "2024-01-02")
    K._delete(spark, f"{path}/_SUCCESS")
    K.cache_report(df.union(df), tmpdir_spark, ["date"], ["sessions"], "2024-01-01", "2024-01-02")
    assert spark.read.parquet(path).count() == 2
    K.cache_report(df, tmpdir_spark, ["date"], ["sessions"], "2024-01-01", "2024-01-02")
    assert spark.read.parquet(path).count() == 2


def test_reports_with_short_rows_and_repeated_or_reordered_headers(spark, tmpdir_spark):
    import json
    from tidemark.plans import ingest as I
    from tidemark.sources import landed as L
    names = lambda *ns: [{"name": n} for n in ns]
    row = lambda d, m: {"dimension_values": [{"value": x} for x in d], "metric_values": [{"value": x} for x in m]}
    pages = [{"dimension_headers": names("date"), "metric_headers": names("sessions", "totalUsers", "sessions", "screenPageViews"),
              "rows": [row(["20240101"], ["5", "3", "99", "7"]), row(["20240102"], ["6"]), row([], []), row(["2024010x"], ["n/a", "1", "1", "1"])]},
             {"dimension_headers": names("date"), "metric_headers": names("screenPageViews", "totalUsers"), "rows": [row(["20231231"], ["8", "4"])]}]
    spark.createDataFrame([(json.dumps(p),) for p in pages], "value string").write.text(f"{tmpdir_spark}/r")
    got = {str(r.date): (r.sessions, r.users, r.pageviews) for r in I.report_batch(spark, f"{tmpdir_spark}/r", I.SESSIONS).collect() if r.date}
    assert got == {"2024-01-01": (5, 3, 7), "2024-01-02": (6, None, None), "2023-12-31": (None, 4, 8)}
    rejects = {r.reason: r.rows for r in I.report_rejects(spark, f"{tmpdir_spark}/r", I.SESSIONS, "2024-01-01", "2024-01-31").collect()}
    assert rejects == {"bad_date": 2, "out_of_window": 1, "bad_number": 1}
    video = {"columnHeaders": names("day", "views", "views"), "rows": [["2024-01-01", "4", "9"], ["2024-01-02"]]}
    spark.createDataFrame([(json.dumps(video),)], "value string").write.text(f"{tmpdir_spark}/v")
    assert sorted(map(tuple, L.read_video_report(spark, f"{tmpdir_spark}/v", ("day", "views")).collect())) == [("2024-01-01", "4"), ("2024-01-02", None)]


def test_an_export_in_parts_of_different_encodings(spark, tmp_path):
    from tidemark.sources import exports as X
    (tmp_path / "a.csv").write_bytes("name,n\ncaf\u00e9,1\n".encode("utf-8-sig"))
    (tmp_path / "b.csv").write_bytes("name,n\nni\u00f1o,2\n".encode("latin-1"))
    assert sorted(tuple(r) for r in X.read_csv_robust(spark, str(tmp_path)).select("name", "n").collect()) == [("caf\u00e9", "1"), ("ni\u00f1o", "2")]


def test_an_upsert_by_buckets_rewrites_only_touched_ones(spark, tmpdir_spark):
    import pathlib
    path = f"{tmpdir_spark}/dim_page"
    files = lambda: {str(p.relative_to(_local(path))) for p in pathlib.Path(_local(path)).rglob("*.parquet")}
    titles = lambda: dict(map(tuple, StoredWarehouse(spark, str(tmpdir_spark)).table("dim_page").collect()))
    rows = [(f"/p/{i}", f"old {i}") for i in range(200)]
    frame = lambda r: spark.createDataFrame(r, "page_path string, page_title string")
    K.upsert_table(spark, frame(rows), path, "dim_page", "page_path")        # plain: small
    assert not any("bucket" in f for f in files())
    K.upsert_table(spark, frame([("/p/0", "new 0")]), path, "dim_page", "page_path", 16)   # laid out once
    before = files()
    assert len({f.split("/")[0] for f in before}) == 16
    K.upsert_table(spark, frame([("/p/7", "new 7"), ("/p/new", "n"), (None, "x")]), path, "dim_page", "page_path")  # keeps its buckets
    after = files()
    changed = {f.split("/")[0] for f in before ^ after}
    assert 1 <= len(changed) <= 3 and len({f.split("/")[0] for f in after}) == 16
    assert titles() == {**dict(rows), "/p/0": "new 0", "/p/7": "new 7", "/p/new": "n", None: "x"}
    K.upsert_table(spark, frame([]), path, "dim_page", "page_path")
    assert files() == after
    K.upsert_table(spark, frame([("/p/1", "new 1")]), path, "dim_page", "page_path", 4)    # another number: laid out again
    assert len({f.split("/")[0] for f in files()}) == 4 and titles()["/p/1"] == "new 1" and len(titles()) == 202


def test_file_encodings(spark, tmp_path):
    text = "Título,n\ncafé,1\n\nniño,2\n"
    given = {"a b%20.csv": ("utf-8", text), "latin.csv": ("latin-1", text), "wide.csv": ("utf-16-le", text), "mark.csv": ("utf-16", text),
             "mark8.csv": ("utf-8-sig", text), "odd.csv": ("utf-8", "n\n�\n"), "nul.csv": ("utf-8", "n\na\x00b\nc\n"), "none.csv": ("utf-8", "")}
    for name, (encoding, body) in given.items():
        (tmp_path / name).write_bytes(body.encode(encoding))
    found = {f.rsplit("/", 1)[1]: e for f, e in X.file_encodings(spark, X.data_files(spark, str(tmp_path))).items()}
    assert found == {"a b%20.csv": "utf-8", "latin.csv": "latin-1", "wide.csv": "utf-16", "mark.csv": "utf-16", "mark8.csv": "utf-8",
                     "odd.csv": "utf-8", "nul.csv": "utf-8", "none.csv": "utf-8"}
    latin = str(tmp_path / "latin.csv")
    assert [tuple(r) for r in X.read_csv_robust(spark, latin).collect()] == [("café", "1"), ("niño", "2")]
    try:
        X.file_encodings(spark, X.data_files(spark, latin), ("utf-8",))
        raise AssertionError("a Latin-1 file read as UTF-8")
    except ValueError as e:
        assert "latin.csv" in str(e)


def test_quarantine_is_kept_per_landing(spark, tmpdir_spark):
    root = str(tmpdir_spark)
    report = lambda name, rows: L.land_report(spark.createDataFrame(rows, "date string, totalUsers string, sessions string, screenPageViews string"),
                                              f"{root}/{name}", I.SESSIONS.dimensions, I.SESSIONS.metrics)
    held = lambda: sorted(((r.reason, r.kept, json.loads(r.record).get("date")) for r in StoredWarehouse(spark, root).table("quarantine").collect()), key=str)
    run = lambda name: I.refresh_report(spark, f"{root}/{name}", f"{root}/fact_sessions", I.SESSIONS, "2024-01-01", "2024-01-03", root)
    report("one", [("20240101", "1", "1", "1"), ("20240102", "x", "1", "1"), ("2024-1-1", "1", "1", "1"), (None, "1", "1", "1"), ("20240109", "n", "1", "1")])
    one = [("bad_date", False, "2024-1-1"), ("bad_date", False, None), ("bad_number", True, "20240102"), ("out_of_window", False, "20240109")]
    run("one")
    run("one")
    assert held() == sorted(one, key=str)
    assert spark.read.parquet(f"{root}/fact_sessions").count() == 2
    report("two", [("20250101", "1", "1", "1")])
    run("two")  # brings no row of the window: the table stays
    assert spark.read.parquet(f"{root}/fact_sessions").count() == 2
    assert held() == sorted([*one, ("out_of_window", False, "20250101")], key=str)
    report("one", [("20240101", "1", "1", "1")])
    run("one")  # landed again, without faults: its rejects go
    assert held() == [("out_of_window", False, "20250101")]


def test_metadata_response(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"dimensions": [{"apiName": "date", "uiName": "Date"}, {"apiName": "date"}, {"apiName": ""}, {}],
                                                 "metrics": None}) + "\n" + json.dumps({"metrics": [{"apiName": "sessions", "description": "d"}]}) + "\n")
    rows = sorted(tuple(r) for r in L.read_metadata(spark, str(tmp_path)).select("type", "name").collect())
    assert rows == [("dimension", "date"), ("metric", "sessions")]
