"""Column helpers against Python's own date/number rules."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions import columns as C


def _days(start, n):
    return [start + dt.timedelta(days=i) for i in range(n)]


def test_week_w_matches_c_percent_w_2015_2030(spark):
    days = _days(dt.date(2015, 1, 1), (dt.date(2031, 1, 1) - dt.date(2015, 1, 1)).days)
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = {r.d: (r.yw, r.wd) for r in df.select("d", C.year_week_w("d").alias("yw"),
                                                   C.weekday_w("d").alias("wd")).collect()}
    for d in days:
        assert got[d] == (d.strftime("%Y-%W"), d.strftime("%w")), d


def test_year_boundary_week_zero(spark):
    df = spark.createDataFrame([(dt.date(2023, 1, 1),), (dt.date(2023, 1, 2),)], "d date")
    assert [r[0] for r in df.select(C.year_week_w("d")).collect()] == ["2023-00", "2023-01"]


def test_ymd_date_and_safe_casts(spark):
    df = spark.createDataFrame([("20240105", "12.7", "3"), ("20240230", "x", None), ("", "1e3", "-2.9")],
                               "d string, a string, b string")
    rows = df.select(C.ymd_date("d").alias("d"), C.safe_long("a").alias("a"), C.safe_long("b").alias("b"),
                     C.safe_double("a").alias("ad")).collect()
    assert rows[0].d == dt.date(2024, 1, 5) and rows[0].a == 12 and rows[0].b == 3
    assert rows[1].d is None and rows[1].a is None and rows[1].b is None
    assert rows[2].d is None and rows[2].a == 1000 and rows[2].b == -2 and rows[2].ad == 1000.0


def test_pct_change_zero_rules(spark):
    df = spark.createDataFrame([(0.0, 0.0), (5.0, 0.0), (15.0, 10.0), (5.0, 10.0)], "c double, p double")
    got = [r[0] for r in df.select(C.pct_change("c", "p")).collect()]
    assert got == [0.0, 100.0, 50.0, -50.0]


def test_first_truthy_skips_empty_and_zero(spark):
    df = spark.createDataFrame([("", None, "b"), (None, "a", "c"), ("", "", "")], "x string, y string, z string")
    assert [r[0] for r in df.select(C.first_truthy("x", "y", "z")).collect()] == ["b", "a", None]
    n = spark.createDataFrame([(0, 5), (3, 4), (0, 0)], "a bigint, b bigint")
    assert [r[0] for r in n.select(C.first_truthy("a", "b", numeric=True)).collect()] == [5, 3, None]


def test_thousands_dot_truncates(spark):
    df = spark.createDataFrame([(1234567.9,), (0.0,), (None,), (999.0,), (-1234.5,)], "v double")
    assert [r[0] for r in df.select(C.thousands_dot("v")).collect()] == ["1.234.567", "0", "0", "999", "-1.234"]


def test_total_row_and_norm_key(spark):
    df = spark.createDataFrame([(" Total Geral ",), ("TOTAL",), ("Totals",), (None,)], "t string")
    assert [r[0] for r in df.select(C.is_total_row("t")).collect()] == [True, True, False, None]
    assert df.select(C.norm_key(F.lit("  Email "))).first()[0] == "email"
