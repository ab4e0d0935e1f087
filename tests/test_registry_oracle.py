"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import datetime as dt
import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from tidemark.plans import registry

SF_SMALL = "/root/testdata/sf0.001"

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(cols), Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(registry.oracle_sql())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_oracle(spark, con, name):
    df = registry.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(registry.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert _bag(df.columns, srows) == _bag(ocols, cur.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["page_title", "pageviews", "cum_share"]
    assert df.count() >= 0


@pytest.mark.parametrize("name", ["fact_sessions", "pages_pareto_all", "fact_comms_impact_summary", "weekly_report"])
def test_results_do_not_depend_on_session_settings(spark, con, name):
    keys = ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")
    saved = {k: spark.conf.get(k) for k in keys}
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "37")
        df = registry.queries()[name](spark, SF_SMALL)
        rows = [tuple(r) for r in df.collect()]
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    cur = con.execute(registry.oracle_sql()[name])
    assert _bag(df.columns, rows) == _bag([d[0] for d in cur.description], cur.fetchall())
