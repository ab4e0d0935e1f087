"""Data-quality operators: freshness, day-over-day volume, declared checks, field catalog.

All results are DataFrames (one small aggregate per table, unioned), so a whole check run
is one Spark job and nothing is counted on the driver.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.schemas import REGISTRY, TABLES, TABLE_SOURCE
from tidemark.sources.warehouse import Warehouse

DROP_ALERT_PCT = -40.0  # fixed value: day-over-day drop that raises an alert

# Freshness signals (label, table) and the declared TTL per table in minutes.
FRESHNESS_SIGNALS = (
    ("fact_sessions", "fact_sessions"),
    ("ga4_pages_daily", "fact_ga4_pages_daily"),
    ("ga4_events_daily", "fact_ga4_events_daily"),
    ("yt_video_daily", "fact_yt_channel_daily"),
    ("ga4_utm_daily", "fact_ga4_sessions_by_utm_daily"),
    ("rd_email_campaign", "fact_rd_email_campaign"),
)
DEFAULT_TTL_MINUTES = 60


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# D1 (+ Q20)
def _today(as_of):
    return C.as_date(as_of) if as_of is not None else _dt.date.today()


def freshness(w: Warehouse, as_of=None, end=None, registry=REGISTRY) -> DataFrame:
    """Latest date per fact, lag in days to ``as_of``, declared TTL and stale flag.

    ``partial_day`` tells whether the report range ends on ``as_of`` (today's data may be
    incomplete). Video freshness is read from the channel-day table (the per-video daily
    table is never produced). A missing table yields a NULL date and counts as stale. Dates are whole days: a TTL
    below a day asks for data of ``as_of`` itself.
    """
    ttl = {d.table: d.freshness_ttl_minutes for d in registry}
    as_of_d = _today(as_of)
    end_d = C.as_date(end) if end is not None else as_of_d
    parts = []
    for label, table in FRESHNESS_SIGNALS:
        if w.has(table):
            latest = w.latest_date(table)
        else:
            latest = w.spark.range(1).select(F.lit(None).cast("date").alias("latest_date"))
        parts.append(latest.select(F.lit(label).alias("name"), F.lit(table).alias("table_name"), "latest_date",
                                   F.lit(ttl.get(table, DEFAULT_TTL_MINUTES)).cast("bigint").alias("ttl_minutes")))
    lag = F.datediff(F.lit(as_of_d), F.col("latest_date")).cast("bigint")
    return _union(parts).select(
        "name", "table_name", "latest_date", lag.alias("lag_days"), "ttl_minutes",
        (F.col("latest_date").isNull() | (lag * 1440 > F.col("ttl_minutes"))).alias("stale"),
        F.lit(end_d == as_of_d).alias("partial_day"))


# D2
def volumetry_series(w: Warehouse) -> DataFrame:
    """Per day: sessions, minutes and their % change against the previous day present.

    The window runs over one row per day (the engagement mart is reduced to days first), so
    its single partition is bounded by the calendar span, not by the event volume.
    """
    e = (w.table("fact_engagement_daily").groupBy("date")
           .agg(F.sum(F.coalesce("sessions", F.lit(0))).alias("sessions"),
                F.sum(F.coalesce("estimatedMinutesWatched", F.lit(0))).alias("minutes")))
    o = Window.orderBy("date")
    e = e.withColumn("ses_prev", F.lag("sessions").over(o)).withColumn("min_prev", F.lag("minutes").over(o))

    def dod(cur, prev):
        return (F.when(F.col(prev).isNull() | (F.col(prev) == 0), F.lit(0.0))
                 .otherwise((F.col(cur) - F.col(prev)).cast("double") * F.lit(100.0) / F.col(prev).cast("double")))

    return e.select("date", F.col("sessions").cast("bigint").alias("sessions"),
                    F.col("minutes").cast("bigint").alias("minutes"),
                    dod("sessions", "ses_prev").alias("ses_dod_pct"),
                    dod("minutes", "min_prev").alias("min_dod_pct"))


def volumetry_dod(w: Warehouse) -> DataFrame:
    """The latest day of the series."""
    return volumetry_series(w).orderBy(F.col("date").desc_nulls_last()).limit(1) \
        .select("date", "ses_dod_pct", "min_dod_pct")


# D2b
def volumetry_drops(w: Warehouse, threshold: float = DROP_ALERT_PCT) -> DataFrame:
    s = volumetry_series(w)
    return s.where((F.col("ses_dod_pct") < threshold) | (F.col("min_dod_pct") < threshold)) \
            .select("date", "ses_dod_pct", "min_dod_pct")


# Q19
def quality_signals(w: Warehouse, as_of=None) -> DataFrame:
    """Freshness of six facts plus the latest day-over-day changes, as typed rows
    (signal, name, date, value)."""
    fr = freshness(w, as_of).select(F.lit("freshness").alias("signal"), "name",
                                    F.col("latest_date").alias("date"), F.lit(None).cast("double").alias("value"))
    v = volumetry_dod(w)
    vol = v.select(F.lit("volumetry").alias("signal"),
                   F.expr("stack(2, 'ses_dod_pct', ses_dod_pct, 'min_dod_pct', min_dod_pct) as (name, value)"),
                   "date")
    return fr.unionByName(vol.select("signal", "name", "date", "value"))


# D3
def _from_profile(w: Warehouse, rows: list[tuple], names: str, kind: str) -> DataFrame:
    """The stored profile's sums beside ``rows``, whose first two columns are a table and a column or key."""
    sums = (w.profile().where(F.col("kind") == kind).groupBy(F.col("dataset").alias("_t"), F.col("name").alias("_c"))
             .agg(*[F.sum(c).alias(c) for c in ("rows", "nulls", "duplicate_keys", "duplicate_rows")]))
    asked = w.spark.createDataFrame(rows, f"_t string, _c string, {names}")
    # few declared names against days × columns summed to columns: both sides are bounded by the schema
    return asked.join(sums, ["_t", "_c"], "left").na.fill(0, ["rows", "nulls", "duplicate_keys", "duplicate_rows"])


def check_not_null(w: Warehouse, registry=REGISTRY) -> DataFrame:
    """NULL count per column declared not-null in the registry: from the stored profile, else one aggregate per table."""
    held = [d for d in registry if d.not_null and w.has(d.table)]
    if w.profile() is not None:
        out = _from_profile(w, [(d.table, c, d.id, c) for d in held for c in d.not_null],
                            "dataset string, column_name string", "column")
    else:
        parts = []
        for d in held:
            agg = w.table(d.table).agg(F.count(F.lit(1)).alias("rows"),
                                       *[F.count_if(F.col(c).isNull()).alias(f"n__{c}") for c in d.not_null])
            args = ", ".join(f"'{c}', n__{c}" for c in d.not_null)
            parts.append(agg.select(F.lit(d.id).alias("dataset"), "rows",
                                    F.expr(f"stack({len(d.not_null)}, {args}) as (column_name, nulls)")))
        out = _union(parts or [w.spark.createDataFrame([], "dataset string, rows bigint, column_name string, nulls bigint")])
    return out.select("dataset", "column_name", F.col("nulls").cast("bigint").alias("nulls"),
                      F.col("rows").cast("bigint").alias("rows"), (F.col("nulls") > 0).alias("violated"))


# D4
def check_unique(w: Warehouse, registry=REGISTRY) -> DataFrame:
    """Keys declared unique that occur more than once: distinct duplicated keys and rows, from the stored profile if it
    keeps the key (one that holds the table's date), else by an aggregate of the table."""
    from tidemark.plans.profile import unique_keys
    held = [d for d in registry if d.unique and w.has(d.table)]
    kept = [d for d in held if w.profile() is not None and d.unique in unique_keys(d.table)]
    parts = []
    if kept:
        parts.append(_from_profile(w, [(d.table, ",".join(d.unique), d.id, ",".join(d.unique)) for d in kept],
                                   "dataset string, key_columns string", "key")
                     .select("dataset", "key_columns", "duplicate_keys", "duplicate_rows"))
    for d in held:
        if d in kept:
            continue
        dup = (w.table(d.table).groupBy(*d.unique).agg(F.count(F.lit(1)).alias("n"))
                .where(F.col("n") > 1))
        parts.append(dup.agg(F.count(F.lit(1)).alias("duplicate_keys"),
                             F.coalesce(F.sum("n"), F.lit(0)).alias("duplicate_rows"))
                        .select(F.lit(d.id).alias("dataset"), F.lit(",".join(d.unique)).alias("key_columns"),
                                "duplicate_keys", "duplicate_rows"))
    out = _union(parts or [w.spark.createDataFrame(
        [], "dataset string, key_columns string, duplicate_keys bigint, duplicate_rows bigint")])
    return out.select("dataset", "key_columns", F.col("duplicate_keys").cast("bigint").alias("duplicate_keys"),
                      F.col("duplicate_rows").cast("bigint").alias("duplicate_rows"),
                      (F.col("duplicate_keys") > 0).alias("violated"))


# M10
CATALOG_TABLES = tuple(t for t in TABLES if t in TABLE_SOURCE)


def datasets_catalog(w: Warehouse, tables=CATALOG_TABLES, metadata: DataFrame | None = None) -> DataFrame:
    """Field catalog as a column profile: (source, dataset, type, name, description, rows, nulls).

    Every source and mart table of the schema is listed. Column rows carry 'name:TYPE', the row
    count and the NULL count of the column (from the stored profile, else one aggregate per table, unpivoted with
    ``stack``); the columns of a table that this warehouse doesn't hold are planned fields, without counts. ``metadata``
    (``landed.read_metadata``) adds the names of the analytics source's dimensions and metrics.
    """
    parts, planned_fields, profiled = [], [], []
    for t in tables:
        if not w.has(t):
            planned_fields += [(TABLE_SOURCE.get(t, ""), t, "planned_field", f.name, "planned") for f in TABLES[t].fields]
            continue
        if w.profile() is not None:
            profiled += [(t, f.name, TABLE_SOURCE.get(t, ""), t, f"{f.name}:{C.column_type_name(f.dataType)}") for f in TABLES[t].fields]
            continue
        df = w.table(t)
        fields = df.schema.fields
        agg = df.agg(F.count(F.lit(1)).alias("rows"),
                     *[F.count_if(F.col(f.name).isNull()).alias(f"n{i}") for i, f in enumerate(fields)])
        args = ", ".join(f"'{f.name}:{C.column_type_name(f.dataType)}', n{i}" for i, f in enumerate(fields))
        parts.append(agg.select(F.lit(TABLE_SOURCE.get(t, "")).alias("source"), F.lit(t).alias("dataset"),
                                F.lit("column").alias("type"),
                                F.expr(f"stack({len(fields)}, {args}) as (name, nulls)"),
                                F.lit("").alias("description"), F.col("rows").cast("bigint").alias("rows")))
    if profiled:
        parts.append(_from_profile(w, profiled, "source string, dataset string, name string", "column").select(
            "source", "dataset", F.lit("column").alias("type"), "name", "nulls", F.lit("").alias("description"), "rows"))
    planned = w.spark.createDataFrame(
        planned_fields, "source string, dataset string, type string, name string, description string")
    planned = planned.select("*", F.lit(None).cast("bigint").alias("rows"), F.lit(None).cast("bigint").alias("nulls"))
    out = _union(parts).select("source", "dataset", "type", "name", "description", "rows",
                               F.col("nulls").cast("bigint").alias("nulls"))
    out = out.unionByName(planned)
    if metadata is not None:
        none = F.lit(None).cast("bigint")
        out = out.unionByName(metadata.select(F.lit("GA4").alias("source"), F.lit("ga4_metadata").alias("dataset"), "type", "name",
                                              F.lit("").alias("description"), none.alias("rows"), none.alias("nulls")))
    return out


# D5
def invalid_fields(w: Warehouse, requests: list[tuple[str, str, str]], metadata: DataFrame | None = None) -> DataFrame:
    """Requested (dataset, kind, field) that the table does not hold with any non-NULL value.

    Checked with a left-anti join against the column profile of the same tables; with ``metadata``
    (``landed.read_metadata``) against the names that the source knows, whatever the tables hold. A source whose
    metadata are empty judges nothing.
    """
    req = w.spark.createDataFrame(requests, "dataset string, kind string, field string")
    if metadata is not None:
        known = metadata.select(F.col("type").alias("kind"), F.col("name").alias("field"))
        return req.join(known, ["kind", "field"], "left_anti").where(known.exists()).select("dataset", "kind", "field")
    tables = tuple(sorted({r[0] for r in requests}))
    prof = (datasets_catalog(w, tables).where(F.col("type") == "column")
            .where(F.col("rows") > F.col("nulls"))
            .select("dataset", F.substring_index("name", ":", 1).alias("field")))
    return req.join(prof, ["dataset", "field"], "left_anti").select("dataset", "kind", "field")


def report_requests() -> list[tuple[str, str, str]]:
    """(dataset, kind, field) of every name that the analytics pulls ask for."""
    from tidemark.plans.ingest import REPORTS
    return [(t, kind, name) for t, s in REPORTS.items() for kind, names in (("dimension", s.dimensions), ("metric", s.metrics))
            for name in names]


def registry_requests(registry=REGISTRY) -> list[tuple[str, str, str]]:
    out = []
    for d in registry:
        out += [(d.table, "dimension", c) for c in d.dimensions]
        out += [(d.table, "metric", c) for c in d.metrics]
    # The session pull's source-side names, checked against the renamed table.
    out += [("fact_sessions", "dimension", "date"), ("fact_sessions", "metric", "totalUsers"),
            ("fact_sessions", "metric", "sessions"), ("fact_sessions", "metric", "screenPageViews")]
    return out


# D6
# The 3 × 3 candidate matrix.
MATRIX_DIMENSIONS = ("date", "pagePath", "pageTitle")
MATRIX_METRICS = ("totalUsers", "sessions", "screenPageViews")


def field_matrix(w: Warehouse, end, days: int = 7, table: str = "fact_ga4_pages_daily") -> DataFrame:
    """Rows a one-dimension, one-metric report would return over the last ``days`` days,
    for every (dimension, metric) pair: distinct dimension values with a non-NULL metric."""
    end_d = C.as_date(end)
    f = w.fact(table, end_d - _dt.timedelta(days=days), end_d)
    dims_args = ", ".join(f"'{d}', CAST({d} AS STRING)" for d in MATRIX_DIMENSIONS)
    long = f.select(F.expr(f"stack({len(MATRIX_DIMENSIONS)}, {dims_args}) as (dimension, dim_value)"),
                    *[F.col(m).isNotNull().cast("int").alias(m) for m in MATRIX_METRICS])
    per_value = long.groupBy("dimension", "dim_value").agg(*[F.max(m).alias(m) for m in MATRIX_METRICS])
    per_dim = per_value.groupBy("dimension").agg(*[F.sum(m).alias(m) for m in MATRIX_METRICS])
    met_args = ", ".join(f"'{m}', {m}" for m in MATRIX_METRICS)
    counts = per_dim.select("dimension", F.expr(f"stack({len(MATRIX_METRICS)}, {met_args}) as (metric, n)"))
    # every candidate pair appears, with 0 rows when the window holds nothing for it
    grid = w.spark.createDataFrame([(d, m) for d in MATRIX_DIMENSIONS for m in MATRIX_METRICS],
                                   "dimension string, metric string")
    return (grid.join(counts, ["dimension", "metric"], "left")
                .select("dimension", "metric", F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("rows")))


# D7
def quality_alerts(w: Warehouse, as_of=None, threshold: float = DROP_ALERT_PCT, registry=REGISTRY) -> DataFrame:
    """(check, target, value, breached) rows from freshness, volume drop, not-null and unique."""
    fr = freshness(w, as_of, registry=registry).select(F.lit("freshness").alias("check"), F.col("name").alias("target"),
                                    F.col("lag_days").cast("double").alias("value"), F.col("stale").alias("breached"))
    v = volumetry_dod(w)
    vol = v.select(F.expr("stack(2, 'sessions', ses_dod_pct, 'minutes', min_dod_pct) as (target, value)"))
    vol = vol.select(F.lit("volumetry_dod").alias("check"), "target", "value",
                     (F.col("value") < F.lit(threshold)).alias("breached"))
    nn = check_not_null(w, registry).select(F.lit("not_null").alias("check"),
                                  F.concat_ws(".", "dataset", "column_name").alias("target"),
                                  F.col("nulls").cast("double").alias("value"), F.col("violated").alias("breached"))
    un = check_unique(w, registry).select(F.lit("unique").alias("check"),
                                F.concat_ws(".", "dataset", "key_columns").alias("target"),
                                F.col("duplicate_keys").cast("double").alias("value"),
                                F.col("violated").alias("breached"))
    return _union([fr, vol, nn, un])


# Q20
def partial_day(w: Warehouse, end, as_of) -> DataFrame:
    """Whether the report range ends on ``as_of`` (partial data), with the latest data day."""
    latest = w.latest_date("fact_sessions")
    return latest.select(F.lit(C.as_date(end)).alias("end_date"), F.lit(C.as_date(as_of)).alias("as_of"),
                         "latest_date", F.lit(C.as_date(end) == C.as_date(as_of)).alias("is_partial"))
