"""Landed API responses: readers that flatten them, and writers that produce them.

Pulls are not made from Spark; their responses are landed as JSON lines (one response page
per line) and read here with fixed schemas, in parallel over files:

* analytics report (headers + positional dimension/metric value arrays, values as text);
* video report (column headers + rows of mixed values);
* CRM records (bare lists or objects with ``items`` / ``contacts`` / ``campaigns``).

Values are mapped to names through each page's own headers: a name's place in the headers is its
place in the row. Pages whose header order differs still land in the right columns, a repeated
header counts where it stands first, and a row shorter than its headers gives NULL for
what it lacks. Bad numbers and dates become NULL (``try_cast``, ``try_to_date``) instead of failing the job.

The writers build such files from warehouse-shaped DataFrames (fixtures, replays): Spark serialises
the rows and groups them into pages of at most ``page_size`` rows of one partition, so no
page grows with the data.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import columns as C

_NAME = T.StructType([T.StructField("name", T.StringType())])
_VALUE = T.StructType([T.StructField("value", T.StringType())])

REPORT_SCHEMA = T.StructType([
    T.StructField("dimension_headers", T.ArrayType(_NAME)),
    T.StructField("metric_headers", T.ArrayType(_NAME)),
    T.StructField("rows", T.ArrayType(T.StructType([
        T.StructField("dimension_values", T.ArrayType(_VALUE)),
        T.StructField("metric_values", T.ArrayType(_VALUE)),
    ]))),
])

VIDEO_REPORT_SCHEMA = T.StructType([
    T.StructField("columnHeaders", T.ArrayType(_NAME)),
    T.StructField("rows", T.ArrayType(T.ArrayType(T.StringType()))),
])

PAGE_SIZE = 100_000  # fixed value: rows per analytics report page


# --- readers -------------------------------------------------------------------------------

def value_of(name: str, headers: str, values) -> F.Column:
    """The value that stands where ``headers`` names ``name``; NULL if either has no such place."""
    place = F.coalesce(F.array_position(headers, name), F.lit(0)).cast("int")
    return F.get(values, place - 1)


def read_report_text(spark: SparkSession, path: str, dimensions: Sequence[str], metrics: Sequence[str],
                     file_column: str | None = None) -> DataFrame:
    """Analytics report → one text column per requested dimension and metric, as landed, and the file that a row stands in
    as ``file_column`` if asked."""
    pages = spark.read.schema(REPORT_SCHEMA).json(path)
    rows = pages.select(F.col("dimension_headers.name").alias("dh"), F.col("metric_headers.name").alias("mh"),
                        F.explode("rows").alias("r"), *([F.col("_metadata.file_path").alias("file")] if file_column else []))
    return rows.select(*[value_of(d, "dh", F.col("r.dimension_values.value")).alias(d) for d in dimensions],
                       *[value_of(m, "mh", F.col("r.metric_values.value")).alias(m) for m in metrics],
                       *([F.col("file").alias(file_column)] if file_column else []))


def read_report(spark: SparkSession, path: str, dimensions: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """S3: analytics report → one column per requested dimension (text) and metric (DOUBLE,
    NULL when not a number). Names absent from a page's headers give NULL."""
    raw = read_report_text(spark, path, dimensions, metrics)
    return raw.select(*dimensions, *[C.safe_double(m).alias(m) for m in metrics])


_FIELD = T.StructType([T.StructField("apiName", T.StringType()), T.StructField("description", T.StringType())])
METADATA_SCHEMA = T.StructType([T.StructField("dimensions", T.ArrayType(_FIELD)), T.StructField("metrics", T.ArrayType(_FIELD))])


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Metadata response → (type, name, description): the dimensions and metrics that a request may name. Pages may hold
    either list or both; a name without text, or one given twice, counts once or not at all."""
    pages = spark.read.schema(METADATA_SCHEMA).json(path)
    kind = lambda name: F.transform(F.coalesce(name, F.array().cast(METADATA_SCHEMA[name].dataType)),
                                    lambda x: F.struct(F.lit(name[:-1]).alias("type"), x.apiName.alias("name"), x.description.alias("description")))
    rows = pages.select(F.explode(F.concat(kind("dimensions"), kind("metrics"))).alias("x")).select("x.*")
    return rows.where(F.length("name") > 0).groupBy("type", "name").agg(F.max("description").alias("description"))


def read_video_report(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Video report → the requested columns as text (cast by the caller)."""
    pages = spark.read.schema(VIDEO_REPORT_SCHEMA).json(path)
    rows = pages.select(F.col("columnHeaders.name").alias("h"), F.explode("rows").alias("r"))
    return rows.select(*[value_of(c, "h", F.col("r")).alias(c) for c in columns])


def _record_schema(fields: Sequence[str], wrappers: Sequence[str]) -> T.StructType:
    rec = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    return T.StructType(list(rec.fields) + [T.StructField(w, T.ArrayType(rec)) for w in wrappers])


def read_records(spark: SparkSession, path: str, fields: Sequence[str], wrappers: Sequence[str]) -> DataFrame:
    """CRM records. A line is a bare JSON list (Spark makes one row per element) or an
    object whose ``wrappers`` key holds the list; both shapes give one row per record."""
    raw = spark.read.schema(_record_schema(fields, wrappers)).json(path)
    if not wrappers:
        return raw.select(*fields)
    wrapped = F.coalesce(*[F.col(w) for w in wrappers])
    bare = raw.where(wrapped.isNull()).select(*fields)
    inner = raw.where(wrapped.isNotNull()).select(F.explode(wrapped).alias("x")).select(
        *[F.col(f"x.{f}").alias(f) for f in fields])
    return bare.unionByName(inner)


# Alternative keys of CRM records, in order of preference.
CONTACT_FIELDS = ("id", "updated_at", "lifecycle_stage", "funnel_stage", "status")
CONTACT_WRAPPERS = ("items", "contacts")
CAMPAIGN_FIELDS = ("id", "campaignId", "uuid", "send_datetime", "sent_at", "scheduled_at", "created_at")
CAMPAIGN_WRAPPERS = ("items", "campaigns")
METRIC_FIELDS = ("campaign_id", "sends", "delivered", "sent", "opens", "unique_opens", "clicks", "unique_clicks")


def read_contacts(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """Contacts updated in [start, end] (by the first 10 characters of ``updated_at``)."""
    c = read_records(spark, path, CONTACT_FIELDS, CONTACT_WRAPPERS)
    day = C.iso_prefix_date("updated_at")
    if start is not None:
        c = c.where(day >= C.date_lit(start))
    if end is not None:
        c = c.where(day <= C.date_lit(end))
    return c


def read_campaigns(spark: SparkSession, path: str) -> DataFrame:
    """E-mail campaign records (id and send time under alternative keys)."""
    return read_records(spark, path, CAMPAIGN_FIELDS, CAMPAIGN_WRAPPERS)


def read_campaign_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Per-campaign metrics, first non-zero of the alternative keys, 0 when absent."""
    m = read_records(spark, path, METRIC_FIELDS, ())
    n = lambda c: C.safe_long(c)
    return m.select(
        F.col("campaign_id").alias("campaignId"),
        F.coalesce(C.first_truthy(n("sends"), n("delivered"), n("sent"), numeric=True), F.lit(0)).alias("sends"),
        F.coalesce(C.first_truthy(n("opens"), n("unique_opens"), numeric=True), F.lit(0)).alias("opens"),
        F.coalesce(C.first_truthy(n("clicks"), n("unique_clicks"), numeric=True), F.lit(0)).alias("clicks"))


# --- writers (landing) -----------------------------------------------------------------------

def _page_lines(rows_json: DataFrame, prefix: str, suffix: str, page_size: int,
                group_cols: Sequence[str] = ()) -> DataFrame:
    """Join per-row JSON texts (column ``j``) into page lines ``prefix + j1,j2,… + suffix``.

    A row's number inside its partition, divided by ``page_size``, is its page; rows of one
    partition, page and group value are one line. No page is larger than ``page_size``.
    """
    gcols = list(group_cols)
    numbered = rows_json.withColumn("_n", F.monotonically_increasing_id())  # partition << 33 | row
    part, page = F.shiftright("_n", 33), F.floor(F.col("_n").bitwiseAND(F.lit((1 << 33) - 1)) / F.lit(page_size))
    lines = numbered.groupBy(*gcols, part.alias("_part"), page.alias("_page")).agg(
        F.array_join(F.collect_list("j"), ",").alias("_rows"))
    return lines.select(*gcols, F.concat(F.lit(prefix), "_rows", F.lit(suffix)).alias("value"))


def _write_lines(lines: DataFrame, path: str, group_cols: Sequence[str] = ()) -> None:
    w = lines.write.mode("overwrite")
    if group_cols:
        w = w.partitionBy(*group_cols)
    w.text(path)


def land_report(df: DataFrame, path: str, dimensions: Sequence[str], metrics: Sequence[str],
                page_size: int = PAGE_SIZE) -> None:
    """Write ``df`` as analytics-report pages: dimension values as text, metrics as numeric
    text, dates as 'yyyyMMdd'. One JSON line per page of at most ``page_size`` rows."""
    def as_text(c: str):
        f = df.schema[c]
        if isinstance(f.dataType, T.DateType):
            return F.date_format(F.col(c), "yyyyMMdd")
        return F.col(c).cast("string")

    row = F.struct(
        F.array(*[F.struct(as_text(d).alias("value")) for d in dimensions]).alias("dimension_values"),
        F.array(*[F.struct(F.col(m).cast("string").alias("value")) for m in metrics]).alias("metric_values"))
    headers = json.dumps({"dimension_headers": [{"name": d} for d in dimensions],
                          "metric_headers": [{"name": m} for m in metrics]})
    prefix = headers[:-1] + ', "rows": ['
    _write_lines(_page_lines(df.select(F.to_json(row).alias("j")), prefix, "]}", page_size), path)


def land_video_report(df: DataFrame, path: str, columns: Sequence[str], group_cols: Sequence[str] = (),
                      page_size: int = PAGE_SIZE) -> None:
    """Write ``df`` as video-report pages; with ``group_cols`` (e.g. a period) one folder per
    group value and pages never mix groups."""
    def as_text(c: str):
        f = df.schema[c]
        if isinstance(f.dataType, T.DateType):
            return F.date_format(F.col(c), "yyyy-MM-dd")
        return F.col(c).cast("string")

    rows = df.select(*group_cols, F.to_json(F.array(*[as_text(c) for c in columns])).alias("j"))
    prefix = json.dumps({"columnHeaders": [{"name": c} for c in columns]})[:-1] + ', "rows": ['
    _write_lines(_page_lines(rows, prefix, "]}", page_size, group_cols), path, group_cols)


def land_metadata(df: DataFrame, path: str, page_size: int = 1000) -> None:
    """Write (type, name, description) rows as a metadata response, ``dimensions`` and ``metrics`` in pages of their own."""
    for kind in ("dimension", "metric"):
        rows = df.where(F.col("type") == kind).select(F.to_json(F.struct(F.col("name").alias("apiName"), "description")).alias("j"))
        _write_lines(_page_lines(rows, f'{{"{kind}s": [', "]}", page_size), f"{path}/{kind}s")


def land_records(df: DataFrame, path: str, wrapper: str | None = None, page_size: int = 100) -> None:
    """Write records as JSON lines of pages: a bare list when ``wrapper`` is None, else an
    object ``{wrapper: [...]}``. Page size is the CRM's (100 records)."""
    rows = df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("j"))
    prefix, suffix = ("[", "]") if wrapper is None else ("{" + json.dumps(wrapper) + ": [", "]}")
    _write_lines(_page_lines(rows, prefix, suffix, page_size), path)
