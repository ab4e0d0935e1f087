"""Named warehouse tables behind one interface.

``DerivedWarehouse`` builds every fact lazily from the driver tables (the registered queries
use it, so their work grows with the data). ``StoredWarehouse`` reads tables written by the
refresh operators: Parquet partitioned by ``date``, so a window read is partition pruning.
Both hand out DataFrames only; nothing is collected.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.schemas import TABLES
from tidemark.sources import adapters as A

# Facts with one row group per day, derived from events of that day only: a window on
# ``date`` can be applied to the raw events instead (pushdown on ``ts``).
DAY_LOCAL_FACTS = {
    "fact_sessions": lambda w, ev: A.fact_sessions(ev),
    "fact_ga4_events_daily": lambda w, ev: A.fact_ga4_events_daily(ev),
    "fact_ga4_pages_daily": lambda w, ev: A.fact_ga4_pages_daily(ev, w.driver("pages")),
    "fact_sessions_by_country": lambda w, ev: A.fact_sessions_by_country(ev, w.driver("customer"),
                                                                         w.driver("nation")),
    "fact_ga4_sessions_by_utm_daily": lambda w, ev: A.fact_ga4_sessions_by_utm_daily(ev),
    "fact_yt_channel_daily": lambda w, ev: A.fact_yt_channel_daily(ev),
}

WHOLE_FACTS = {
    "fact_yt_video_period": lambda w: A.fact_yt_video_period(w.events()),
    "fact_rd_email_campaign": lambda w: A.fact_rd_email_campaign(w.events()),
    "map_utm_campaign": lambda w: A.map_utm_campaign(w.events()),
}


class Warehouse:
    spark: SparkSession

    def has(self, name: str) -> bool:
        raise NotImplementedError

    def table(self, name: str) -> DataFrame:
        raise NotImplementedError

    def fact(self, name: str, start=None, end=None) -> DataFrame:
        """Rows of a date-grain table in the inclusive window [start, end]."""
        df = self.table(name)
        if start is not None:
            df = df.where(F.col("date") >= C.date_lit(start))
        if end is not None:
            df = df.where(F.col("date") <= C.date_lit(end))
        return df

    def latest_date(self, name: str) -> DataFrame:
        """One row: the latest ``date`` of a table."""
        return self.table(name).agg(F.max("date").alias("latest_date"))

    def table_facts(self, name: str, count: bool, latest: bool) -> DataFrame:
        """One row of texts: the row ``count`` and the ``latest`` date of a table ('None' without one), as asked."""
        asked = [F.count(F.lit(1)).cast("string").alias("count")] if count else []
        asked += [F.coalesce(F.max("date").cast("string"), F.lit("None")).alias("latest")] if latest else []
        return self.table(name).agg(*asked)

    def profile(self) -> DataFrame | None:
        """The stored column profile (``plans.profile``), if this warehouse keeps one."""
        return None

    def report_totals(self, start, end, countries: bool) -> DataFrame:
        """The report's totals over [start, end] (see ``adapters.report_totals``), from the facts."""
        sums = lambda by_country, country, **given: [
            F.lit(by_country).alias("by_country"), country.cast("string").alias("country_id"),
            *[F.coalesce(given.get(c, F.lit(0)), F.lit(0)).cast("bigint").alias(c) for c in A.REPORT_SUMS]]
        none = F.lit(None)
        web = self.fact("fact_sessions", start, end).agg(*[F.sum(c).alias(c) for c in A.REPORT_SUMS[:3]])
        name, n = ("eventName", "eventCount") if self.has("fact_ga4_events_daily") else ("event_name", "event_count")
        video = self.fact("fact_ga4_events_daily" if name == "eventName" else "fact_events", start, end)
        video = video.where(F.col(name).isin("video_start", "video_progress")).agg(
            F.sum(F.when(F.col(name) == "video_start", F.col(n))).alias("start"),
            F.sum(F.when(F.col(name) == "video_progress", F.col(n))).alias("progress"))
        rows = web.select(*sums(False, none, **{c: F.col(c) for c in A.REPORT_SUMS[:3]})).unionByName(
            video.select(*sums(False, none, start=F.col("start"), progress=F.col("progress"))))
        if countries:
            c = self.fact("fact_sessions_by_country", start, end).groupBy("country_id").agg(F.sum("users").alias("users"))
            rows = rows.unionByName(c.select(*sums(True, F.col("country_id"), users=F.col("users"))))
        return rows.groupBy("by_country", "country_id").agg(*[F.sum(c).alias(c) for c in A.REPORT_SUMS])

    def video_periods(self, start, end) -> DataFrame:
        """Video periods that start on ``start`` or end on ``end`` (either edge matching).

        Stored tables are partitioned by (startDate, endDate), so the OR prunes partitions.
        """
        p = self.table("fact_yt_video_period")
        return p.where((F.col("startDate") == C.date_lit(start)) | (F.col("endDate") == C.date_lit(end)))


class DerivedWarehouse(Warehouse):
    """Facts and marts computed from the driver tables under ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        # Logical plans only (no data is cached): one footer read per driver table, and one
        # plan object per built table, so repeated uses share subtrees (exchange reuse).
        self._reads: dict[str, DataFrame] = {}
        self._built: dict[tuple, DataFrame] = {}

    def driver(self, name: str) -> DataFrame:
        if name not in self._reads:
            self._reads[name] = A.read_driver_table(self.spark, self.sf_dir, name)
        return self._reads[name]

    def events(self, start=None, end=None) -> DataFrame:
        return A.event_rows(self.driver("events"), start, end)

    def has(self, name: str) -> bool:
        return (name in DAY_LOCAL_FACTS or name in WHOLE_FACTS
                or name in ("dim_date", "fact_engagement_daily", "fact_comms_impact_daily",
                            "fact_comms_impact_summary"))

    def table(self, name: str) -> DataFrame:
        return self._build(name, None, None)

    def fact(self, name: str, start=None, end=None) -> DataFrame:
        return self._window(self._build(name, start, end), start, end)

    def report_totals(self, start, end, countries: bool) -> DataFrame:
        sides = (self.driver("customer"), self.driver("nation")) if countries else (None, None)
        return A.report_totals(self.events(start, end), *sides)

    def video_periods(self, start, end) -> DataFrame:
        """As the base method, but only two weeks of events are aggregated: a period starting
        on ``start`` holds events dated start..start+6, one ending on ``end`` events dated
        end-6..end. The two ranges become a pushed-down OR of ``ts`` ranges; the edge
        predicate after the aggregate keeps the answer exact."""
        s, e = C.as_date(start), C.as_date(end)
        ev = self.driver("events")
        week = _dt.timedelta(days=7)
        in_range = lambda lo, hi: (F.col("ts") >= C.ts_floor_lit(lo)) & (F.col("ts") < C.ts_floor_lit(hi))
        ev = ev.where(in_range(s, s + week) | in_range(e - _dt.timedelta(days=6), e + _dt.timedelta(days=1)))
        p = A.fact_yt_video_period(A.event_rows(ev))
        return p.where((F.col("startDate") == F.lit(s)) | (F.col("endDate") == F.lit(e)))

    @staticmethod
    def _window(df: DataFrame, start, end) -> DataFrame:
        if start is not None:
            df = df.where(F.col("date") >= C.date_lit(start))
        if end is not None:
            df = df.where(F.col("date") <= C.date_lit(end))
        return df

    def _build(self, name: str, start, end) -> DataFrame:
        key = (name, None if start is None else str(C.as_date(start)), None if end is None else str(C.as_date(end)))
        if key not in self._built:
            self._built[key] = self._build_new(name, start, end)
        return self._built[key]

    def _build_new(self, name: str, start, end) -> DataFrame:
        from tidemark.plans import marts as M
        if name in DAY_LOCAL_FACTS:
            return DAY_LOCAL_FACTS[name](self, self.events(start, end))
        if name in WHOLE_FACTS:
            return WHOLE_FACTS[name](self)
        if name == "dim_date":
            return M.dim_date_from_events(self.driver("events"))
        if name == "fact_engagement_daily":
            if start is None or end is None:
                return M.engagement_from_days(A.engagement_days(self.events()))
            day_before = C.as_date(start) - _dt.timedelta(days=1)
            return M.engagement_window(A.engagement_days(self.events(day_before, end)), self.driver("events"), start, end)
        if name == "fact_comms_impact_daily":
            return M.comms_impact_daily(self._build("fact_ga4_sessions_by_utm_daily", start, end),
                                        self.table("map_utm_campaign"))
        if name == "fact_comms_impact_summary":
            return M.comms_impact_summary(self.table("fact_comms_impact_daily"),
                                          self.table("fact_rd_email_campaign"))
        raise KeyError(f"no such table: {name}")


class StoredWarehouse(Warehouse):
    """Tables written under ``root/<name>`` (Parquet, facts partitioned by date)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def latest_date(self, name: str) -> DataFrame:
        """From the partition folders: a day has one if it has rows. No file is opened."""
        from tidemark.operators.tables import partition_values
        days = [v for v in partition_values(self.spark, self.path(name), "date") if v[:1].isdigit()]
        return self.spark.range(1).select((C.date_lit(max(days)) if days else F.lit(None).cast("date")).alias("latest_date"))

    def table_facts(self, name: str, count: bool, latest: bool) -> DataFrame:
        """The count reads no column (file footers only), the latest date is a partition folder's."""
        day = self.latest_date(name).select(F.coalesce(F.col("latest_date").cast("string"), F.lit("None")).alias("latest"))
        if not count:
            return day
        rows = self.table(name).agg(F.count(F.lit(1)).cast("string").alias("count"))
        return rows.withColumn("latest", day.scalar()) if latest else rows

    def profile(self) -> DataFrame | None:
        return self.table("table_profile") if self.has("table_profile") else None

    def has(self, name: str) -> bool:
        """The table exists (its folder does), even with no rows — like a created table."""
        from tidemark.operators.tables import path_exists
        return path_exists(self.spark, self.path(name))

    def table(self, name: str) -> DataFrame:
        schema = TABLES.get(name)
        reader = self.spark.read
        if schema is not None:
            reader = reader.schema(schema)
        df = reader.parquet(self.path(name))
        if schema is not None:
            df = df.select(*[c.name for c in schema.fields])
        return df
