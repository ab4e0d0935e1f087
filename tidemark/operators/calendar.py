"""Calendar spine: one row per day between two bounds, with year, month and ``%W`` week."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import columns as C


def calendar_from_bounds(bounds: DataFrame, lo: str | Column = "lo", hi: str | Column = "hi") -> DataFrame:
    """``bounds`` holds one row with the first and last day (inclusive).

    The spine is at most one row per day (tens of thousands for a century), generated by one
    ``explode(sequence(..))`` — the only step here that runs in a single task, and its size is
    fixed by the calendar span, not by the data volume.
    """
    lo = F.col(lo) if isinstance(lo, str) else lo
    hi = F.col(hi) if isinstance(hi, str) else hi
    days = bounds.select(F.explode(F.sequence(lo, hi, F.expr("interval 1 day"))).alias("date"))
    return days.select("date",
                       F.year("date").alias("year"),
                       F.month("date").alias("month"),
                       C.week_w("date").alias("week"))


def calendar(spark, start, end) -> DataFrame:
    """Spine for literal bounds."""
    b = spark.range(1).select(C.date_lit(start).alias("lo"), C.date_lit(end).alias("hi"))
    return calendar_from_bounds(b)
