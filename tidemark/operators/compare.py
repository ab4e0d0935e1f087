"""Two-period comparison in one scan.

The current and the reference period are summed by conditional aggregation over the union
of both windows (one partial/final aggregate, one pass), then turned into one row per metric
with ``stack``. Catalyst would not merge two separate range scans into one.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import columns as C


def compare_periods(df: DataFrame, metrics: Mapping[str, str], cur: tuple, ref: tuple,
                    ref_scale: float = 1.0, ref_name: str = "previous") -> DataFrame:
    """One row per metric: current, reference (× ``ref_scale``), delta_abs, delta_pct (1 dec.).

    ``metrics`` maps output metric name → column. ``cur`` and ``ref`` are inclusive
    (start, end) date pairs; ``df`` must have a ``date`` column.
    """
    (cs, ce), (rs, re) = [(C.as_date(a), C.as_date(b)) for a, b in (cur, ref)]
    lo, hi = min(cs, rs), max(ce, re)
    scan = df.where(F.col("date").between(F.lit(lo), F.lit(hi)))
    aggs = []
    for name, col in metrics.items():
        aggs.append(F.sum(F.when(F.col("date").between(F.lit(cs), F.lit(ce)), F.col(col)))
                     .alias(f"c__{name}"))
        aggs.append(F.sum(F.when(F.col("date").between(F.lit(rs), F.lit(re)), F.col(col)))
                     .alias(f"r__{name}"))
    wide = scan.agg(*aggs)
    stack_args = ", ".join(f"'{n}', c__{n}, r__{n}" for n in metrics)
    long = wide.select(F.expr(f"stack({len(metrics)}, {stack_args}) as (metric, _c, _r)"))
    current = F.coalesce(F.col("_c"), F.lit(0)).cast("double")
    reference = F.coalesce(F.col("_r"), F.lit(0)).cast("double") * F.lit(float(ref_scale))
    return long.select(
        "metric",
        current.alias("current"),
        reference.alias(ref_name),
        (current - reference).alias("delta_abs"),
        F.round(C.pct_change(current, reference), 1).alias("delta_pct"),
    )


def wow_windows(end) -> tuple[tuple, tuple]:
    """Rolling week D-6..D against D-13..D-7."""
    d = C.as_date(end)
    cur_start = d - _dt.timedelta(days=6)
    prev_end = cur_start - _dt.timedelta(days=1)
    return (cur_start, d), (prev_end - _dt.timedelta(days=6), prev_end)


def mtd_windows(end, clamp_prev_month: bool = False) -> tuple[tuple, tuple]:
    """Month to date against the previous month from its first day, same number of days.

    Unclamped (default), the previous window can run past a short month's end
    (31 March → 3 March), as the definition says; clamped stops at the month's last day.
    """
    d = C.as_date(end)
    cur_start = d.replace(day=1)
    prev_start = (cur_start - _dt.timedelta(days=1)).replace(day=1)
    prev_end = prev_start + _dt.timedelta(days=d.day - 1)
    if clamp_prev_month:
        prev_end = min(prev_end, cur_start - _dt.timedelta(days=1))
    return (cur_start, d), (prev_start, prev_end)


def seven_vs_28_windows(end) -> tuple[tuple, tuple]:
    """Last 7 days against the last 28 days (which include the 7)."""
    d = C.as_date(end)
    return (d - _dt.timedelta(days=6), d), (d - _dt.timedelta(days=27), d)
