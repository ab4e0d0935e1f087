"""Running share of a ranked list (Pareto) without a single-partition window.

``SUM() OVER (ORDER BY v DESC, key ROWS UNBOUNDED PRECEDING)`` over a whole table plans an
``Exchange SinglePartition``: every row through one task. Two exact replacements:

* **top-N**: the running sum of the first N rows only needs those N rows, so cut first
  (``TakeOrderedAndProject`` keeps N per partition), window over ≤ N rows, and divide by the
  total, computed as a scalar subquery over the partial/final aggregate.
* **all rows**: range-partition on the full sort key (value, key) — unique per row, so ties
  cannot pile into one range — and store every row with its range. Both branches read those
  stored rows: one sums each range and turns the sums into offsets (one row per range), the
  other runs the window inside each range. Running total = offset + local.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _order(value: str, key: str):
    return [F.col(value).desc_nulls_last(), F.col(key).asc_nulls_last()]


def running_share_top(df: DataFrame, value: str, key: str, limit: int,
                      running: str = "cum_value", share: str = "cum_share") -> DataFrame:
    """First ``limit`` rows by (value desc, key) with running sum and share of the grand total."""
    total = df.agg(F.sum(value).alias("t")).scalar()
    top = df.orderBy(*_order(value, key)).limit(limit)
    w = Window.orderBy(*_order(value, key)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (top.withColumn(running, F.sum(value).over(w))
               .withColumn(share, F.col(running).cast("double") / F.nullif(total.cast("double"), F.lit(0.0))))


def running_share_all(df: DataFrame, value: str, key: str, rows_per_range: int = 1_000_000,
                      running: str = "cum_value", share: str = "cum_share") -> DataFrame:
    """Every row with running sum and share, in ranges of about ``rows_per_range`` rows.

    The input feeds several jobs (row count, range sampling, the result), so its lineage is cut
    first with a reliable checkpoint under ``spark.checkpoint.dir``: the upstream aggregate
    runs once. The rows are checkpointed again with their range as a column: a range id is
    only meaningful for the one exchange that made it, so it is never derived twice. The
    per-range window re-shuffles those rows by range id; that shuffle carries the page
    aggregates, not raw events.
    """
    from tidemark.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    df = df.checkpoint(eager=True)
    n_rows = df.count()
    n_ranges = max(1, math.ceil(n_rows / rows_per_range))
    ranged = (df.repartitionByRange(n_ranges, *_order(value, key))
                .withColumn("_range", F.spark_partition_id()).checkpoint(eager=True))
    per_range = ranged.groupBy("_range").agg(F.sum(value).alias("_range_sum"))
    wr = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (per_range.withColumn("_offset", F.coalesce(F.sum("_range_sum").over(wr), F.lit(0)))
                        .select("_range", "_offset"))
    total = df.agg(F.sum(value).alias("t")).scalar()
    wl = (Window.partitionBy("_range").orderBy(*_order(value, key))
                .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = (ranged.withColumn("_local", F.sum(value).over(wl))
                 .join(offsets, "_range")
                 .withColumn(running, F.col("_offset") + F.col("_local"))
                 .withColumn(share, F.col(running).cast("double") / F.nullif(total.cast("double"), F.lit(0.0))))
    return out.drop("_range", "_offset", "_local")
