"""Stored column profile: what the quality questions need to know of every table, kept day by day.

One pass over a table gives, per day: rows and NULLs of every column, and repeated keys (with their rows) of every key that the
registry declares unique and that holds the table's date. All of it adds up over days, so after a refresh only the touched
days are profiled again and their rows replaced. The catalog, the not-null and unique checks and the row counts then read
this small table (days × columns) instead of the facts; latest dates come from the facts' partition folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators import tables as K
from tidemark.schemas import PROFILE_DATE, REGISTRY, TABLES, TABLE_SOURCE
from tidemark.sources.warehouse import StoredWarehouse

NAME = "table_profile"
PROFILED = tuple(t for t in TABLES if t in TABLE_SOURCE)


def date_column(table: str) -> str | None:
    """The column whose days the profile of ``table`` is kept by; None for a table without one."""
    return PROFILE_DATE.get(table, "date" if "date" in TABLES[table].fieldNames() else None)


def unique_keys(table: str, registry=REGISTRY) -> list[tuple[str, ...]]:
    """Declared keys of ``table`` that hold its date: repeats then stay inside a day and add up over days."""
    return [d.unique for d in registry if d.table == table and d.unique and date_column(table) in d.unique]


def profile_days(df: DataFrame, table: str, registry=REGISTRY) -> DataFrame:
    """(dataset, date, kind, name, rows, nulls, duplicate_keys, duplicate_rows): one row per day and column or key.

    With a declared key the rows are reduced to it first, so that counts and repeats come from the same pass; a second
    declared key of a table costs another one.
    """
    day = date_column(table)
    at = (F.col(day) if day else F.lit(None)).cast("date")
    zero = F.lit(0).cast("bigint")
    keys = unique_keys(table, registry) or [()]
    parts = []
    for n, key in enumerate(keys):
        own = df.columns if n == 0 else []  # columns are counted once
        counted = [F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(own)]]
        if key:
            per = df.groupBy(*key).agg(*counted)
            per = per.groupBy(at.alias("date")).agg(
                F.sum("_n").alias("rows"), *[F.sum(f"_null_{i}").alias(f"_null_{i}") for i in range(len(own))],
                F.count_if(F.col("_n") > 1).alias("again"), F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), zero).alias("again_rows"))
        else:
            per = df.groupBy(at.alias("date")).agg(*counted).withColumnRenamed("_n", "rows")
        row = lambda kind, name, nulls, again, rows: F.struct(
            F.lit(kind).alias("kind"), F.lit(name).alias("name"), nulls.cast("bigint").alias("nulls"),
            again.cast("bigint").alias("duplicate_keys"), rows.cast("bigint").alias("duplicate_rows"))
        lines = [row("column", c, F.col(f"_null_{i}"), zero, zero) for i, c in enumerate(own)]
        lines += [row("key", ",".join(key), zero, F.col("again"), F.col("again_rows"))] if key else []
        parts.append(per.select("date", F.col("rows").cast("bigint").alias("rows"), F.explode(F.array(*lines)).alias("x")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.lit(table).alias("dataset"), "date", "x.kind", "x.name", "rows", "x.nulls", "x.duplicate_keys", "x.duplicate_rows")


def build_profile(spark: SparkSession, root: str, tables=PROFILED, registry=REGISTRY) -> None:
    """Profile every stored table of ``tables`` under ``root``: one pass over each, one job."""
    w = StoredWarehouse(spark, root)
    parts = [profile_days(w.table(t), t, registry) for t in tables if w.has(t)]
    if not parts:
        return
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    K.rebuild(out, w.path(NAME), ["dataset", "date"])


def refresh_profile(spark: SparkSession, root: str, table: str, start, end, registry=REGISTRY) -> None:
    """Profile the days [start, end] of ``table`` again; only its partitions of these days are read. A table that isn't
    kept by day is profiled whole."""
    w = StoredWarehouse(spark, root)
    path, day = f"{w.path(NAME)}/dataset={table}", date_column(table)
    if day is None:
        K.rebuild(profile_days(w.table(table), table, registry).drop("dataset"), path, ["date"])
        return
    touched = w.table(table).where(F.col(day).between(C.date_lit(start), C.date_lit(end)))
    K.replace_window(spark, profile_days(touched, table, registry).drop("dataset"), path, start, end, empty_clears=True)
