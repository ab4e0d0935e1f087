"""Helpers shared by the training-data operators."""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Callable
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir, scratch_dir

# Word of a text, as Java (and RE2) pattern: a run of anything but ASCII white space.
WS_CLASS = r"\x20\x09-\x0D"
WS_CHARS = " \t\n\x0b\f\r"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` into the cluster's shared checkpoint folder, read it back."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as Parquet in a scratch folder of the shared location: compressed, and read by column afterwards."""
    path = f"{scratch_dir(df.sparkSession, purpose)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(name: str) -> str:
    """A column name that no input column has."""
    return f"{name}_{uuid.uuid4().hex[:8]}"


def keep_where(df: DataFrame, condition: Column) -> DataFrame:
    """``df.where(condition)`` that stays above the projections of ``df``.

    The optimizer would push the filter down by writing every alias out again, which doubles long chains of
    array expressions at each step. A row number, which can't be copied, holds it in place.
    """
    at = fresh("at")
    return df.withColumn(at, F.monotonically_increasing_id()).where((F.col(at) >= 0) & condition).drop(at)


def opaque(df: DataFrame, column: str) -> DataFrame:
    """``df`` with ``column`` as it is, but such that a later filter on it stays above ``df`` (see keep_where)."""
    at = fresh("at")
    return (df.withColumn(at, F.monotonically_increasing_id())
            .withColumn(column, F.when(F.col(at) >= 0, F.col(column))).drop(at))


def count_words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` runs; one character is left of each, white space goes."""
    runs = F.regexp_replace(text, f"[^{WS_CLASS}]++", "w")
    return F.length(F.regexp_replace(runs, f"[{WS_CLASS}]++", "")).cast("long")


def broadcast_if_few(df: DataFrame, limit: int = 100_000) -> DataFrame:
    """Hint a broadcast of ``df`` (a cut, narrow table) when a count proves it has at most ``limit`` rows;
    beyond that the join shuffles and AQE splits its hot keys."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def share(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """Broadcast ``value`` (of a proven size); a task gets it back by a call. Its class travels by value."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(sent.value)
