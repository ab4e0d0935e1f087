"""Table maintenance on Parquet folders: idempotent window refresh and friends.

Facts live at ``<root>/<table>`` partitioned by ``date`` (period facts by
``startDate``/``endDate``). Writes use dynamic partition overwrite, so a refresh rewrites only
the partitions it touches, in parallel, one task per output partition group.

Parquet folders have no multi-partition transaction. A replacement is therefore written whole
beside the table, and only then moved in by renames: of one folder for a rebuilt table, day
by day for a window. What is replaced is moved aside first and deleted last, and the next write
brings back whatever a stopped job left aside, so no stop loses rows; until then a window may show days of both pulls.
Re-running a refresh gives the same table (idempotent). A table has one writer at a time.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.schemas import PARTITION_COLS, TABLES


# --- pure forms (DataFrame → DataFrame) ---------------------------------------------------

def replace_window_df(old: DataFrame, new: DataFrame, start, end, date_col: str = "date") -> DataFrame:
    """Rows of ``old`` outside [start, end] (or with a NULL date) plus all of ``new``.

    An empty ``new`` leaves ``old`` untouched (the refresh returns early on an empty pull).
    """
    if new.isEmpty():
        return old
    keep = ~F.col(date_col).between(C.date_lit(start), C.date_lit(end)) | F.col(date_col).isNull()
    return old.where(keep).unionByName(new.select(*old.columns))


def upsert_by_key(old: DataFrame, new: DataFrame, key: str | list[str]) -> DataFrame:
    """INSERT OR REPLACE by primary key: a key in ``new`` replaces the old row; a key given
    twice in one batch keeps the greatest values. One aggregate over (old ∪ new), grouped by
    key, with partial aggregation on both sides."""
    keys = [key] if isinstance(key, str) else list(key)
    vals = [c for c in old.columns if c not in keys]
    both = (old.select(*keys, *vals, F.lit(0).alias("_prio"))
               .unionByName(new.select(*keys, *vals, F.lit(1).alias("_prio"))))
    if not vals:
        return both.select(*keys).distinct()
    best = F.max(F.struct(F.col("_prio"), *[F.col(v) for v in vals])).alias("_best")
    return both.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{v}").alias(v) for v in vals])


# --- stored forms ----------------------------------------------------------------------------

def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark._jvm  # Hadoop FileSystem: the only way to drop a partition folder of a path table
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop_fs(spark, path)
    return bool(fs.exists(p))


def partition_values(spark: SparkSession, path: str, col: str) -> list[str]:
    """Values of the first-level partition folders ``col=value`` under ``path``."""
    fs, p = _hadoop_fs(spark, path)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(col + "="):
            out.append(name[len(col) + 1:])
    return out


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop_fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def _move(spark: SparkSession, source: str, target: str) -> None:
    """Rename ``source`` to the free path ``target``; a refused rename is an error."""
    fs, p = _hadoop_fs(spark, source)
    _, q = _hadoop_fs(spark, target)
    fs.mkdirs(q.getParent())
    if fs.exists(q) or not fs.rename(p, q):
        raise OSError(f"cannot move {source} to {target}")


def _beside(path: str, mark: str) -> str:
    """A folder beside ``path`` that readers of the parent folder pass over (its name begins with a dot)."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/.{mark}-{name}"


def _aside(path: str) -> str:
    return _beside(path, "replaced")


def _days_aside(path: str) -> str:
    return _beside(path, "replaced-days")


def _drop_staged(spark: SparkSession, path: str) -> None:
    """Delete what stopped writers of ``path`` have staged (a table has one writer at a time)."""
    parent, _, name = path.rstrip("/").rpartition("/")
    fs, p = _hadoop_fs(spark, parent)
    if not fs.exists(p):
        return
    staged = re.compile(r"\.staged-[0-9a-f]{8}-" + re.escape(name))
    for st in fs.listStatus(p):
        if staged.fullmatch(st.getPath().getName()):
            fs.delete(st.getPath(), True)


def recover(spark: SparkSession, path: str) -> None:
    """Undo what a stopped replacement left: bring back the table, or the days, that were moved
    aside and have no successor; delete those that have one, and what was staged but never moved in."""
    _drop_staged(spark, path)
    if path_exists(spark, _aside(path)) and not path_exists(spark, path):
        _move(spark, _aside(path), path)
    _delete(spark, _aside(path))
    fs, p = _hadoop_fs(spark, _days_aside(path))
    if fs.exists(p):
        for st in fs.listStatus(p):
            name = st.getPath().getName()
            if not path_exists(spark, f"{path.rstrip('/')}/{name}"):
                _move(spark, f"{_days_aside(path)}/{name}", f"{path.rstrip('/')}/{name}")
        fs.delete(p, True)


def write_partitioned(df: DataFrame, path: str, partition_cols: list[str], mode: str = "overwrite") -> None:
    """Dynamic partition overwrite: only the partitions present in ``df`` are replaced.

    The rebalance hint clusters rows by partition value (few files per day) and lets AQE split
    a skewed day over several tasks instead of writing it from one.
    """
    (df.hint("rebalance", *partition_cols)
       .write.mode(mode)
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_cols)
       .parquet(path))


def ensure_table(spark: SparkSession, path: str, table: str) -> None:
    """Create an empty table with its fixed schema when the folder does not exist (K8)."""
    if path_exists(spark, path):
        return
    empty = spark.createDataFrame([], TABLES[table])
    parts = PARTITION_COLS.get(table, [])
    w = empty.write.mode("overwrite")
    if parts:
        w = w.partitionBy(*parts)
    w.parquet(path)


def replace_window(spark: SparkSession, new: DataFrame, path: str, start, end,
                   date_col: str = "date", empty_clears: bool = False) -> bool:
    """K2: make the table's rows in [start, end] equal to ``new``.

    * no row of ``new`` in the window → table untouched (returns False): a pull that brought nothing.
      With ``empty_clears`` the window becomes empty instead: a mart computed to be empty;
    * rows with a NULL or out-of-window date are not inserted (they could never be replaced
      by a later window refresh); ``plans.ingest.report_rejects`` counts them;
    * the batch is computed once, into a folder beside the table; its days, at most as many as
      the window has, are then moved in one by one, and the window's other days moved out.
    """
    s, e = C.as_date(start), C.as_date(end)
    recover(spark, path)
    staged = _staged_path(path)
    write_partitioned(new.where(F.col(date_col).between(F.lit(s), F.lit(e))), staged, [date_col])
    arrived = set(partition_values(spark, staged, date_col))
    if arrived or empty_clears:
        _move_in(spark, staged, path, date_col, {v for v in partition_values(spark, path, date_col) if _in_window(v, s, e)})
    _delete(spark, staged)
    return bool(arrived)


def replace_partitions(spark: SparkSession, new: DataFrame, path: str, values: Iterable, col: str) -> None:
    """Make the partitions ``values`` of a table that is partitioned by ``col`` equal to ``new``'s rows of these values; one that
    ``new`` has no row of goes. Other partitions keep their files, rows of other values aren't inserted.

    Computed once, beside the table, so ``new`` may read the table; then moved in value by value.
    """
    names = sorted({str(v) for v in values})
    recover(spark, path)
    if not names:
        return
    staged = _staged_path(path)
    write_partitioned(new.where(F.col(col).cast("string").isin(names)), staged, [col])
    _move_in(spark, staged, path, col, set(partition_values(spark, path, col)) & set(names))
    _delete(spark, staged)


def _move_in(spark: SparkSession, staged: str, path: str, col: str, replaced: set[str]) -> None:
    """Move the staged partitions in, one by one; those of ``replaced`` are moved aside first and deleted last."""
    root = path.rstrip("/")
    arrived = set(partition_values(spark, staged, col))
    for value in sorted(arrived | replaced):
        folder = f"{col}={value}"
        if value in replaced:
            _move(spark, f"{root}/{folder}", f"{_days_aside(path)}/{folder}")
        if value in arrived:
            _move(spark, f"{staged}/{folder}", f"{root}/{folder}")
    _delete(spark, _days_aside(path))


def _in_window(value: str, start, end) -> bool:
    try:
        return start <= C.as_date(value) <= end
    except ValueError:
        return False


def replace_period(new: DataFrame, path: str, start_col: str = "startDate", end_col: str = "endDate") -> bool:
    """K3: replace the rows of the (startDate, endDate) periods present in ``new``."""
    if new.isEmpty():
        return False
    write_partitioned(new, path, [start_col, end_col])
    return True


def _swap_in(spark: SparkSession, staged: str, path: str) -> None:
    """Replace ``path`` by the fully written ``staged`` folder (two renames, then cleanup).

    The new table is complete before the old one is touched, so a failed job leaves the old
    table as it was; readers see no table only between the two renames, and a job stopped
    there is undone by ``recover``, which every writer calls first.
    """
    if path_exists(spark, path):
        _move(spark, path, _aside(path))
    _move(spark, staged, path)
    _delete(spark, _aside(path))


def _staged_path(path: str) -> str:
    return _beside(path, f"staged-{uuid.uuid4().hex[:8]}")


def rebuild(df: DataFrame, path: str, partition_cols: list[str] | None = None) -> None:
    """K4/K6: full replace of a table from a query.

    Written to a staging folder first and swapped in, so a failure never leaves the table
    half-deleted, and the query may read the table it replaces.
    """
    recover(df.sparkSession, path)
    staged = _staged_path(path)
    w = df.write.mode("overwrite")
    if partition_cols:
        w = df.hint("rebalance", *partition_cols).write.mode("overwrite").partitionBy(*partition_cols)
    w.parquet(staged)
    _swap_in(df.sparkSession, staged, path)


def append(df: DataFrame, path: str, partition_cols: list[str] | None = None) -> None:
    """K5: append rows (not idempotent by design: CSV imports)."""
    w = df.write.mode("append")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)


DIM_BUCKETS = 256                 # of a dimension that outgrows one folder
PLAIN_DIM_BYTES = 256 * 1024 ** 2


def upsert_table(spark: SparkSession, new: DataFrame, path: str, table: str, key: str | list[str],
                 buckets: int | None = None) -> None:
    """U3 on a stored dimension: merge old ∪ new by key beside the table (a written table
    cuts the lineage to the old files), then move the result in.

    A small dimension is one plain folder and rewritten whole. One of ``PLAIN_DIM_BYTES`` or more is kept in
    ``DIM_BUCKETS`` partitions by a hash of its key (in ``buckets`` if given, at any size): an upsert reads and
    rewrites the buckets that hold a key of ``new``, the files of the others stay. Another number of buckets, or
    none before, rewrites the table once.
    """
    schema = TABLES[table]
    names = schema.fieldNames()
    recover(spark, path)
    exists = path_exists(spark, path)
    kept = _buckets_of(spark, path) if exists else None
    if buckets is None:
        buckets = kept or (DIM_BUCKETS if exists and _size(spark, path) >= PLAIN_DIM_BYTES else None)
    old = spark.read.schema(schema).parquet(path) if exists else spark.createDataFrame([], schema)
    new = new.select(*names)
    if buckets is None:
        rebuild(upsert_by_key(old.select(*names), new, key), path)
        return
    column = f"{_BUCKET}{buckets}"
    keys = [key] if isinstance(key, str) else list(key)
    number = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias(column)
    if kept != buckets:
        rebuild(upsert_by_key(old.select(*names), new, key).select(*names, number), path, [column])
        return
    touched = sorted(r[0] for r in new.select(number).distinct().collect())  # at most ``buckets`` numbers
    merged = upsert_by_key(old.where(F.col(column).cast("int").isin(touched)).select(*names), new, key)
    replace_partitions(spark, merged.select(*names, number), path, touched, column)


_BUCKET = "bucket_of_"


def _buckets_of(spark: SparkSession, path: str) -> int | None:
    """In how many hash buckets the table at ``path`` is kept (its partition column says it); None for another layout."""
    fs, p = _hadoop_fs(spark, path)
    found = {m.group(1) for m in (re.match(rf"{_BUCKET}(\d+)=", st.getPath().getName()) for st in fs.listStatus(p)) if m}
    return int(found.pop()) if len(found) == 1 else None


def _size(spark: SparkSession, path: str) -> int:
    fs, p = _hadoop_fs(spark, path)
    return int(fs.getContentSummary(p).getLength())


def cache_report(df: DataFrame, cache_root: str, dimensions: list[str], metrics: list[str],
                 start, end, force: bool = False) -> str:
    """K1: write a report under a key of its request; reuse it unless ``force``.

    An empty result still writes its schema, so the key marks "already fetched".
    """
    key = f"report__{'-'.join(dimensions)}__{'-'.join(metrics)}__{C.as_date(start)}_{C.as_date(end)}"
    path = f"{cache_root.rstrip('/')}/{key}"
    spark = df.sparkSession
    if path_exists(spark, f"{path}/_SUCCESS") and not force:  # a stopped write has none
        return path
    df.write.mode("overwrite").parquet(path)
    return path


def export_csv(df: DataFrame, path: str) -> None:
    """K7: CSV with header, UTF-8 (one part file per task)."""
    df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)
