"""CSV exports of the analytics UI and the UTM mapping file.

Exports carry localised (Portuguese) headers, a footer 'Total' row, and may be UTF-8,
Latin-1 or UTF-16. All cells are read as text (no inference) and cast with ``try_cast``, so a
malformed number becomes NULL instead of failing the load.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators.tables import path_exists

# Export header → canonical column, per export kind.
COMMON_HEADERS = {
    "Usuários": "users",
    "Usuários ativos": "users",
    "Sessões": "sessions",
    "Visualizações de página": "pageviews",
    "Visualizações de tela": "pageviews",
    "Data": "date",
}
PAGE_HEADERS = {
    "Título da página": "page_title",
    "Caminho da página e classe da tela": "page_path",
    "Visualizações": "pageviews",
    "Usuários ativos": "users",
    "Tempo médio de engajamento por sessão": "avg_session_duration",
    "Contagem de eventos": "event_count",
    "Data": "date",
}
VIDEO_HEADERS = {
    "Título do vídeo": "video_title",
    "Contagem de eventos": "event_count",
}
COUNTRY_HEADERS = {
    "ID do país": "country_id",
    "Usuários ativos": "users",
}
# Encodings tried in this order.
ENCODINGS = ("utf-8", "latin-1", "utf-16")
# Spark's CSV reader names Latin-1 by its ISO name.
_CHARSET_ALIASES = {"latin-1": "iso-8859-1", "latin1": "iso-8859-1", "utf8": "utf-8", "utf16": "utf-16"}


def charset(encoding: str) -> str:
    return _CHARSET_ALIASES.get(encoding.lower(), encoding.lower())


UTM_MAP_COLUMNS = ("utm_source", "utm_medium", "utm_campaign", "campaignId", "campaign_name")


def read_csv_text(spark: SparkSession, path: str | list[str], encoding: str = "utf-8") -> DataFrame:
    """Header CSV, every column as text, malformed lines kept (PERMISSIVE)."""
    encoding = charset(encoding)
    r = (spark.read.option("header", True).option("encoding", encoding).option("mode", "PERMISSIVE")
              .option("inferSchema", False))
    if encoding == "utf-16":
        r = r.option("multiLine", True)
    return r.csv(path)


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The file ``path``, or the data files of the folder ``path``, with their file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.getFileStatus(p).isDirectory():
        return [fs.makeQualified(p).toString()]
    return sorted(st.getPath().toString() for st in fs.listStatus(p) if not st.getPath().getName().startswith(("_", ".")))


def sniff_bom(spark: SparkSession, path: str) -> str | None:
    """Encoding named by a byte-order mark at the start of one file, if any.

    Reads at most 3 bytes through the Hadoop file system; no data pass.
    """
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark._jsc.hadoopConfiguration()).open(p)
    try:
        head = bytes((stream.read() & 0xFF) for _ in range(3))
    finally:
        stream.close()
    if head[:2] in (b"\xff\xfe", b"\xfe\xff"):
        return "utf-16"
    if head == b"\xef\xbb\xbf":
        return "utf-8"
    return None


def file_encodings(spark: SparkSession, files: Iterable[str], encodings: Iterable[str] = ENCODINGS) -> dict[str, str]:
    """The encoding of every file: what its byte-order mark names, else the first of ``encodings`` that its bytes allow.

    One job reads the files without a mark, as lines of bytes, and brings one row per file back. UTF-16 is allowed
    where every line that isn't empty holds a NUL, the other encodings only elsewhere, and UTF-8 where all
    lines are valid. Every byte is a character in the single-byte encodings.
    """
    files, encodings = list(files), list(encodings)
    marks = {f: sniff_bom(spark, f) for f in files}
    found = {f: m for f, m in marks.items() if m}
    unmarked = [f for f in files if f not in found]
    if unmarked:
        line = F.col("value")
        some = F.octet_length(line) > 0
        seen = (spark.read.text(unmarked).groupBy(F.col("_metadata.file_path").alias("file"))
                .agg(F.bool_and(F.is_valid_utf8(line)).alias("utf8"),
                     F.coalesce(F.bool_and(F.when(some, line.contains("\x00"))), F.lit(False)).alias("wide")))
        by_name = {_plain(unquote(r.file)): r for r in seen.collect()}
        for f in unmarked:
            r = by_name.get(_plain(f))  # a file without a line has no row: any encoding reads it
            fits = [e for e in encodings if r is None or _allowed(e, r.utf8, r.wide)]
            if not fits:
                raise ValueError(f"cannot read CSV {f} as any of {', '.join(encodings)}")
            found[f] = fits[0]
    return found


def _plain(path: str) -> str:
    """A path with one slash behind its scheme, however many it was written with."""
    return re.sub(r"^([A-Za-z][\w+.-]*):/+", r"\1:/", path)


def _allowed(encoding: str, utf8: bool, wide: bool) -> bool:
    name = charset(encoding)
    if name.startswith("utf-16"):
        return wide
    return not wide and (name != "utf-8" or utf8)


def read_csv_robust(spark: SparkSession, path: str, encodings: Iterable[str] = ENCODINGS) -> DataFrame:
    """The file, or the folder (one export in parts), read once; every file in its own encoding
    (``file_encodings``). Files of one encoding are read together, and the groups stacked by column name."""
    return _read_groups(spark, data_files(spark, path), encodings)


def _read_groups(spark: SparkSession, files: list[str], encodings: Iterable[str],
                 known: Mapping[str, str] | None = None) -> DataFrame:
    by_encoding: dict[str, list[str]] = {}
    for f, e in (known or file_encodings(spark, files, encodings)).items():
        by_encoding.setdefault(e, []).append(f)
    frames = [read_csv_text(spark, fs, e) for e, fs in sorted(by_encoding.items())]
    if not frames:
        raise ValueError("an export without files")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def rename_headers(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by map; when two source headers map to one name, the first non-NULL wins."""
    targets: dict[str, list[str]] = {}
    for c in df.columns:
        targets.setdefault(mapping.get(c, c), []).append(c)
    return df.select(*[(F.coalesce(*[F.col(f"`{s}`") for s in srcs]) if len(srcs) > 1 else F.col(f"`{srcs[0]}`"))
                       .alias(t) for t, srcs in targets.items()])


def import_exports(spark: SparkSession, paths: Iterable[str]) -> DataFrame | None:
    """Existing files only, stacked by column name (missing columns NULL), common
    headers renamed. None when no file exists."""
    exports = [fs for p in paths if path_exists(spark, p) and (fs := data_files(spark, p))]
    if not exports:
        return None
    known = file_encodings(spark, sorted({f for fs in exports for f in fs}))  # one job for all exports
    frames = [_read_groups(spark, fs, ENCODINGS, {f: known[f] for f in fs}) for fs in exports]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return rename_headers(out, COMMON_HEADERS)


def pages_export(df: DataFrame, import_date) -> tuple[DataFrame, DataFrame]:
    """Page export → (dim_page rows, fact_sessions rows dated ``import_date``).

    Footer rows ('Total', 'Total geral', any case) and rows without a title are dropped.
    """
    df = rename_headers(df, PAGE_HEADERS)
    if "page_title" in df.columns:
        df = df.where(~C.is_total_row("page_title"))
    col = lambda c: F.col(c) if c in df.columns else F.lit(None)
    dim = df.select(col("page_path").cast("string").alias("page_path"),
                    col("page_title").cast("string").alias("page_title")).distinct()
    fact = df.select(C.date_lit(import_date).alias("date"),
                     C.safe_long(col("pageviews")).alias("pageviews"),
                     F.lit(None).cast("bigint").alias("sessions"),
                     C.safe_long(col("users")).alias("users"),
                     C.safe_double(col("avg_session_duration")).alias("avg_session_duration"))
    return dim, fact


def videos_export(df: DataFrame, event_name: str, import_date) -> tuple[DataFrame, DataFrame]:
    """Per-event video export → (dim_video rows, fact_events rows)."""
    df = rename_headers(df, VIDEO_HEADERS)
    rows = df.select(F.col("video_title").cast("string").alias("video_title"),
                     C.safe_long("event_count").alias("event_count"),
                     F.lit(event_name).alias("event_name"))
    dim = rows.select("video_title").distinct()
    fact = rows.select(C.date_lit(import_date).alias("date"), "event_name", "event_count", "video_title")
    return dim, fact


def countries_export(df: DataFrame, import_date) -> tuple[DataFrame, DataFrame]:
    """Country export → (dim_country rows, fact_sessions_by_country rows)."""
    df = rename_headers(df, COUNTRY_HEADERS)
    rows = df.select(F.col("country_id").cast("string").alias("country_id"), C.safe_long("users").alias("users"))
    dim = rows.select("country_id").distinct()
    fact = rows.select(C.date_lit(import_date).alias("date"), "country_id", "users")
    return dim, fact


def read_utm_map(spark: SparkSession, path: str | None) -> DataFrame:
    """UTM mapping CSV (5 text columns, chosen by their header in any order; others are ignored). A missing file
    gives an empty map, a missing column is an error."""
    if path is None or not path_exists(spark, path):
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in UTM_MAP_COLUMNS))
    df = (spark.read.option("header", True).option("ignoreLeadingWhiteSpace", False)
               .option("ignoreTrailingWhiteSpace", False).option("inferSchema", False).csv(path))
    missing = [c for c in UTM_MAP_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"UTM map {path} has no column {', '.join(missing)}")
    return df.select(*UTM_MAP_COLUMNS)


def write_csv(df: DataFrame, path: str, encoding: str = "utf-8") -> None:
    """Land a DataFrame as a header CSV export, whitespace kept as is."""
    (df.write.mode("overwrite").option("header", True).option("encoding", charset(encoding))
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
